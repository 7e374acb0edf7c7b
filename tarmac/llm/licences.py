"""Licence scan: a trained paragraph classifier over sparse word n-grams.

Paragraphs are lines. Their pairs and triples of words that licence templates
use are the features of a multinomial logistic regression over licence
families, ordinary text, and licences of no known family. It learns from
templates and parts of them, and from a bounded sample of corpus paragraphs as
ordinary text. Its scores are calibrated by a temperature on rows kept apart;
the least probability that a family needs comes from the same rows. A
prediction stands if the paragraph shares enough n-grams with a template of the
family; a licence without that is of unknown family.

Everything on the corpus is DataFrame expressions and Spark's own regression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored

NONE, UNKNOWN = "none", "unknown"
#: Corpus paragraphs that stand for ordinary text. This bounds the training rows;
#: every paragraph of every document is scored.
ORDINARY_ROWS = 3000
#: N-grams that more than this share of ordinary paragraphs have tell nothing.
COMMON_SHARE = 0.01
CONFIRMED_SHARE, PRECISION = 0.5, 0.99
TEMPERATURES = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95]

# Customary wordings of licence families.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the '
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "it under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free "
        "Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2020 Example Corp. All rights reserved.",
        "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited.",
        "No part of this publication may be reproduced or transmitted in any form without the prior "
        "written permission of the publisher.",
    ],
    UNKNOWN: [
        "Licensed under the terms of the Example License.",
        "This software is distributed under its own license, see the license file for the terms.",
        "Use of this work is subject to the license agreement.",
        "Released under a custom license; you may use and copy it under the terms stated there.",
        "Licensed under the Sample Source License, version 1.0.",
        "This work is licensed under the Open Example License, version 2.",
        "SPDX-License-Identifier: LicenseRef-Custom",
    ],
}
FRAMES = ["{}", "Copyright (c) 2021 the authors. {}", "{} See the file for details.", "Note: {}"]


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def grams_of(words: list[str]) -> list[str]:
    return sorted({" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)})


def _parts(text: str) -> list[str]:
    """The template in its frames, and its runs of at least three fifths of its words."""
    words = words_of(text)
    out = [" ".join(words_of(frame.format(text))) for frame in FRAMES]
    least = max(3, -(-3 * len(words) // 5))
    for length in range(least, len(words)):
        for start in range(0, len(words) - length + 1, 2):
            out.append(" ".join(words[start : start + length]))
    return sorted(set(out))


# Expressions


def _words(paragraph: Column) -> Column:
    plain = F.regexp_replace(F.lower(paragraph), "[^a-z0-9]+", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _grams(words: Column, used: list[str]) -> Column:
    """The distinct pairs and triples of words that are among those used."""
    pairs = F.zip_with(words, F.slice(words, 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    triples = F.zip_with(pairs, F.slice(words, 3, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    own = lambda grams: F.filter(grams, lambda g: g.isNotNull() & g.isin(used))
    return F.array_distinct(F.concat(own(pairs), own(triples)))


def _softmax(raw: Column, temperature) -> Column:
    top = F.array_max(raw)
    weights = F.transform(raw, lambda v: F.exp((v - top) / temperature))
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    return F.transform(weights, lambda v: v / total)


@dataclass
class Scanner:
    """The fitted regression over its n-grams, its calibration, and the templates."""

    families: list[str]
    grams: list[str]
    vectors: CountVectorizerModel
    regression: LogisticRegressionModel
    temperature: float
    threshold: float

    def scores(self, rows: DataFrame) -> DataFrame:
        """Adds ``shares``, the calibrated probability of each family, by ``grams``."""
        found = self.regression.transform(self.vectors.transform(rows))
        raw = vector_to_array("raw")
        return found.withColumn("shares", _softmax(raw, F.lit(self.temperature))).drop(
            "features", "raw", "probability", "prediction"
        )


def fit(docs: DataFrame, ordinary_rows: int = ORDINARY_ROWS) -> Scanner:
    """Learn from the templates and from a sample of paragraphs, drawn by hash.

    Sampled paragraphs that share half of a template's n-grams, or that speak of
    licences, are left out. With few paragraphs the templates weigh more.
    """
    spark = docs.sparkSession
    c = F.col
    families = [NONE, *TEMPLATES]
    known = sorted({g for texts in TEMPLATES.values() for t in texts for g in grams_of(words_of(t))})
    paragraphs = docs.select(F.explode(F.split("text", "\n")).alias("paragraph"))
    sample = (
        paragraphs.filter(F.length("paragraph") > 0)
        .select("paragraph", F.xxhash64("paragraph").alias("key"))
        .filter(F.pmod(F.xxhash64("key"), F.lit(16)) == 0)
        .groupBy("key")
        .agg(F.min("paragraph").alias("paragraph"))
        .orderBy("key")
        .limit(ordinary_rows)
    )
    speaks = F.lower("paragraph").rlike("licen[cs]|copyright|rights reserved|public domain")
    plain = stored(
        sample.filter(~speaks).select(
            F.lit(0.0).alias("label"), _grams(_words(c("paragraph")), known).alias("grams"),
            F.pmod(c("key"), F.lit(4)).alias("fold"),
        ),
        "ordinary",
    )
    n = plain.count()
    common = (
        plain.select(F.explode("grams").alias("gram")).groupBy("gram").count()
        .filter(c("count") > max(2.0, COMMON_SHARE * n)).select("gram").collect()
    )
    used = sorted(set(known) - {r["gram"] for r in common})
    rows = []
    for k, (_, texts) in enumerate(TEMPLATES.items(), 1):
        for text in texts:
            for part in _parts(text):
                own = [g for g in grams_of(part.split()) if g in set(used)]
                if own:
                    rows.append((float(k), own, len(rows) % 4))
    # Rows without any of the n-grams: what most ordinary paragraphs look like.
    rows += [(0.0, [], k % 4) for k in range(len(rows))]
    kept = F.filter("grams", lambda g: g.isin(used))
    made = plain.select("label", kept.alias("grams"), "fold").union(
        spark.createDataFrame(rows, "label double, grams array<string>, fold long")
    )
    # Every family weighs the same, and ordinary text as much as all families.
    sizes = {r["label"]: r["count"] for r in made.groupBy("label").count().collect()}
    weights = {label: 1000 / n for label, n in sizes.items()}
    weights[0.0] *= len(TEMPLATES)
    weight = F.create_map(*[F.lit(v) for pair in weights.items() for v in pair])
    made = stored(made.withColumn("weight", F.element_at(weight, c("label"))), "licence_rows")
    vectors = CountVectorizerModel.from_vocabulary(used, inputCol="grams", outputCol="features")
    vectors.setBinary(True).setMinTF(1.0)
    regression = LogisticRegression(
        family="multinomial", regParam=1e-4, maxIter=60, standardization=False,
        rawPredictionCol="raw", weightCol="weight",
    ).fit(vectors.transform(made.filter("fold != 1")))
    scanner = Scanner(families, used, vectors, regression, 1.0, 0.5)
    apart = regression.transform(vectors.transform(made.filter("fold = 1"))).select(
        c("label").cast("int").alias("label"), vector_to_array("raw").alias("raw")
    )
    scanner.temperature = _temperature(apart)
    scanner.threshold = _threshold(apart, scanner.temperature)
    return scanner


def _temperature(rows: DataFrame) -> float:
    """The temperature under which rows kept apart are likeliest."""
    tried = rows.withColumn("t", F.explode(F.array(*map(F.lit, TEMPERATURES))))
    share = F.element_at(_softmax(F.col("raw"), F.col("t")), F.col("label") + 1)
    loss = tried.groupBy("t").agg(F.avg(-F.log(F.greatest(share, F.lit(1e-12)))).alias("loss"))
    return loss.orderBy(F.round("loss", 9), "t").first()["t"]


def _threshold(rows: DataFrame, temperature: float) -> float:
    """The least probability at which families of rows kept apart are right often enough."""
    shares = rows.select("label", _softmax(F.col("raw"), F.lit(temperature)).alias("shares"))
    top = shares.select("label", F.array_max("shares").alias("p"), "shares").select(
        "label", "p", (F.array_position("shares", F.col("p")) - 1).alias("found")
    )
    tried = top.filter("found > 0").withColumn("t", F.explode(F.array(*map(F.lit, THRESHOLDS))))
    right = tried.filter(F.col("p") >= F.col("t")).groupBy("t").agg(
        F.avg((F.col("found") == F.col("label")).cast("double")).alias("right")
    )
    good = right.filter(F.col("right") >= PRECISION).agg(F.min("t").alias("t")).first()["t"]
    return THRESHOLDS[-1] if good is None else good


def scan(docs: DataFrame, scanner: Scanner | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents (row, doc_id, n_paragraphs) and their licence paragraphs
    (row, paragraph, family, probability, template_share).

    Null and empty texts have no paragraphs. Repeated rows each have a row of
    their own; extra columns are left behind.
    """
    c = F.col
    scanner = fit(docs) if scanner is None else scanner
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(line) > 0)
    paragraphs = F.transform(
        lines,
        lambda line, at: F.struct(
            at.alias("paragraph"), _grams(_words(line), scanner.grams).alias("grams")
        ),
    )
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_paragraphs"),
            F.filter(paragraphs, lambda p: F.size(p["grams"]) > 0).alias("hopeful"),
        ),
        "paragraphs",
    )
    # Paragraphs without any of the n-grams all score alike: as ordinary text.
    hopeful = rows.select("row", F.explode("hopeful").alias("p")).select("row", "p.paragraph", "p.grams")
    shared = F.lit(0.0)
    for family, texts in TEMPLATES.items():
        used = set(scanner.grams)
        own = [[g for g in grams_of(words_of(t)) if g in used] for t in texts]
        best = F.greatest(
            F.lit(0.0),
            F.lit(0.0),
            *[
                F.size(F.array_intersect("grams", F.array(*map(F.lit, g)))) / F.lit(float(len(g)))
                for g in own
                if g
            ],
        )
        shared = F.when(c("best") == family, best).otherwise(shared)
    names = F.array(*map(F.lit, scanner.families))
    scored = (
        scanner.scores(hopeful)
        .withColumn("family_share", F.array_max(F.slice("shares", 2, len(scanner.families) - 1)))
        .withColumn("best", F.element_at(names, F.array_position("shares", c("family_share")).cast("int")))
        .filter(F.element_at("shares", 1) < 0.5)
        .withColumn("template_share", shared)
    )
    sure = (c("family_share") >= scanner.threshold) & (c("template_share") >= CONFIRMED_SHARE)
    found = scored.select(
        "row",
        "paragraph",
        F.when(sure, c("best")).otherwise(UNKNOWN).alias("family"),
        c("family_share").alias("probability"),
        "template_share",
    )
    return rows.select("row", "doc_id", "n_paragraphs"), found


def document_licences(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """doc_id, n_paragraphs, n_licences (paragraphs), families (distinct, in order,
    joined by commas) and known (all of a confirmed family; false without any)."""
    rows, found = scan(docs, scanner)
    by_row = found.groupBy("row").agg(
        F.count("*").alias("n_licences"),
        F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"),
        F.min(F.col("family") != UNKNOWN).alias("known"),
    )
    return rows.join(by_row, "row", "left").select(
        "doc_id",
        "n_paragraphs",
        F.coalesce("n_licences", F.lit(0)).cast("long").alias("n_licences"),
        F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce("known", F.lit(False)).alias("known"),
    )

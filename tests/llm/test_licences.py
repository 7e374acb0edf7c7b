"""The licence scan on the given texts, on awkward ones, and its parts by hand."""

import re

import pytest
from pyspark.sql import functions as F

from tarmac.llm import licences
from tarmac.llm.queries import QUERIES
from tests.llm.cases import documents, nothing

FOLDER = "/root/testdata/sf0.01"
LINES = {
    r"Apache License, Version [\d.]+": "apache",
    r"Released under the MIT License": "mit",
    r"GNU General Public License, version \d": "gpl",
    r"Licensed under CC BY-NC": "cc-by-nc",
    r"All rights reserved": "proprietary",
}


@pytest.fixture(scope="module")
def scanner(spark):
    return licences.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def by_hand(text):
    lines = [line for line in (text or "").split("\n") if line]
    found = [f for line in lines for rule, f in LINES.items() if re.search(rule, line)]
    return len(lines), len(found), ",".join(sorted(set(found)))


def test_licence_lines_of_the_given_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op1_license_scan"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_paragraphs, r.n_licences, r.families) == by_hand(texts[r.doc_id])
        assert r.known == bool(r.n_licences)


def test_awkward_rows(spark, scanner):
    got = licences.document_licences(documents(spark, extra=True), scanner).collect()
    assert len(got) == 10 and all(r.n_licences == 0 and not r.known for r in got)
    assert sum(r.n_paragraphs for r in got) == sum(by_hand(r.text)[0] for r in documents(spark).collect())
    assert licences.document_licences(nothing(spark)).count() == 0


TEXTS = [
    ("Released under the MIT license.", "mit"),
    ("  licensed UNDER the apache license version 2.0", "apache"),
    ("Redistribution and use in source and binary forms are permitted provided that the following "
     "conditions are met:", "bsd"),
    ("it under the terms of the GNU Lesser General Public License as published by", "lgpl"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("Licensed under the terms of the Purple Elephant License.", "unknown"),
    ("The driver showed a license to the officer and walked away.", ""),
    ("Rights and duties were reserved for later meetings.", ""),
]


def test_wordings_and_unknown_licences(spark, scanner):
    frame = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: r.families for r in licences.document_licences(frame, scanner).collect()}
    assert [got[k] for k in range(len(TEXTS))] == [f for _, f in TEXTS]


def test_grams_of_a_paragraph(spark):
    used = ["a b", "b c", "a b c", "x y"]
    row = spark.range(1).select(licences._grams(licences._words(F.lit("A, b-C a b")), used).alias("g"))
    assert sorted(row.first().g) == ["a b", "a b c", "b c"]


def test_no_python_on_the_main_path(spark, scanner):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = licences.document_licences(docs, scanner)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

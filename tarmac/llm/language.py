"""Language identification: string kernel, Nyström landmarks, kernel ridge.

The kernel of two texts is the number of byte n-grams of one to three that both
contain, over the geometric mean of what each contains. N-grams of three are
hashed. Landmark texts span a feature space (Nyström); one ridge regression per
language against the rest is solved there. Texts are scored in batches by
products of presence and landmark matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import fold, map_batches

#: Labelled rows of each language that are learned from, and landmarks among
#: them. They bound what the driver holds; every document is scored.
TRAIN_ROWS, LANDMARKS = 600, 48
RIDGE = 1e-2
UNDETERMINED = "und"

_THREE = 1 << 16
GRAMS = 256 + (1 << 16) + _THREE
#: Texts of one matrix product.
PRODUCT_ROWS = 128
_PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def has_letters(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def grams(text: str) -> np.ndarray:
    """Presence of every n-gram of the lower-cased text, marks read as spaces."""
    raw = text.lower().encode().translate(_PLAIN)
    codes = np.frombuffer(b" " + raw + b" ", dtype=np.uint8).astype(np.uint32)
    present = np.zeros(GRAMS, dtype=bool)
    present[codes] = True
    two = codes[:-1] << 8 | codes[1:]
    present[two + np.uint32(256)] = True
    three = (two[:-1] << 8 | codes[2:]) * np.uint32(2654435761) >> np.uint32(16)
    present[three + np.uint32(256 + (1 << 16))] = True
    return present


@dataclass
class Model:
    """Landmark presences over their own n-grams, and weights to each language."""

    languages: list[str]
    used: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if self.languages and has_letters(t)]
        for start in range(0, len(rows), PRODUCT_ROWS):
            part = rows[start : start + PRODUCT_ROWS]
            present = np.empty((len(part), len(self.used)), dtype=np.float32)
            norms = np.empty(len(part), dtype=np.float32)
            for k, i in enumerate(part):
                found = grams(texts[i])
                present[k] = found[self.used]
                norms[k] = np.sqrt(np.count_nonzero(found))
            values = (present @ self.landmarks / norms[:, None]) @ self.weights
            best = values.argmax(axis=1)
            for k, i in enumerate(part):
                names[i] = self.languages[best[k]]
                scores[i] = min(1.0, max(0.0, (1 + float(values[k, best[k]])) / 2))
        return names, scores


def _sample(docs: DataFrame, usable: Column, rows: int) -> DataFrame:
    """Up to so many distinct texts of each language, drawn by hash.

    Ranks are taken on keys alone; texts join afterwards. The keys number at
    most ``rows`` for each language.
    """
    c = F.col
    keyed = docs.filter(usable).select("lang", "text", F.xxhash64("text", "lang").alias("key"))
    order = Window.partitionBy("lang").orderBy("key")
    keys = (
        keyed.select("lang", "key")
        .distinct()
        .withColumn("place", F.row_number().over(order))
        .filter(c("place") <= rows)
    )
    return keyed.join(F.broadcast(keys.select("key", "place")), "key").dropDuplicates(["key"])


def fit(
    docs: DataFrame, train_rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE
) -> Model:
    """Learn from labelled texts outside the held-out fold; only text and lang are read.

    Without such rows the model answers ``und`` for every text.
    """
    usable = F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold("doc_id", 3) != 1)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.packbits(grams(t)).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["lang"], batch["place"], pa.array(found, pa.binary())],
                names=["lang", "place", "grams"],
            )

    got = map_batches(
        _sample(docs, usable, train_rows), measured, "lang string, place int, grams binary"
    ).toPandas()
    if got.empty:
        return Model([], np.zeros(0, int), np.zeros((0, 0)), np.zeros((0, 0)))
    got = got.sort_values(["lang", "place"], kind="stable").reset_index(drop=True)
    languages = sorted(got["lang"].unique())
    center = got.index[got["place"] <= landmarks].to_numpy()
    packed = [np.frombuffer(g, dtype=np.uint8) for g in got["grams"]]
    used = np.flatnonzero(
        np.unpackbits(np.bitwise_or.reduce([packed[i] for i in center]), count=GRAMS)
    )
    present = np.empty((len(got), len(used)), dtype=np.float32)
    norms = np.empty(len(got))
    for i, bits in enumerate(packed):
        row = np.unpackbits(bits, count=GRAMS)
        present[i], norms[i] = row[used], np.sqrt(row.sum())
    base = (present[center] / norms[center, None]).T.astype(np.float32)
    kernel = (present @ base) / norms[:, None]
    values, vectors = np.linalg.eigh(kernel[center].astype(np.float64))
    whole = values > 1e-6 * values.max()
    root = vectors[:, whole] / np.sqrt(values[whole])
    mapped = kernel @ root
    wanted = np.where(got["lang"].to_numpy()[:, None] == np.array(languages)[None], 1.0, -1.0)
    left = mapped.T @ mapped + ridge * len(got) * np.eye(mapped.shape[1])
    weights = root @ np.linalg.solve(left, mapped.T @ wanted)
    return Model(languages, used, base, weights.astype(np.float32))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    ``und`` with score 0 if a text is null or has no letter. Repeated rows
    repeat, a null doc_id stays null, extra columns are left behind.
    """

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.predict(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        rows, predicted, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )


def keep_identified(
    docs: DataFrame,
    model: Model,
    languages: tuple[str, ...] | None = None,
    into: str | None = None,
) -> DataFrame:
    """The rows in one of the languages (all that were learned, if not given).

    ``into`` names the text column of the rows that takes the language found.
    """
    wanted = set(model.languages if languages is None else languages)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, _ = model.predict(batch["text"].to_pylist())
            columns = [
                pa.array(names, pa.string()) if name == into else batch[name]
                for name in batch.schema.names
            ]
            found = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
            yield found.filter(pa.array([name in wanted for name in names], pa.bool_()))

    return map_batches(docs, kept, docs.schema)

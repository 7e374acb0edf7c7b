"""Quality classifier: Bradley-Terry ranking of documents.

Every text has a vector of character-class and repetition measures. Preference
pairs (a document marked good over one marked bad) train one weight per measure
by the logistic loss on measure differences; a document's strength is its
weighted sum. A quantile of the strengths of the labelled rows is the
threshold, and a logistic curve around it turns strength into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import fold, map_batches, utf8

#: Labelled rows that are learned from, half of either mark at most. This bounds
#: what the driver holds; every document is scored.
TRAIN_ROWS = 20_000
PAIRS_A_STEP, STEPS, RATE, DECAY = 4096, 500, 0.05, 1e-4

CLASSES = 10


def _classes() -> np.ndarray:
    """The class of every byte: letters by case, digits, kinds of marks, spaces."""
    table = np.full(256, 8, dtype=np.uint8)
    for kind, members in enumerate(
        (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
         b".,;:'\"-()", b"!?", b"#$%&*@^~+=", b"|<>[]{}\\/_`", b" ")
    ):
        table[list(members)] = kind
    table[128:] = 9
    return table


CLASS_OF = _classes()
N_FEATURES = CLASSES * CLASSES + 8


def features(text: bytes) -> np.ndarray:
    """Shares of neighbouring character classes, and measures of length and repetition."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    raw = np.frombuffer(text, dtype=np.uint8)
    kinds = CLASS_OF[raw]
    if len(kinds) > 1:
        pairs = np.bincount(kinds[:-1] * np.uint8(CLASSES) + kinds[1:], minlength=CLASSES**2)
        out[: CLASSES**2] = np.sqrt(pairs / (len(kinds) - 1))
    words = text.split()
    lines = text.split(b"\n")
    n = max(1, len(words))
    distinct = len(set(words))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    letters = np.count_nonzero(kinds <= 1) or 1
    out[CLASSES**2 :] = (
        np.log1p(len(text)) / 10,
        np.log1p(len(words)) / 10,
        distinct / n,
        np.log(n / max(1, distinct)),
        repeats / n,
        len(text) / n / 10 if len(text) < 1000 * n else 100.0,
        len(set(lines)) / len(lines),
        np.count_nonzero(kinds == 1) / letters,
    )
    return out


@dataclass
class Ranking:
    """Weights of the measures, the threshold strength and the curve's slope."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def scores(self, matrix: np.ndarray) -> np.ndarray:
        strength = ((matrix - self.center) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(self.slope * (strength - self.threshold), -50, 50)))


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, N_FEATURES)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t).tobytes() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["quality"], pa.array(rows, pa.binary())], names=["quality", "x"]
        )


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Ranking:
    """Learn from labelled rows outside the held-out fold.

    Documents marked both good and bad count for neither. With one mark only,
    or none, all scores are 0.5.
    """
    c = F.col
    marks = (
        labels.select("doc_id", "quality")
        .filter(c("doc_id").isNotNull() & c("quality").isin(0, 1) & (fold("doc_id", 3) != 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter(c("quality") == c("other"))
        .select("doc_id", "quality")
    )
    # Each mark's rows are limited in every task before they meet.
    good, bad = (
        marks.filter(c("quality") == mark).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows // 2)
        for mark in (1, 0)
    )
    chosen = good.union(bad)
    texts = docs.select("doc_id", utf8("text").alias("text"))
    # chosen has at most train_rows rows, whatever the data
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", "quality")
    rows = rows.dropDuplicates(["text", "quality"])
    got = map_batches(rows, _measured, "quality int, x binary").toPandas()
    if got.empty:
        return _fitted(np.zeros((0, N_FEATURES)), np.zeros(0, dtype=int))
    got = got.sort_values(["quality", "x"])
    x = np.frombuffer(b"".join(got["x"]), dtype=np.float32).reshape(-1, N_FEATURES)
    return _fitted(x.astype(np.float64), got["quality"].to_numpy())


def _fitted(x: np.ndarray, y: np.ndarray) -> Ranking:
    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        flat = np.zeros(N_FEATURES)
        return Ranking(flat, flat + 1, flat, 0.0, 1.0)
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-2
    good, bad = (good - center) / scale, (bad - center) / scale
    draw = np.random.default_rng(7)
    weights, mean, square = np.zeros(N_FEATURES), np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    for step in range(1, STEPS + 1):
        differences = (
            good[draw.integers(0, len(good), PAIRS_A_STEP)]
            - bad[draw.integers(0, len(bad), PAIRS_A_STEP)]
        )
        lost = 1 / (1 + np.exp(np.clip(differences @ weights, -50, 50)))
        gradient = -(lost @ differences) / PAIRS_A_STEP + DECAY * weights
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        weights -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    above, below = np.sort(good @ weights), np.sort(bad @ weights)
    threshold = _threshold(above, below)
    spread = np.median(np.abs(np.concatenate([above, below]) - threshold)) + 1e-9
    return Ranking(center, scale, weights, threshold, 4 / spread)


def _threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The strength at the quantile that parts good from bad best.

    Best is the highest mean of both marks' hit rates; of equal quantiles the
    middle one, so that the threshold lies inside the gap.
    """
    both = np.sort(np.concatenate([good, bad]))
    cuts = np.concatenate([[both[0] - 1e-6], (both[:-1] + both[1:]) / 2])
    kept = 1 - np.searchsorted(good, cuts, side="left") / len(good)
    dropped = np.searchsorted(bad, cuts, side="left") / len(bad)
    gain = kept + dropped
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(cuts[best[len(best) // 2]])


def score(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row; null texts count as empty.

    Rows stay as they come: repeated rows repeat in the result, a null doc_id
    stays null, extra columns are left behind.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.scores(_matrix(batch["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(s), pa.array((s >= 0.5).astype("i4"))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), utf8("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        rows, scored, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def keep_good(docs: DataFrame, model: Ranking) -> DataFrame:
    """The rows of score 0.5 and more, with all their columns as they are."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch["text"].to_pylist()]
            yield batch.filter(pa.array(model.scores(_matrix(texts)) >= 0.5))

    return map_batches(docs, kept, docs.schema)

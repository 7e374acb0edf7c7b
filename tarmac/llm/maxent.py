"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) P(word | class). The most frequent words
are classes of their own; the other words form classes by the hash of their
last letters. The class is predicted by a softmax over hashed features of the
history: the word before, the classes of the two before, and as skips those of
the first and third and of the second and third before. A word within its class
has its add-one frequency, with one share left for words that training did not
see, so all probabilities of a history sum to one.

Training counts every training token and takes gradient steps over disjoint
parts of the training texts, all of them together: each task sums its part's
gradient, the sums meet in a tree, and the driver moves the weights, whose size
is fixed. Texts are scored in blocks. A block's own words meet their counts in
buckets, come back to the block, and are held while its texts are scored; no
task holds the whole vocabulary. Words are cut, hashed, numbered and moved many
at a time, as arrays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import fold, map_batches, stored, utf8

#: Bytes of text whose words one task holds with their counts.
BLOCK_BYTES = 12 << 20
FREQUENT, CLASSES, FEATURES, LETTERS = 31, 64, 1 << 14, 2
ROUNDS, RATE, SMOOTH, LARGEST_STEP = 4, 0.15, 100.0, 1.0
#: Positions of one product, partial gradients that one task of the tree adds, the
#: pieces of a gradient, texts cut and scored at a time.
POSITIONS, FAN_IN, SHARDS, TEXTS = 1 << 12, 32, 16, 250
#: Letters of a word that are hashed together with those of other words.
LONG = 32
_START = 0x5BD1E995
_LETTER = np.array([not bytes([k]).isspace() for k in range(256)])
_CRC = np.array([zlib.crc32(bytes([k ^ 0xFF])) ^ 0xFF000000 for k in range(256)], dtype=np.uint32)


def words_of(texts: list[bytes]) -> pa.ListArray:
    """The words of each text and its end, cut for all texts at once."""
    joined = np.frombuffer(b" ".join(texts).lower() + b" ", dtype=np.uint8)
    inside = _LETTER[joined]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    behind = np.cumsum([len(t) + 1 for t in texts])
    ends = np.searchsorted(edges[::2], behind)
    lengths = np.insert(edges[1::2] - edges[::2], ends, 0)
    flat = pa.Array.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(_offsets(lengths)), pa.py_buffer(joined[inside])]
    )
    return pa.ListArray.from_arrays(pa.array(_offsets(np.diff(ends, prepend=0) + 1)), flat)


def pieces(texts: list[bytes]) -> Iterator[pa.ListArray]:
    """The words of a few texts at a time."""
    return (words_of(texts[k : k + TEXTS]) for k in range(0, len(texts), TEXTS))


def tokens(text: bytes) -> list[bytes]:
    return words_of([text])[0].as_py()


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)


def crc32(words: pa.BinaryArray, last: int | None = None) -> np.ndarray:
    """zlib.crc32 of each word, or of its last letters, letter by letter for all words."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)
    starts, ends = offsets[:-1], offsets[1:]
    if last is not None:
        starts = np.maximum(starts, ends - last)
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, LONG).astype(np.int16), kind="stable")
    at = starts[order]
    longer = len(words) - np.cumsum(np.bincount(np.minimum(lengths, LONG), minlength=LONG + 1))
    state = np.full(len(words), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(LONG):
        own = state[: longer[k]]
        if not len(own):
            break
        own[:] = _CRC[(own ^ data[at[: len(own)] + k]) & 0xFF] ^ own >> np.uint32(8)
    out = np.empty_like(state)
    out[order] = ~state
    for k in np.flatnonzero(lengths > LONG):
        out[k] = zlib.crc32(data[starts[k] : ends[k]])
    return out


@dataclass
class Classes:
    """The words that are classes of their own, and each class's tokens and words."""

    frequent: dict[bytes, int]
    totals: np.ndarray
    words: np.ndarray

    def of_all(self, words: pa.BinaryArray | list[bytes]) -> np.ndarray:
        """The class of each word."""
        words = _binary(words)
        own = pc.index_in(words, value_set=_binary(list(self.frequent)))
        ranks = np.array([*self.frequent.values(), -1], dtype=np.int64)
        own = ranks[own.fill_null(-1).to_numpy(zero_copy_only=False)]
        return np.where(own >= 0, own, FREQUENT + crc32(words, LETTERS) % np.uint32(CLASSES - FREQUENT))

    def inside(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Natural logarithm of P(word | class)."""
        share = np.log((counts + 1) / (self.totals + self.words + 1)[classes])
        return np.where(classes < len(self.frequent), 0.0, share)


def _binary(words: pa.Array | pa.ChunkedArray | list[bytes]) -> pa.BinaryArray:
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    return words.cast(pa.binary()) if isinstance(words, pa.Array) else pa.array(words, pa.binary())


class Lexicon:
    """Words as numbers, with their hash, class and count; number 0 stands before a text."""

    def __init__(self, classes: Classes):
        self.classes = classes
        self.words = _binary([])
        self.arrays = (
            np.array([_START], dtype=np.uint32),
            np.array([CLASSES], dtype=np.int64),
            np.array([0], dtype=np.int64),
        )

    def add(self, words: pa.Array | pa.ChunkedArray | list[bytes], counts: np.ndarray | None = None) -> None:
        words = _binary(words)
        counts = np.zeros(len(words), dtype=np.int64) if counts is None else np.asarray(counts)
        more = (crc32(words), self.classes.of_all(words), counts)
        self.words = pa.concat_arrays([self.words, words])
        self.arrays = tuple(np.concatenate(x) for x in zip(self.arrays, more, strict=True))

    def flat(self, texts: pa.ListArray | list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words with three starts before each text; where the words are."""
        texts = texts if isinstance(texts, pa.ListArray) else pa.array(texts, pa.list_(pa.binary()))
        return _after_starts(texts, self.places([texts]))

    def places(self, texts: list[pa.ListArray]) -> pa.Int32Array:
        """Where the words of all texts stand; one call reads all the lexicon."""
        return pc.index_in(pa.concat_arrays([t.flatten() for t in texts]), value_set=self.words)

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.arrays


def _after_starts(texts: pa.ListArray, places: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if places.null_count:
        raise KeyError("a word is not in the lexicon")
    lengths = texts.value_lengths().to_numpy()
    at = np.arange(len(places)) + 3 * np.repeat(np.arange(1, len(lengths) + 1), lengths)
    numbers = np.zeros(len(places) + 3 * len(lengths), dtype=np.int64)
    numbers[at] = places.to_numpy() + 1
    return numbers, at


def features(hashes: np.ndarray, kinds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The feature rows of each position, one column per kind of feature."""
    word = hashes[at - 1]
    one, two, three = (kinds[at - k].astype(np.uint32) + np.uint32(1) for k in (1, 2, 3))
    base = np.uint32(CLASSES + 2)
    mixed = np.stack(
        [
            word * np.uint32(0x9E3779B1) + np.uint32(1),
            (one * base + two) * np.uint32(0x85EBCA77) + np.uint32(2),
            (one * base + three) * np.uint32(0xC2B2AE3D) + np.uint32(3),
            (two * base + three) * np.uint32(0x27D4EB2F) + np.uint32(4),
        ],
        axis=1,
    )
    return (mixed ^ mixed >> np.uint32(15)) >> np.uint32(5) & np.uint32(FEATURES - 1)


def _odds(weights: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of each position and class, their exponentials and the sums of these."""
    logits = weights.take(rows[:, 0], axis=0)
    more = np.empty_like(logits)
    for k in range(1, rows.shape[1]):
        logits += weights.take(rows[:, k], axis=0, out=more, mode="clip")
    logits += weights[FEATURES]
    ones = np.ones(logits.shape[1], dtype=logits.dtype)
    with np.errstate(over="ignore"):
        sums = np.exp(logits, out=more) @ ones
    if len(sums) and not 1e-30 < sums.min() <= sums.max() < 1e30:
        logits -= logits.max(axis=1, keepdims=True)
        sums = np.exp(logits, out=more) @ ones
    return logits, more, sums[:, None]


def class_scores(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Natural logarithms of P(class | history) for each position and class."""
    logits, _, sums = _odds(weights, rows)
    logits -= np.log(sums)
    return logits


def add_gradient(total: np.ndarray, weights: np.ndarray, rows: np.ndarray, kinds: np.ndarray):
    """Adds expected less seen classes to each active feature; the last column counts."""
    _, excess, sums = _odds(weights, rows)
    excess /= sums
    excess[np.arange(len(rows)), kinds] -= 1
    values = total[:, :CLASSES]
    values[FEATURES] += np.ones(len(rows), dtype=np.float32) @ excess
    total[FEATURES, CLASSES] += len(rows)
    together = np.empty_like(excess)
    for k in range(rows.shape[1]):
        order = np.argsort(rows[:, k].astype(np.uint16), kind="stable")
        own = rows[order, k]
        starts = np.flatnonzero(np.diff(own, prepend=own[:1] + 1))
        lengths = np.diff(starts, append=len(own))
        np.take(excess, order, axis=0, out=together, mode="clip")
        fold_runs(together, starts, lengths)
        values[own[starts]] += together[starts]
        total[own[starts], CLASSES] += lengths


def fold_runs(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
    """Leaves the sum of each run of rows in its first row: neighbours meet in pairs,
    pairs in fours and so on, each step for all runs at once."""
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    left = np.repeat(lengths, lengths) - place
    step, here = 1, np.flatnonzero((place & 1 == 0) & (left > 1))
    while len(here):
        values[here] = values.take(here, axis=0) + values.take(here + step, axis=0)
        step *= 2
        here = here[(place[here] & (2 * step - 1) == 0) & (left[here] > step)]


def gradient(texts: list[bytes], weights: np.ndarray, classes: Classes, total: np.ndarray) -> None:
    """Adds the gradient of the texts' likelihood to ``total``."""
    words = words_of(texts)
    coded = words.flatten().dictionary_encode()
    lexicon = Lexicon(classes)
    lexicon.add(coded.dictionary)
    numbers, at = _after_starts(words, coded.indices)
    hashes, kinds, _ = lexicon.parts()
    hashed, kinds = hashes[numbers], kinds[numbers]
    for start in range(0, len(at), POSITIONS):
        some = at[start : start + POSITIONS]
        add_gradient(total, weights, features(hashed, kinds, some), kinds[some])


@dataclass
class Model:
    classes: Classes
    weights: np.ndarray
    tokens: int
    words: int

    def score(self, lexicon: Lexicon, texts: list[bytes]) -> list[tuple[int, int, float, float]]:
        """n_tokens, n_known, base and model score of each text; its words are in the lexicon."""
        if not texts:
            return []
        cut = [*pieces(texts)]
        places, done, found = lexicon.places(cut), 0, []
        for words in cut:
            n = len(words.flatten())
            found += self._scored(lexicon, words, places.slice(done, n))
            done += n
        return found

    def _scored(self, lexicon: Lexicon, words: pa.ListArray, places: pa.Int32Array) -> list[tuple]:
        numbers, at = _after_starts(words, places)
        hashes, kinds, counts = lexicon.parts()
        hashed, before, counts = hashes[numbers], kinds[numbers], counts[numbers[at]]
        kinds = before[at]
        score = self.classes.inside(kinds, counts)
        for start in range(0, len(at), POSITIONS):
            some = slice(start, start + POSITIONS)
            logs = class_scores(self.weights, features(hashed, before, at[some]))
            score[some] += logs[np.arange(len(logs)), kinds[some]]
        base = np.log10((counts + 1) / (self.tokens + self.words + 1))
        lengths = words.value_lengths().to_numpy()
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        columns = (
            lengths,
            np.add.reduceat((counts > 0).astype(np.int64), starts),
            np.add.reduceat(base, starts),
            np.add.reduceat(score / np.log(10), starts),
        )
        return list(zip(*(c.tolist() for c in columns), strict=True))


# On Spark


def blocked(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, text (bytes) and the block of each row, stored."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, size = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            sizes = np.array([len(t) for t in batch["text"].to_pylist()], dtype=np.int64)
            block = first + (size + np.cumsum(sizes)) // block_bytes
            size += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(block)], names=[*batch.schema.names, "block"]
            )

    rows = docs.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), utf8("text").alias("text"))
    return stored(
        map_batches(rows, dealt, f"doc_id {kind}, held_out boolean, text binary, block long"),
        "blocks",
        "zstd",
    )


#: Words and their numbers as blobs: Spark moves rows of many words.
PACKED = "letters binary, lengths binary, n binary"


def packed(words: pa.BinaryArray, n: np.ndarray, bounds: np.ndarray) -> dict[str, pa.Array]:
    """A row of the words and numbers between each two bounds."""
    _, offsets, data = _binary(words).buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[words.offset : words.offset + len(words) + 1]

    def rows(values: np.ndarray | pa.Buffer | None, cuts: np.ndarray) -> pa.Array:
        values = pa.py_buffer(b"" if values is None else values)
        cuts = pa.py_buffer(cuts.astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, cuts, values])

    return {
        "letters": rows(data, offsets[bounds]),
        "lengths": rows(np.diff(offsets), 4 * bounds),
        "n": rows(n.astype(np.int64), 8 * bounds),
    }


def unpacked(rows: pa.Table | pa.RecordBatch) -> tuple[pa.BinaryArray, np.ndarray]:
    """The words of all rows one after another, and their numbers."""

    def joined(name: str) -> np.ndarray:
        column = _binary(rows[name])
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets or bytes(4), dtype=np.int32)[column.offset :]
        return np.frombuffer(data or b"", dtype=np.uint8)[offsets[0] : offsets[len(column)]]

    lengths = joined("lengths").view(np.int32)
    buffers = [None, pa.py_buffer(_offsets(lengths)), pa.py_buffer(joined("letters"))]
    return pa.Array.from_buffers(pa.binary(), len(lengths), buffers), joined("n").view(np.int64)


def block_words(rows: DataFrame, buckets: int) -> DataFrame:
    """Each block's words with their number in its training texts, packed by bucket; a word
    comes again where a block is read by two tasks."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, numbers = None, [], []

        def out() -> pa.RecordBatch:
            coded = pa.concat_arrays(words).dictionary_encode()
            n = np.zeros(len(coded.dictionary), dtype=np.int64)
            np.add.at(n, coded.indices.to_numpy(), np.concatenate(numbers))
            bucket = (crc32(coded.dictionary) % np.uint32(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            some, sizes = np.unique(bucket, return_counts=True)
            columns = packed(coded.dictionary.take(pa.array(order)), n[order], _offsets(sizes))
            return pa.RecordBatch.from_pydict(
                {"bucket": pa.array(some), "block": pa.array(np.full(len(some), block)), **columns}
            )

        for batch in batches:
            blocks, held = batch["block"].to_numpy(), batch["held_out"].to_numpy(zero_copy_only=False)
            for own in dict.fromkeys(blocks.tolist()):
                if own != block and block is not None:
                    yield out()
                    words, numbers = [], []
                block = own
                for side in (False, True):
                    texts = batch["text"].filter(pa.array((held == side) & (blocks == own)))
                    for piece in pieces(texts.to_pylist()):
                        coded = piece.flatten().dictionary_encode()
                        n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                        words.append(coded.dictionary)
                        numbers.append(n * 0 if side else n)
        if block is not None:
            yield out()

    return map_batches(
        rows.select("block", "held_out", "text"), counted, f"bucket long, block long, {PACKED}"
    )


def word_blocks(rows: DataFrame) -> DataFrame:
    """Each block's words with their number in all training texts, stored, and besides, without
    a block, each bucket's words that occur there: one shuffle serves the counts and their way
    back to the blocks. There are as many buckets as blocks, so that one holds about as many
    words as a block."""

    def met(group: pa.Table) -> pa.Table:
        words, n = unpacked(group)
        coded = words.dictionary_encode()
        places, total = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), dtype=np.int64)
        np.add.at(total, places, n)
        bounds = _offsets(pc.binary_length(group["lengths"]).to_numpy() // 4)
        back = packed(words, total[places], bounds)
        learned = np.flatnonzero(total)
        once = packed(coded.dictionary.take(pa.array(learned)), total[learned], np.array([0, len(learned)]))
        return pa.concat_tables(
            [
                pa.table({"block": group["block"], **back}),
                pa.table({"block": pa.array([None], pa.int64()), **once}),
            ]
        )

    buckets = max(1, rows.select("block").distinct().count())
    words = block_words(rows, buckets).groupBy("bucket").applyInArrow(met, f"block long, {PACKED}")
    return stored(words, "word_blocks", "zstd")


def word_counts(words: DataFrame) -> DataFrame:
    """word and n of all words of the training texts, stored."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, n = unpacked(batch)
            yield pa.RecordBatch.from_arrays([own, pa.array(n)], names=["word", "n"])

    rows = words.filter("block is null").select("letters", "lengths", "n")
    return stored(map_batches(rows, listed, "word binary, n long"), "word_counts", "zstd")


def summed(partial: DataFrame, parts: int) -> np.ndarray:
    """The sum of gradients that come as rows (part, shard, values), by a tree."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(group["values"].iloc[0]) // 4, dtype=np.float64)
        for values in group["values"]:
            total += np.frombuffer(values, dtype=np.float32)
        return pd.DataFrame(
            {
                "part": group["part"].iloc[:1] // FAN_IN,
                "shard": group["shard"].iloc[:1],
                "values": [total.astype(np.float32).tobytes()],
            }
        )

    while parts > 1:
        partial = partial.groupBy(F.expr(f"part div {FAN_IN}"), "shard").applyInPandas(
            lambda group: add(group), "part long, shard int, values binary"
        )
        parts = -(-parts // FAN_IN)
    rows = sorted((r["shard"], r["values"]) for r in partial.select("shard", "values").collect())
    return np.frombuffer(b"".join(bytes(v) for _, v in rows), dtype=np.float32)


def _round(rows: DataFrame, weights: np.ndarray, classes: Classes) -> np.ndarray:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, CLASSES + 1), dtype=np.float32)
        some = False
        for batch in batches:
            texts = batch["text"].to_pylist()
            some = some or bool(texts)
            for k in range(0, len(texts), TEXTS):
                gradient(texts[k : k + TEXTS], weights, classes, total)
        if some:
            shards = np.array_split(total.ravel(), SHARDS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId()] * SHARDS, pa.int64()),
                    pa.array(range(SHARDS), pa.int32()),
                    pa.array([s.tobytes() for s in shards], pa.binary()),
                ],
                names=["part", "shard", "values"],
            )

    parts = rows.rdd.getNumPartitions()
    found = summed(
        map_batches(rows.select("text"), partial, "part long, shard int, values binary"), parts
    )
    return found.reshape(FEATURES + 1, CLASSES + 1) if len(found) else np.zeros((0, CLASSES + 1))


def fit(rows: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    """Learn from all rows outside the held-out fold; ``counts`` (word, n) are theirs."""
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("words")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = {bytes(r["word"]): k for k, r in enumerate(top)}
    classes = Classes(frequent, np.zeros(CLASSES), np.zeros(CLASSES))

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = classes.of_all(batch["word"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), batch["n"]], names=["kind", "n"]
            )

    sizes = map_batches(counts.select("word", "n"), classed, "kind int, n long")
    for r in sizes.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        classes.totals[r["kind"]], classes.words[r["kind"]] = r["n"], r["words"]
    prior = (classes.totals + 1) / (classes.totals + 1).sum()
    weights = np.zeros((FEATURES + 1, CLASSES), dtype=np.float32)
    weights[FEATURES] = np.log(prior)
    train = rows.filter(~F.col("held_out")).select("text")
    # A task writes a whole gradient, whatever it reads.
    parts = train.rdd.getNumPartitions()
    train = train.coalesce(max(2 * train.sparkSession.sparkContext.defaultParallelism, parts // 4))
    for k in range(rounds):
        part = train.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k)
        found = _round(part, weights, classes)
        if not len(found):
            continue
        # Each step is the gradient over the curvature that the class shares give.
        curve = found[:, CLASSES:] * (prior * (1 - prior)) + SMOOTH * prior
        step = RATE * found[:, :CLASSES] / curve
        weights -= np.clip(step, -LARGEST_STEP, LARGEST_STEP).astype(np.float32)
    return Model(classes, weights, int(totals["n"] or 0), totals["words"])


def scored(rows: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """Each block's words with their counts meet its texts; a block is bounded in bytes."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    known = words.filter("block is not null")

    def answered(own: pa.Table, texts: pa.Table) -> pa.Table:
        lexicon = Lexicon(model.classes)
        lexicon.add(*unpacked(own))
        found = model.score(lexicon, texts["text"].to_pylist())
        tokens_, known_, base, score_ = zip(*found, strict=True) if found else ((),) * 4
        return pa.table(
            {
                "doc_id": texts["doc_id"],
                "held_out": texts["held_out"],
                "n_tokens": pa.array(tokens_, pa.int64()),
                "n_known": pa.array(known_, pa.int64()),
                "train_tokens": pa.array([model.tokens] * len(found), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(score_, pa.float64()),
            }
        )

    return (
        known.groupBy("block")
        .cogroup(rows.select("block", "doc_id", "held_out", "text").groupBy("block"))
        .applyInArrow(
            answered,
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )


def score(docs: DataFrame, rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Learns from the rows whose crc32(doc_id) modulo 7 is not 2. A null or empty
    text is its end alone. Repeated rows repeat, a null doc_id stays null, extra
    columns are left behind. Without training rows every score is that of the
    untrained model.
    """
    rows = blocked(docs, block_bytes)
    words = word_blocks(rows)
    return scored(rows, words, fit(rows, word_counts(words), rounds))

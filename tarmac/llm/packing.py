"""Best-fit packing of token sequences with a bounded number of open bins.

Texts become token ids, each document ends with one separator. Pieces meet in
random order; a piece goes to the open bin with the least free space that holds
it. Open bins are found in a bitset keyed by free space. Beyond a fixed number
of open bins the fullest closes first.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import map_batches, stored

SEQUENCE, SEPARATOR = 4096, 1
OPEN_BINS = 2048
#: Pieces that one task packs. Each task leaves at most its open bins unfilled.
TASK_PIECES = 250_000
#: Words whose ids a worker remembers; beyond that it starts afresh and keeps, of these,
#: those that come again before the next time.
KNOWN_WORDS = 500_000

PIECES = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


#: Marks that end a word; the fitting tokenizers part them from letters.
_MARKS = ".,;:!?%&*#$\")]|"
#: Fixed value: the pattern by which the fitting tokenizers part texts.
_PARTED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_JOINED = 4096


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit numbers.

    The tokenizers that fit part at white space before anything else, so the ids
    of a text are those of its space-separated parts, one after the other. Those
    that also fold case and part letters from marks get words of letters in lower
    case, many at a time; the end of each word shows in its last token. Ids of
    words seen before are remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        kind = json.loads(Path(path).read_text())
        steps = (kind.get("normalizer") or {}).get("normalizers", [])
        split = (kind.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.folds = (
            any(s.get("type") == "Lowercase" for s in steps)
            and split.get("pattern") == {"Regex": _PARTED}
            and kind["model"].get("end_of_word_suffix") == "</w>"
        )
        words = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, dtype=bool)
        self.ends[[n for word, n in words.items() if word.endswith("</w>")]] = True

    def _parted(self, part: str) -> tuple[str, str]:
        """A word of letters in lower case and the marks after it, or the part as it is."""
        word = part.rstrip(_MARKS)
        # Lower-casing a capital sigma depends on its place; such words stay whole.
        if self.folds and word.isalpha() and "\u03a3" not in word:
            return word.lower(), part[len(word) :]
        return part, ""

    def _unknown(self, words: set[str]) -> set[str]:
        """Those of the words that were not known before either; the others are known again."""
        older = self.older
        again = {w: older[w] for w in words if w in older}
        self.known.update(again)
        return words.difference(again)

    def _learn(self, words: list[str]) -> None:
        if self.folds:
            plain = [w for w in words if w.isalpha()]
            for start in range(0, len(plain), _JOINED):
                some = plain[start : start + _JOINED]
                ids = self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids
                ids = np.array(ids, dtype="<u4")
                cuts = 4 * (np.flatnonzero(self.ends[ids]) + 1)
                if len(cuts) == len(some):
                    raw, begin = ids.tobytes(), 0
                    for word, end in zip(some, cuts.tolist(), strict=True):
                        self.known[word] = raw[begin:end]
                        begin = end
            words = [w for w in words if w not in self.known]
        for start in range(0, len(words), _JOINED):
            some = words[start : start + _JOINED]
            for word, found in zip(
                some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True
            ):
                self.known[word] = np.array(found.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        lists = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.older, self.known = self.known, {}
        known = self.known
        new: set[str] = set()
        for parts in lists:
            new.update(set(parts).difference(known))
        pairs = [(part, *self._parted(part)) for part in self._unknown(new)]
        words = {w for _, *pair in pairs for w in pair if w not in known}
        self._learn(list(self._unknown(words)))
        for part, word, marks in pairs:
            if part != word:
                known[part] = known[word] + known[marks]
        return [b"".join(map(known.__getitem__, parts)) for parts in lists]


@cache
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path)


def _schema(docs: DataFrame, with_ids: bool, by: str | None) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = PIECES.format(kind=kinds["doc_id"]) + (f", `{by}` {kinds[by]}" if by else "")
    return schema + (", ids binary" if with_ids else "")


def _pieces(
    docs: DataFrame, path: str, length: int, separator: int, with_ids: bool, by: str | None
) -> DataFrame:
    end = np.array([separator], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            keys, rows = [], []
            texts = [t or "" for t in batch["text"].to_pylist()]
            for i, ids in enumerate(own.encode(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    some = ids[at : at + 4 * length]
                    keys.append(i)
                    rows.append((piece, at // 4, len(some) // 4, zlib.crc32(some), some))
            piece, start, n, crc, some = zip(*rows, strict=True) if rows else ((),) * 5
            rows_of = pa.array(keys, pa.int64())
            columns = [
                batch["doc_id"].take(rows_of),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(n, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if by:
                columns, names = [*columns, batch[by].take(rows_of)], [*names, by]
            if with_ids:
                columns, names = [*columns, pa.array(some, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    columns = ["doc_id", "text", *([by] if by else [])]
    return map_batches(docs.select(*columns), cut, _schema(docs, with_ids, by))


class Bins:
    """Open bins by free space: a bitset of the free spaces there are, and the
    bins of each."""

    def __init__(self, size: int, most: int, made: int = 0):
        self.size, self.most = size, most
        self.bits, self.open, self.made = 0, 0, made
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = self._take(free)
        else:
            free, at = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(at)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return at, self.size - free

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        at = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return at


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = SEQUENCE,
    separator: int = SEPARATOR,
    open_bins: int = OPEN_BINS,
    task_pieces: int = TASK_PIECES,
    with_ids: bool = False,
    by: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset,
    and with ``with_ids`` the ids themselves.

    A null text is an empty document, whose only token is the separator. Rows of
    the same doc_id are packed each on its own; extra columns are left behind.
    ``tokenizer`` is the path of a tokenizer file that every executor has.
    ``by`` names a column, such as a language, whose values share no sequence; it is
    kept. Every task leaves open bins unfilled for each value then.
    """
    pieces = stored(_pieces(docs, tokenizer, length, separator, with_ids, by), "pieces")
    groups = -(-pieces.count() // task_pieces) or 1
    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    mixed = pieces.withColumn("mix", order).withColumn("task", F.pmod("mix", F.lit(groups)))
    names = [*pieces.columns, "sequence_id", "offset"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bins = None, None
        for batch in batches:
            places = []
            tasks = batch["task"].to_pylist()
            values = batch[by].to_pylist() if by else [None] * len(tasks)
            for task, value, n in zip(tasks, values, batch["length"].to_pylist(), strict=True):
                if bins is None or (task, value) != last:  # rows come sorted by them
                    made = bins.made if bins and last[0] == task else 0
                    last, bins = (task, value), Bins(length, open_bins, made)
                at, offset = bins.place(n)
                places.append((task << 40 | at, offset))
            sequence, offset = zip(*places, strict=True) if places else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in names[:-2]),
                    pa.array(sequence, pa.int64()),
                    pa.array(offset, pa.int64()),
                ],
                names=names,
            )

    schema = _schema(docs, with_ids, by) + ", sequence_id long, offset long"
    order = ["task", *([by] if by else []), "mix", "doc_id", "start"]
    dealt = mixed.repartition(groups, "task").sortWithinPartitions(*order)
    return map_batches(dealt, packed, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces packed with ids: sequence_id, length, ids.

    A sequence holds at most its fixed number of tokens, so no group grows.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), parts.alias("parts")
    ).select(
        "sequence_id",
        "length",
        F.aggregate(
            "parts", F.lit(b"").cast("binary"), lambda all_, part: F.concat(all_, part["ids"])
        ).alias("ids"),
    )

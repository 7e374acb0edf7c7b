"""Benchmark decontamination: windows of benchmark words found in documents.

The benchmark's normalised windows of consecutive words go to every task as a
hash set, behind a check of its size. Every document is read word by word;
windows whose words all occur in the benchmark are hashed, looked up, and
verified word by word. Hit words can be reported, cut out of the text, or the
whole document dropped.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import map_batches, stored, utf8

WINDOW = 10
#: Bytes of benchmark text that one pass sends to every task. A larger benchmark
#: is read in several passes, each over all documents, whose hits are merged.
PASS_BYTES = 64 << 20

#: Bytes that make up words, upper case folded; all others part words.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_SPAN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def _powers(length: int) -> np.ndarray:
    out = np.ones(length, dtype=np.uint64)
    for i in range(1, length):
        out[i] = int(out[i - 1]) * int(_FACTOR) % (1 << 64)
    return out


class Windows:
    """The windows of some benchmark items, by their length in words."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            length = min(window, len(ids))
            if length:
                row = np.array(ids, dtype=np.int64)
                for start in range(len(ids) - length + 1):
                    owner = owners[length][row[start : start + length].tobytes()]
                    if item is not None:
                        owner.add(item)
        self.owners = {n: dict(found) for n, found in owners.items()}
        self.hashes = {
            n: np.unique(
                np.frombuffer(b"".join(found), dtype=np.int64).reshape(-1, n).astype(np.uint64)
                @ _powers(n)
            )
            for n, found in self.owners.items()
        }

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, set[str]]]]:
        """Which words lie in an occurring window; the first word and items of each."""
        hit = np.zeros(len(ids) + 1, dtype=np.int64)
        found = []
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        for n, hashes in self.hashes.items():
            if len(ids) < n:
                continue
            starts = np.flatnonzero(known[n:] - known[:-n] == n)
            rows = ids[starts[:, None] + np.arange(n)]
            keys = rows.astype(np.uint64) @ _powers(n)
            place = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
            for k in np.flatnonzero(hashes[place] == keys):
                items = self.owners[n].get(rows[k].tobytes())
                if items is not None:
                    hit[starts[k]] += 1
                    hit[starts[k] + n] -= 1
                    found.append((starts[k], items))
        return np.cumsum(hit[:-1]) > 0, found

    def scan(self, texts: list[bytes]) -> list[tuple[int, np.ndarray, set[str]]]:
        """For each text the number of words, the places of hit words, and the items."""
        get = self.vocabulary.get
        ids, lengths = [], []
        for text in texts:
            words = words_of(text)
            lengths.append(len(words))
            ids += [get(w, 0) for w in words]
            ids.append(0)
        begin = np.concatenate([[0], np.cumsum(np.array(lengths, dtype=np.int64) + 1)])
        hit, found = self.hits(np.array(ids, dtype=np.int64))
        places = np.flatnonzero(hit)
        cut = np.searchsorted(places, begin)
        items: dict[int, set[str]] = defaultdict(set)
        if found:
            rows = np.searchsorted(begin, [f[0] for f in found], side="right") - 1
            for row, (_, some) in zip(rows.tolist(), found, strict=True):
                items[row] |= some
        return [
            (n, places[cut[i] : cut[i + 1]] - begin[i], items.get(i, set()))
            for i, n in enumerate(lengths)
        ]


def _passes(benchmark: DataFrame, window: int, pass_bytes: int) -> Iterator[Windows]:
    """The benchmark's windows, no more than about ``pass_bytes`` of text at a time."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-size // pass_bytes) or 1
    for k in range(parts):
        part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == k) if parts > 1 else rows
        yield Windows([(r["item"], bytes(r["text"])) for r in part.collect()], window)


def find(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """doc_id, n_words, hits (places of hit words) and items (benchmark ids, as text) of every row.

    Null and empty texts have no words; an item without words has no window; an
    item without id has windows but is not listed. Repeated rows repeat, extra
    columns are left behind.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text binary, n_words long, hits array<long>, items array<string>"
    rows = docs.select(
        "doc_id",
        utf8("text").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<long>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    first = True
    for windows in _passes(benchmark, window, pass_bytes):
        if not first:
            rows = stored(rows, "hits")
        first = False

        def scanned(batches: Iterator[pa.RecordBatch], windows=windows) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = windows.scan(batch["text"].to_pylist())
                hits = [
                    sorted({*old, *new.tolist()}) if old else new.tolist()
                    for old, (_, new, _) in zip(batch["hits"].to_pylist(), found, strict=True)
                ]
                items = [
                    sorted({*old, *new})
                    for old, (_, _, new) in zip(batch["items"].to_pylist(), found, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"],
                        batch["text"],
                        pa.array([n for n, _, _ in found], pa.int64()),
                        pa.array(hits, pa.list_(pa.int64())),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=batch.schema.names,
                )

        rows = map_batches(rows, scanned, schema)
    return rows.select("doc_id", "n_words", "hits", "items")


def without_spans(text: bytes, hits: np.ndarray) -> bytes:
    """The text without each run of hit words, marks between them included."""
    spans = [m.span() for m in _SPAN.finditer(text)]
    out, at, k = [], 0, 0
    while k < len(hits):
        last = k
        while last + 1 < len(hits) and hits[last + 1] == hits[last] + 1:
            last += 1
        out.append(text[at : spans[hits[k]][0]])
        at = spans[hits[last]][1]
        k = last + 1
    return b"".join([*out, text[at:]])


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    remove: str = "documents",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Documents without benchmark passages, with all their columns.

    ``remove="documents"`` drops every document with a hit; ``remove="spans"``
    keeps it without its hit words. Untouched documents stay as they are.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    at = docs.columns.index("text")
    for number, windows in enumerate(_passes(benchmark, window, pass_bytes)):
        if number:
            docs = stored(docs, "decontaminated")

        def cleaned(batches: Iterator[pa.RecordBatch], windows=windows) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [(t or "").encode() for t in batch["text"].to_pylist()]
                hits = [h for _, h, _ in windows.scan(texts)]
                if remove == "documents":
                    yield batch.filter(pa.array([not len(h) for h in hits], pa.bool_()))
                    continue
                old = batch["text"].to_pylist()
                new = [
                    without_spans(t, h).decode() if len(h) else o
                    for o, t, h in zip(old, texts, hits, strict=True)
                ]
                yield batch.set_column(at, batch.schema.field(at), pa.array(new, pa.string()))

        docs = map_batches(docs, cleaned, docs.schema)
    return docs

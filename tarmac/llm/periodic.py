"""Periodic runs of words: stretches that repeat themselves with some period.

Word by word, every earlier occurrence of a word is a lag. A lag that was active
at the word before grows by one matched word, another one starts; an active lag
without a match at this word ends there, and if it is long enough it emits its run
at once. A run of length ``max(least, 2 * period)`` has matched at least
``max(least - period, period)`` words, so ``least / 2`` words in a row at any
period: occurrences are therefore those of the last ``least / 2`` words together,
which are far fewer than those of single words, and lose no run.

Occurrences at even distances are one chain. In an established run the chain of
its period stands for all multiples of the period, which would end as copies of
the same run: a text that repeats one word costs one step a word.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import map_batches, utf8

#: Fewest words of a run.
LEAST = 12
#: Words that are numbered at once; a longer text is numbered alone.
CHUNK_WORDS = 1 << 19

_WORD = re.compile(rb"[^\x20\x09-\x0d]+")

Run = tuple[int, int, int]


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text)


def grams(ids: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the last ``length`` words at every place, -1 where the text has fewer.

    Equal numbers stand for equal words: longer pieces are named by the names of
    two shorter ones, no hashes are involved.
    """
    named, have = ids.astype(np.int64), 1
    while have < length:
        step = min(have, length - have)
        out = np.full(len(named), -1, dtype=np.int64)
        fits = np.flatnonzero((named[step:] >= 0) & (named[:-step] >= 0) & (owner[step:] == owner[:-step]))
        pairs = named[fits] * (int(named.max(initial=0)) + 1) + named[fits + step]
        out[fits + step] = np.unique(pairs, return_inverse=True)[1]
        named, have = out, have + step
    return named


class _Chains:
    """Earlier places of one gram, as stretches of even steps (first, last, step)."""

    __slots__ = ("parts",)

    def __init__(self, place: int):
        self.parts = [[place, place, 0]]

    def add(self, place: int) -> None:
        part = self.parts[-1]
        if part[2] == 0:
            part[1], part[2] = place, place - part[1]
        elif place - part[1] == part[2]:
            part[1] = place
        else:
            self.parts.append([place, place, 0])

    def lags(self, place: int, active: dict[int, int], gram: int) -> Iterator[int]:
        """Distances to the earlier places, without the multiples of an established run."""
        for first, last, step in reversed(self.parts):
            near = place - last
            matched = active.get(near, 0)
            yield near
            if step == 0:
                continue
            at = last - step
            if near == step and matched >= near:
                # inside the run of this period: skip to the places before its start
                start = place - matched - near + gram - 1
                at = min(at, start - 1 - (start - 1 - first) % step)
            for other in range(at, first - 1, -step):
                yield place - other


def runs_of(named: list[int], repeated: list[int], gram: int, least: int) -> list[Run]:
    """All runs (start, length, period) of one text, by start, then period.

    ``named`` numbers the gram that ends at each place, ``repeated`` lists the
    places whose gram occurs more than once, in order.
    """
    seen: dict[int, _Chains] = {}
    active: dict[int, int] = {}
    found: dict[tuple[int, int], int] = {}

    def end(place: int, ended: dict[int, int]) -> None:
        for lag, matched in ended.items():
            length = matched + lag
            if matched >= lag and length >= least:
                # a longer period of the same stretch is a multiple of the smallest
                stretch = (place - length, length)
                found[stretch] = min(lag, found.get(stretch, lag))

    before = -1
    for place in repeated:
        if place != before + 1:
            end(before + 1, active)
            active = {}
        chains, fresh = seen.get(named[place]), {}
        if chains is None:
            seen[named[place]] = _Chains(place)
        else:
            # a lag from before the established run may go on beyond its end
            fresh = {lag: n + 1 for lag, n in active.items() if named[place - lag] == named[place]}
            for lag in chains.lags(place, active, gram):
                # a new lag that matched at the place before was passed over there
                if lag not in fresh and (place - lag < gram or named[place - 1 - lag] != named[place - 1]):
                    fresh[lag] = gram
            chains.add(place)
        end(place, {lag: n for lag, n in active.items() if lag not in fresh})
        active, before = fresh, place
    end(before + 1, active)
    return sorted((start, length, period) for (start, length), period in found.items())


def runs_of_texts(words: list[list[bytes]], least: int = LEAST) -> list[list[Run]]:
    """The runs of each text."""
    gram = max(1, least // 2)
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for ws in words for w in ws], dtype=np.int64)
    sizes = np.array([len(ws) for ws in words], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(words)), sizes)
    named = grams(ids, owner, gram)
    order = np.lexsort((named, owner))
    order = order[named[order] >= 0]
    same = (named[order[1:]] == named[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    repeated = np.zeros(len(ids), dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    out = []
    for lo, hi in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        places = np.flatnonzero(repeated[lo:hi]).tolist()
        out.append(runs_of(named[lo:hi].tolist(), places, gram, least) if places else [])
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that lie in no run after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep)]


def _chunks(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        words = words_of(text)
        if held and size + len(words) > CHUNK_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start, then period), the text
    collapsed to the first period of each run, words joined by one space, and the
    sha256 of the runs (``start,length,period`` and a line feed each) of every row.

    Null and empty texts have no words and no runs. Runs of one text may overlap;
    those that tie in length are all listed. Repeated rows repeat, a null doc_id
    stays null, extra columns are left behind; an empty table gives none. A text is
    read whole, however long; every row is a task's own, so nothing is shuffled.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for words in _chunks(batch["text"].to_pylist()):
                runs = runs_of_texts(words, least)
                listed = ["".join(f"{s},{n},{p}\n" for s, n, p in some) for some in runs]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(at, len(words)),
                        pa.array([len(ws) for ws in words], pa.int64()),
                        pa.array([[dict(zip(("start", "length", "period"), r)) for r in some] for some in runs], run),
                        pa.array([b" ".join(collapsed(ws, some)).decode() for ws, some in zip(words, runs)]),
                        pa.array([hashlib.sha256(text.encode()).hexdigest() for text in listed]),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed", "runs_sha256"],
                )
                at += len(words)

    return map_batches(
        docs.select("doc_id", utf8("text").alias("text")),
        found,
        f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>,"
        " collapsed string, runs_sha256 string",
    )


def longest(runs: str = "runs") -> F.Column:
    """The run of greatest length; of ties the one that starts first, then of the smallest period."""
    key = F.transform(
        runs, lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))
    )
    return F.array_max(key)

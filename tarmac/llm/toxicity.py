"""Toxicity: a weighted lexicon found by Aho-Corasick in folded texts.

Folding undoes look-alike letters and digits written for letters. The lexicon is
learned from labelled rows: folded words, or beginnings that words of many endings
share, that mark toxic documents more often than chance explains, each weighted by
its log odds. Two-word phrases around a lexicon word that clean documents use are
exceptions: they are patterns of the same automaton and take the weight back.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import fold, map_batches, stored, utf8

#: Labelled rows that are learned from, half of either mark at most; their words are
#: counted in Spark. Every document is scored whole.
TRAIN_ROWS = 20_000
#: Fewest toxic documents with a word of the lexicon, and the least log odds.
SUPPORT, ODDS = 3, 2.5
#: Entries expected by chance in a whole lexicon, whatever the number of terms tested.
CHANCE = 0.05
#: Shortest and longest beginning of a word that is an entry of its own.
STEMS = (4, 8)
#: Words that a long text may hold for one that weighs fully.
WORDS_A_HIT = 2000

LOOK_ALIKES = str.maketrans(
    # Cyrillic, then Greek letters, then digits and marks, by their Latin shapes
    "аеорсухіјѕԁһкмтвн" + "αεορυχικντ" + "0134578@$!|",
    "aeopcyxijsdhkmtbh" + "aeopuxiknt" + "oieastbasil",
)
#: A word; marks that stand for letters belong to it only beside one.
_WORD = re.compile(r"(?:[^\W_]|[@$](?=[^\W_])|(?<=[^\W_])[!|$@](?=[^\W_]))+")


def folded(text: str) -> str:
    """Lower-case words between single spaces, look-alikes and digits as letters."""
    plain = unicodedata.normalize("NFKC", text).lower()
    return " " + " ".join(w.translate(LOOK_ALIKES) for w in _WORD.findall(plain)) + " "


@dataclass
class Lexicon:
    """Weights of words and of beginnings (``idiot*``), and exception phrases with the
    weight that each takes back."""

    words: dict[str, float]
    exceptions: dict[str, float]

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for word, weight in self.words.items():
            found.add_word(_pattern(word), weight)
        for phrase, weight in self.exceptions.items():
            found.add_word(f" {phrase} ", -weight)
        if not len(found):
            return None
        found.make_automaton()
        return found


def _pattern(entry: str) -> str:
    return f" {entry[:-1]}" if entry.endswith("*") else f" {entry} "


def _terms(words: list[str]) -> set[str]:
    """Distinct words, beginnings and phrases of two words."""
    own = set(words)
    stems = {f"{w[:n]}*" for w in own for n in range(STEMS[0], min(STEMS[1], len(w) - 1) + 1)}
    return own | stems | {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def _apart(candidates: list[tuple[str, float, float]]) -> dict[str, float]:
    """Of entries that match in the same words, the one with most evidence; of equal
    ones the whole word, then the longest."""
    kept: dict[str, float] = {}
    for entry, odds, _ in sorted(candidates, key=lambda e: (-e[2], e[0].endswith("*"), -len(e[0]), e[0])):
        own = _pattern(entry)
        if not any(own.startswith(_pattern(k)) or _pattern(k).startswith(own) for k in kept):
            kept[entry] = odds
    return kept


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Lexicon:
    """Learn from labelled rows outside the held-out fold.

    Documents marked both ways count for neither; without rows of both marks the
    lexicon is empty. An entry needs evidence (the log likelihood of its rows' marks
    over that of the usual share) that chance gives to ``CHANCE`` of all tested terms.
    """
    c = F.col
    marks = (
        labels.select("doc_id", "toxic")
        .filter(c("doc_id").isNotNull() & c("toxic").isin(0, 1) & (fold("doc_id", 5) != 0))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
        .filter(c("toxic") == c("other"))
        .select("doc_id", "toxic")
    )
    toxic, clean = (
        marks.filter(c("toxic") == mark).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows // 2)
        for mark in (1, 0)
    )
    # at most train_rows rows, whatever the data
    chosen = F.broadcast(toxic.union(clean))
    # only distinct folded words and phrases of a row leave its task
    rows = docs.select("doc_id", utf8("text").alias("text")).join(chosen, "doc_id")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways, marks_ = [], []
            for text, mark in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                words = folded(text.decode()).split()
                own = _terms(words)
                ways += own
                marks_ += [mark] * len(own)
            columns = [pa.array(ways, pa.string()), pa.array(marks_, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "toxic"])

    counted = stored(
        map_batches(rows, told, "term string, toxic int").groupBy("term").agg(
            F.sum("toxic").alias("bad"), F.sum(1 - c("toxic")).alias("good")
        ),
        "terms",
    )
    totals = rows.agg(F.sum("toxic").alias("bad"), F.sum(1 - c("toxic")).alias("good")).first()
    n_bad, n_good = totals["bad"] or 0, totals["good"] or 0
    if not n_bad or not n_good:
        return Lexicon({}, {})
    odds = F.log((c("bad") + 0.5) / (n_bad + 1)) - F.log((c("good") + 0.5) / (n_good + 1))
    both, share = c("bad") + c("good"), n_bad / (n_bad + n_good)
    evidence = c("bad") * F.log(c("bad") / (both * share)) + F.when(
        c("good") > 0, c("good") * F.log(c("good") / (both * (1 - share)))
    ).otherwise(0)
    one = ~c("term").contains(" ")
    # a word must mark a share of the toxic rows: their number bounds the lexicon
    least = max(SUPPORT, n_bad // 20)
    tested = counted.filter(one & (both >= least)).count()
    marking = counted.filter(one & (c("bad") >= least)).select("term", odds.alias("odds"), evidence.alias("evidence"))
    needed = np.log(max(tested, 1) / CHANCE)
    words = _apart([tuple(r) for r in marking.filter((c("odds") >= ODDS) & (c("evidence") >= needed)).collect()])
    if not words:
        return Lexicon({}, {})
    # entries hold letters and digits only
    inside = "|".join(f"{w[:-1]}" if w.endswith("*") else f"{w}( |$)" for w in words)
    clean_uses = counted.filter(~one & (c("good") >= SUPPORT) & (c("good") * n_bad > c("bad") * n_good))
    found = Lexicon(words, {}).automaton()
    exceptions = {
        r["term"]: sum(weight for _, weight in found.iter(f" {r['term']} "))
        for r in clean_uses.filter(c("term").rlike(f"(^| )({inside})")).collect()
    }
    return Lexicon(words, exceptions)


def score(docs: DataFrame, model: Lexicon) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row.

    The score is the weight found, normalised by length: a hit weighs fully in a
    text of ``WORDS_A_HIT`` words and less beyond. Null and empty texts score 0.
    Repeated rows repeat, a null doc_id stays null, extra columns are left behind.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = model.automaton()
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                plain = folded(text.decode())
                total = sum(weight for _, weight in found.iter(plain)) if found is not None else 0.0
                out.append(max(0.0, total) / max(1.0, (plain.count(" ") - 1) / WORDS_A_HIT))
            s = 1 - np.exp(-np.array(out, dtype=np.float64) * np.log(2) / (ODDS / 2))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(s), pa.array((s >= 0.5).astype("i4"))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), utf8("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, scored, f"doc_id {kind}, held_out boolean, score double, predicted int")

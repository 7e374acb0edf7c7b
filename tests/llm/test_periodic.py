"""Periodic runs against a slow search over all periods."""

import hashlib
import random
import re
import zlib

import pytest

from tarmac.llm import periodic
from tarmac.llm.queries import QUERIES
from tests.llm.cases import documents, nothing

FOLDER = "/root/testdata/sf0.001"


def slow_runs(words, least):
    """Every maximal stretch of every period, kept under its smallest period."""
    found = {}
    for q in range(1, len(words)):
        start = None
        for i in range(q, len(words) + 1):
            if i < len(words) and words[i] == words[i - q]:
                start = i - q if start is None else start
            elif start is not None:
                if i - start >= max(least, 2 * q):
                    found.setdefault((start, i - start), q)
                start = None
    return sorted((s, n, q) for (s, n), q in found.items())


def slow_collapsed(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in drop]


def made(draw, letters):
    words = []
    while len(words) < 60:
        piece = [draw.choice(letters) for _ in range(draw.randint(1, 7))]
        words += piece * draw.randint(1, 6)
    return words


@pytest.mark.parametrize("least", [2, 5, 12])
@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefgh"])
def test_runs_equal_a_slow_search(least, letters):
    draw = random.Random(f"{least}{letters}")
    texts = [[w.encode() for w in made(draw, letters)] for _ in range(150)]
    for words, got in zip(texts, periodic.runs_of_texts(texts, least), strict=True):
        assert got == slow_runs(words, least)
        assert periodic.collapsed(words, got) == slow_collapsed(words, got)


def slow_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = slow_runs(words, 12)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *told, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        digest(" ".join(slow_collapsed(words, runs))),
    )


def test_query_equals_a_slow_one(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    short = {d.doc_id: d for d in docs if len(d.text or "") < 6000}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    assert [got[i] for i in short] == [slow_row(i, d.text) for i, d in short.items()]


def test_awkward_rows(spark):
    docs = documents(spark, extra=True)
    rows = periodic.periodic_runs(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id in (2, 3, 6):
            assert (r.n_words, r.runs, r.collapsed) == (0, [], "")
        if r.doc_id == 5:
            assert [tuple(x) for x in r.runs] == [(0, 33000, 11)] and len(r.collapsed.split()) == 11
    assert periodic.periodic_runs(nothing(spark)).count() == 0


def test_one_word_and_one_line_repeated_are_quick():
    many = [b"x"] * 200_000
    line = [b"a", b"b", b"c", b"d", b"e", b"f", b"g"] * 30_000
    assert periodic.runs_of_texts([many, line]) == [[(0, 200_000, 1)], [(0, 210_000, 7)]]

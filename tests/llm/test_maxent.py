"""The language model: exact base scores, probabilities that sum to one, gain over the base."""

import math
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

from tarmac.llm import maxent
from tarmac.llm.queries import QUERIES
from tests.llm.cases import documents, nothing

FOLDER = "/root/testdata/sf0.001"


def slow_base(rows):
    own = lambda t: [*(t or "").encode().lower().split(), b""]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    counts = Counter(w for d, t in rows if not held(d) for w in own(t))
    n, v = sum(counts.values()), len(counts)
    return sorted(
        (
            repr(d), held(d), len(own(t)), sum(counts[w] > 0 for w in own(t)), n,
            round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own(t)), 4),
        )
        for d, t in rows
    )


def found(rows):
    return sorted(
        (repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
        for r in rows
    )


@pytest.mark.parametrize("block_bytes", [1 << 20, 500])
def test_base_scores_are_exact(spark, block_bytes):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    got = maxent.score(docs, rounds=1, block_bytes=block_bytes).collect()
    assert found(got) == slow_base([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(spark):
    docs = documents(spark, extra=True)
    got = maxent.score(docs, rounds=2).collect()
    assert found(got) == slow_base([(r.doc_id, r.text) for r in docs.collect()])
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    assert maxent.score(nothing(spark)).count() == 0


def test_the_model_beats_the_base_on_held_out_rows(spark):
    rows = [r for r in QUERIES["op5_maxent_scoring"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert len(rows) > 80 and sum(r.score for r in rows) > 0.98 * sum(r.base_score for r in rows)


def test_probabilities_of_a_history_sum_to_one():
    draw = np.random.default_rng(3)
    words = [bytes([97 + i, 97 + j]) for i in range(12) for j in range(12)]
    counts = {w: int(n) for w, n in zip(words, draw.integers(1, 50, len(words)), strict=True)}
    top = sorted(words, key=lambda w: -counts[w])[: maxent.FREQUENT]
    classes = maxent.Classes(
        {w: k for k, w in enumerate(top)}, np.zeros(maxent.CLASSES), np.zeros(maxent.CLASSES)
    )
    kinds = np.array(classes.of_all(words))
    np.add.at(classes.totals, kinds, list(counts.values()))
    np.add.at(classes.words, kinds, 1)
    weights = draw.normal(size=(maxent.FEATURES + 1, maxent.CLASSES)).astype(np.float32)
    rows = draw.integers(0, maxent.FEATURES, (5, 4))
    logs = maxent.class_scores(weights, rows)
    assert np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-5)
    inside = np.exp(classes.inside(kinds, np.array([counts[w] for w in words])))
    share = np.bincount(kinds, inside, minlength=maxent.CLASSES)
    unseen = 1 / (classes.totals + classes.words + 1)
    unseen[: maxent.FREQUENT] = 0
    assert np.allclose(share + unseen, 1)


def test_gradient_is_that_of_the_likelihood():
    random.seed(1)
    text = " ".join(random.choice(["ab", "cd", "ef", "gh"]) for _ in range(60)).encode()
    classes = maxent.Classes({b"ab": 0}, np.zeros(maxent.CLASSES), np.zeros(maxent.CLASSES))
    weights = np.zeros((maxent.FEATURES + 1, maxent.CLASSES), dtype=np.float32)
    total = np.zeros((maxent.FEATURES + 1, maxent.CLASSES + 1), dtype=np.float32)
    maxent.gradient([text], weights, classes, total)

    def loss(w):
        lexicon = maxent.Lexicon(classes)
        words = maxent.tokens(text)
        lexicon.add(sorted(set(words)))
        numbers, at = lexicon.flat([words])
        hashes, kinds, _ = lexicon.parts()
        logs = maxent.class_scores(w, maxent.features(hashes[numbers], kinds[numbers], at))
        return -logs[np.arange(len(at)), kinds[numbers][at]].sum()

    for row, kind in ((maxent.FEATURES, 0), (int(np.argmax(total[:-1, -1])), 0)):
        moved = weights.copy()
        moved[row, kind] = 0.5
        low = weights.copy()
        low[row, kind] = -0.5
        assert abs((loss(moved) - loss(low)) - total[row, kind]) < 0.05 * abs(total[row, kind]) + 0.2


def test_a_tree_adds_all_partial_gradients(spark):
    n = 70
    rows = [(p, s, np.full(3, p + s, dtype=np.float32).tobytes()) for p in range(n) for s in range(2)]
    frame = spark.createDataFrame(rows, "part long, shard int, values binary")
    want = [sum(range(n))] * 3 + [sum(range(1, n + 1))] * 3
    assert maxent.summed(frame, n).tolist() == want


def test_counts_return_to_the_blocks_without_a_join(spark):
    plan = maxent.score(documents(spark), rounds=1)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(block") == 2


def test_gradients_come_from_few_tasks(spark, monkeypatch):
    most = max(2 * spark.sparkContext.defaultParallelism, 10)
    parts, summed = [], maxent.summed
    monkeypatch.setattr(maxent, "summed", lambda rows, n: (parts.append(n), summed(rows, n))[1])
    texts = spark.createDataFrame([(f"some words and others {k}", k % 9 == 0) for k in range(200)], "text string, held_out boolean")
    rows = texts.withColumn("text", texts["text"].cast("binary")).repartition(4 * most)
    counts = spark.createDataFrame([(b"some", 200), (b"words", 200)], "word binary, n long")
    maxent.fit(rows, counts, rounds=2)
    assert len(parts) == 2 and max(parts) <= most


def random_texts(n, seed=5):
    draw = random.Random(seed)
    parts = [b" ", b"\t\n", b"\x0b\x0c\r", b"A", b"bC", b"the", b"\x85\xa0\xe2\x80\x83", b"\x00\x1c"]
    parts += [b"z" * 70, b"q" * 32]
    return [b"".join(draw.choices(parts, k=draw.randrange(0, 12))) for _ in range(n)] + [b"", b" "]


def test_words_are_cut_as_by_split_and_hashed_as_by_zlib():
    texts = random_texts(300)
    for some in (texts, [b""], [b"", b"", b"a"]):
        words = maxent.words_of(some)
        assert words.to_pylist() == [[*t.lower().split(), b""] for t in some]
        flat = words.flatten()
        assert maxent.crc32(flat).tolist() == [zlib.crc32(w) for w in flat.to_pylist()]
        assert maxent.crc32(flat[1:], 2).tolist() == [zlib.crc32(w[-2:]) for w in flat[1:].to_pylist()]


def test_runs_of_rows_are_summed_in_their_first_row():
    draw = np.random.default_rng(2)
    lengths = np.array([1, 2, 3, 1, 8, 9, 100, 1])
    starts = np.cumsum(lengths) - lengths
    values = draw.integers(-9, 9, (lengths.sum(), 3)).astype(np.float32)
    want = np.add.reduceat(values, starts, axis=0)
    maxent.fold_runs(values, starts, lengths)
    assert (values[starts] == want).all()


def test_python_does_nothing_word_by_word():
    classes = maxent.Classes({b"": 0, b"w7": 1}, np.ones(maxent.CLASSES), np.ones(maxent.CLASSES))
    weights = np.zeros((maxent.FEATURES + 1, maxent.CLASSES), dtype=np.float32)
    total = np.zeros((maxent.FEATURES + 1, maxent.CLASSES + 1), dtype=np.float32)
    texts = [" ".join(f"w{i * k}" for i in range(1000)).encode() for k in range(1, 11)]
    words = sorted({w for t in texts for w in maxent.tokens(t)})
    model = maxent.Model(classes, weights, 10, 10)

    def everything():
        lexicon = maxent.Lexicon(classes)
        lexicon.add(words, [1] * len(words))
        model.score(lexicon, texts)
        maxent.gradient(texts, weights, classes, total)

    everything()
    calls = 0

    def called(_, event, __):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(called)
    try:
        everything()
    finally:
        sys.setprofile(None)
    assert len(words) > 4000 and calls < 2500


def slow_score(classes, weights, counts, text):
    """Natural logarithm of P(text), word by word."""
    words, mask = [*text.lower().split(), b""], 0xFFFFFFFF
    history = [(0x5BD1E995, maxent.CLASSES)] * 3
    result = 0.0
    for word in words:
        (_, three), (_, two), (own, one) = history[-3:]
        base = maxent.CLASSES + 2
        one, two, three = one + 1, two + 1, three + 1
        mixed = [
            own * 0x9E3779B1 + 1 & mask,
            (one * base + two) * 0x85EBCA77 + 2 & mask,
            (one * base + three) * 0xC2B2AE3D + 3 & mask,
            (two * base + three) * 0x27D4EB2F + 4 & mask,
        ]
        active = [(x ^ x >> 15) >> 5 & maxent.FEATURES - 1 for x in mixed] + [maxent.FEATURES]
        logits = [math.fsum(float(weights[f, k]) for f in active) for k in range(maxent.CLASSES)]
        kind = classes.frequent.get(
            word, maxent.FREQUENT + zlib.crc32(word[-2:]) % (maxent.CLASSES - maxent.FREQUENT)
        )
        top = max(logits)
        result += logits[kind] - top - math.log(math.fsum(math.exp(x - top) for x in logits))
        if kind >= len(classes.frequent):
            result += math.log((counts[word] + 1) / (classes.totals[kind] + classes.words[kind] + 1))
        history.append((zlib.crc32(word), kind))
    return result


@pytest.mark.parametrize("size", [0.5, 60.0])
def test_scores_are_those_of_a_slow_model(size):
    draw = np.random.default_rng(4)
    texts = random_texts(20, seed=6)
    counts = Counter(w for t in texts[::2] for w in maxent.tokens(t))
    top = sorted(counts, key=lambda w: (-counts[w], w))[:3]
    classes = maxent.Classes(
        {w: k for k, w in enumerate(top)},
        draw.integers(5, 99, maxent.CLASSES).astype(float),
        draw.integers(1, 9, maxent.CLASSES).astype(float),
    )
    weights = (size * draw.normal(size=(maxent.FEATURES + 1, maxent.CLASSES))).astype(np.float32)
    words = sorted({w for t in texts for w in maxent.tokens(t)})
    lexicon = maxent.Lexicon(classes)
    lexicon.add(words, [counts[w] for w in words])
    got = maxent.Model(classes, weights, 50, 20).score(lexicon, texts)
    want = [slow_score(classes, weights, counts, t) / math.log(10) for t in texts]
    assert np.allclose([g[3] for g in got], want, rtol=1e-4, atol=1e-4)
    assert [g[0] for g in got] == [len(maxent.tokens(t)) for t in texts]


def test_words_move_as_blobs(spark):
    texts = [(k, f"w{k} w{k % 7} " + " ".join(f"x{i * k % 5000}" for i in range(400))) for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(2)
    rows = maxent.blocked(docs, 8000)
    blocks = rows.select("block").distinct().count()
    words = maxent.word_blocks(rows)
    counts = {bytes(r.word): r.n for r in maxent.word_counts(words).collect()}
    learned = [maxent.tokens(t.encode()) for k, t in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    assert counts == Counter(w for t in learned for w in t)
    assert 2 < blocks and words.count() <= (blocks + 1) * blocks < len(counts)


def test_packed_words_come_back():
    words = [b"", b"a", b"bc" * 40, b"\xff", b"d"]
    rows = maxent.packed(maxent._binary(words), np.arange(5), np.array([0, 2, 2, 5]))
    table = maxent.pa.table(rows)
    for some, want in ((table, words), (table[1:], words[2:]), (table[:1], words[:2]), (table[:0], [])):
        own, n = maxent.unpacked(some)
        assert own.to_pylist() == want and n.tolist() == [words.index(w) for w in want]

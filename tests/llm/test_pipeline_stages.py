"""The five operators of the pipeline against brute force and held-out rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import decontamination, language, packing, quality, simhash
from tarmac.llm.queries import ORACLES, QUERIES, tokenizer_path
from tests.llm.cases import LONG, documents, nothing

FOLDER = "/root/testdata/sf0.001"


def mod(key, n):
    return zlib.crc32(("" if key is None else str(key)).encode()) % n


# Quality


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_quality_agrees_with_held_out_labels(spark, labels):
    got = QUERIES["op3_quality_ranking"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id"
    )
    rows = [r for r in got.collect() if r.held_out]
    assert len(rows) > 100 and all(mod(r.doc_id, 3) == 1 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_quality_learns_nothing_from_held_out_labels(spark, labels):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    turned = labels.withColumn(
        "quality",
        F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality"))
        .otherwise(F.col("quality")),
    )
    assert np.allclose(quality.fit(docs, labels).weights, quality.fit(docs, turned).weights)


def test_quality_of_awkward_rows(spark, labels):
    model = quality.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"), labels)
    got = quality.score(documents(spark, extra=True), model).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_good(documents(spark, extra=True), model)
    assert kept.columns == documents(spark, extra=True).columns
    assert kept.count() == sum(r.predicted for r in got)
    assert quality.score(nothing(spark), model).count() == 0
    flat = quality.fit(documents(spark), labels.limit(0))
    assert {r.score for r in quality.score(documents(spark), flat).collect()} == {0.5}


# Language


def test_language_agrees_with_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op4_language_kernel"](spark, folder).join(docs.select("doc_id", "lang"), "doc_id")
    rows = [r for r in got.collect() if r.held_out]
    assert len(rows) > 200 and all(mod(r.doc_id, 3) == 1 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_language_kernel_counts_common_grams():
    one, two = language.grams("abc"), language.grams("ABC d")
    assert one.sum() == 4 + 4 + 3  # a b c space; pairs and triples with the outer spaces
    assert (one & two).sum() == 4 + 4 + 3


def test_language_of_awkward_rows(spark):
    model = language.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    got = language.identify(documents(spark, extra=True), model).collect()
    und = Counter(r.doc_id for r in got if r.lang_pred == "und")
    assert und == Counter({2: 1, 3: 1, 4: 1, 6: 1})
    assert all((r.score == 0) if r.lang_pred == "und" else (0 <= r.score <= 1) for r in got)
    kept = language.keep_identified(documents(spark, extra=True), model)
    assert kept.count() == 6 and kept.columns == documents(spark, extra=True).columns
    empty = language.fit(nothing(spark))
    assert {r.lang_pred for r in language.identify(documents(spark), empty).collect()} == {"und"}


# SimHash


def slow_fingerprint(text, n):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    rows = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in rows]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(values, near=3):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    values = sorted(root)
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= near:
                root[find(b)] = find(a)
    return {v: find(v) for v in values}


def expected_groups(rows, n):
    prints = [(d, slow_fingerprint(t, n)) for d, t in rows]
    comp = slow_components([p for _, p in prints])
    least = defaultdict(list)
    for d, p in prints:
        if d is not None:
            least[comp[p]].append(d)
    return Counter((d, p, min(least[comp[p]], default=None)) for d, p in prints)


def test_simhash_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    got = simhash.near_duplicates(docs, shingle=3).collect()
    found = Counter((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in got)
    assert found == expected_groups([(r.doc_id, r.text) for r in docs.collect()], 3)


def test_simhash_of_awkward_rows(spark):
    got = simhash.near_duplicates(documents(spark, extra=True)).collect()
    found = Counter((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in got)
    assert found == expected_groups([(r.doc_id, r.text) for r in documents(spark).collect()], 5)
    assert simhash.near_duplicates(nothing(spark)).count() == 0
    kept = simhash.keep_one(documents(spark, extra=True))
    assert kept.columns == documents(spark, extra=True).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4, 5, 7, 8]
    assert simhash.keep_one(nothing(spark)).count() == 0


@pytest.mark.parametrize("bucket", [2, 16, 2048])
def test_links_of_dense_and_scattered_fingerprints(spark, bucket):
    draw = random.Random(5)
    values = {draw.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for center in list(values)[:4]:
        for _ in range(40):
            v = center
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                v ^= 1 << bit
            values.add(v)
    values |= {0x0123456789ABC000 | k for k in range(40)}
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "value long")
    found = {v: v for v in values}
    for r in simhash.groups(frame, bucket).collect():
        found[r.value % (1 << 64)] = r.component % (1 << 64)
    want = slow_components(values)
    classes = lambda m: {frozenset(v for v in m if m[v] == c) for c in set(m.values())}
    assert classes(found) == classes(want)


def jaccard(one, two, n=5):
    sets = []
    for text in (one, two):
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def near_groups(rows):
    """Groups by fingerprints of three bits apart or four fifths of the shingles, from all pairs."""
    prints = [slow_fingerprint(t, 5) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            apart = (prints[i] ^ prints[j]).bit_count()
            if apart <= 3 or (apart <= 26 and jaccard(rows[i][1], rows[j][1]) >= 0.8):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def edited(text, draw, share):
    words = text.split(" ")
    for k in draw.sample(range(len(words)), max(1, int(len(words) * share))):
        words[k] = draw.choice(["otter", "harbour", "pebble", "lantern", ""]) + str(draw.random())[2:5]
    return " ".join(words)


def test_one_of_each_group_of_near_copies_stays(spark):
    draw = random.Random(11)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(150)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    line = "this very common passage opens a third of all the texts in here"
    rows = [(d, f"{line}\n{t}" if d % 3 == 0 else t) for d, t in rows]
    long = [t for _, t in rows if len(t.split()) > 100][:12]
    rows += [(1000 + k, edited(t, draw, s)) for k, (t, s) in enumerate(
        (t, s) for t in long for s in (0.002, 0.01, 0.015, 0.1))]
    crowd = long[0]
    rows += [(2000 + k, edited(crowd, draw, 0.004)) for k in range(40)]
    draw.shuffle(rows)
    root = near_groups(rows)
    want = sorted(min(rows[j][0] for j in range(len(rows)) if root[j] == r) for r in set(root))
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == want


def replaced(words, places, draw):
    out = list(words)
    for k in places:
        out[k] = f"new{draw.randrange(10**9)}"
    return out


@pytest.mark.parametrize("versions", [9, 45])
def test_tight_clusters_of_a_crowd_meet(spark, versions):
    draw = random.Random(26)
    one = [f"w{draw.randrange(10**9)}" for _ in range(300)]
    two = replaced(one, range(30, 280, 50), draw)
    rows = [
        (k, " ".join(replaced(words, [290], draw)))
        for k, words in enumerate([one] * versions + [two] * versions)
    ]
    assert 0.8 <= jaccard(rows[0][1], rows[versions][1]) < 0.85
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r.doc_id for r in kept.collect()] == [0]


def scattered(seed):
    """A crowd of versions too different to link, with one similar pair in the middle."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**9)}" for _ in range(300)]
    edits = [3 if k in (27, 54) else 6 for k in range(80)]
    return [(k, " ".join(replaced(base, draw.sample(range(5, 290, 6), n), draw))) for k, n in enumerate(edits)]


def test_a_similar_pair_is_found_among_nearer_fingerprints(spark):
    rows = scattered(1)
    root = near_groups(rows)
    want = sorted(min(rows[j][0] for j in range(len(rows)) if root[j] == r) for r in set(root))
    assert root[27] == root[54]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == want


def sole(rows, k):
    """The smaller of the two rows if they are similar by Jaccard alone, else the row."""
    return k & ~1 if jaccard(rows[k & ~1][1], rows[k | 1][1]) >= 0.8 else k


@pytest.mark.parametrize("added", ["before", "after"])
def test_words_added_at_an_end(spark, added):
    draw, rows = random.Random(7), []
    for size in [*range(10, 101, 5), 54]:
        for more in (1, 2, size // 6):
            words, own = ([f"w{draw.randrange(10**9)}" for _ in range(n)] for n in (size, more))
            longer = own + words if added == "before" else words + own
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(longer))]
    root = [sole(rows, k) for k in range(len(rows))]
    want = sorted(set(root))
    assert len(want) < len(rows) * 0.6
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_repeated_lines_do_not_part_similar_texts(spark):
    draw, rows = random.Random(13), []
    for size, line, times in [(60, 8, 40), (200, 12, 60), (400, 30, 200), (30, 5, 300)] * 4:
        words = [f"w{draw.randrange(10**9)}" for _ in range(size)]
        at = draw.randrange(size - line)
        repeated = words[at : at + line] * times
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words + repeated))]
    prints = [slow_fingerprint(t, 5) for _, t in rows]
    assert any((a ^ b).bit_count() > 24 for a, b in zip(prints[::2], prints[1::2], strict=True))
    want = sorted({sole(rows, k) for k in range(len(rows))})
    assert len(want) < len(rows) * 0.8
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_parity_bits_differ_no_more_than_the_sets():
    draw = np.random.default_rng(2)
    for size in (1, 40, 900, 5000):
        one = np.unique(draw.integers(0, 1 << 64, size, dtype=np.uint64))
        two = np.unique(np.append(one[size // 5 :], draw.integers(0, 1 << 64, size // 5, dtype=np.uint64)))
        differ = simhash._parity(one).view(np.uint64) ^ simhash._parity(two).view(np.uint64)
        assert np.bitwise_count(differ).sum() <= len(np.setxor1d(one, two))


def test_a_crowd_of_unlike_texts_costs_few_pairs(spark, monkeypatch):
    draw = random.Random(31)
    base = [f"w{draw.randrange(10**9)}" for _ in range(300)]
    rows = [(k, " ".join(replaced(base, draw.sample(range(5, 290, 6), 8), draw))) for k in range(150)]
    rows += [(1000 + k, " ".join(replaced(rows[k][1].split(), [298], draw))) for k in range(0, 150, 10)]
    draw.shuffle(rows)
    made, stored = [], simhash.stored

    def counted(df, label, compression=None):
        out = stored(df, label, compression)
        made.append(out.count() if label == "alike" else 0)
        return out

    root = near_groups(rows)
    want = sorted(min(rows[j][0] for j in range(len(rows)) if root[j] == r) for r in set(root))
    monkeypatch.setattr(simhash, "stored", counted)
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == want
    # some links each, and not the 13695 pairs
    assert 15 <= sum(made) < 20 * len(rows)


# Decontamination


def test_decontamination_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    want = con.sql(ORACLES["op9_decontamination"])
    got = QUERIES["op9_decontamination"](spark, FOLDER).select(*want.columns)
    rows = want.fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(rows)
    assert any(r[want.columns.index("contaminated")] for r in rows)


def slow_hits(text, items, window=10):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words, hit, found = word.findall((text or "").encode().lower()), set(), set()
    for item, body in items:
        own = word.findall((body or "").encode().lower())
        n = min(window, len(own))
        for s in range(len(own) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == own[s : s + n]:
                    hit |= set(range(at, at + n))
                    found |= {str(item)} if item is not None else set()
    return len(words), sorted(hit), sorted(found)


ITEMS = [
    (10, "over the MORNING water"),
    (9, "over the morning water"),
    (11, "otters gather pebbles near silver rivers while quiet herons watch wandering otters"),
    (12, None),
    (13, ""),
    (None, "grande chaise"),
    (14, "東京"),
    (14, "345"),
]


@pytest.mark.parametrize("pass_bytes", [1 << 20, 40])
def test_decontamination_of_awkward_rows(spark, pass_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, extra=True).filter("doc_id is null or doc_id != 5")
    got = decontamination.find(docs, items, pass_bytes=pass_bytes).collect()
    want = [(r.doc_id, *slow_hits(r.text, ITEMS)) for r in docs.collect()]
    key = repr
    assert sorted(((r.doc_id, r.n_words, r.hits, r.items) for r in got), key=key) == sorted(
        want, key=key
    )
    kept = decontamination.clean(docs, items, pass_bytes=pass_bytes)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 6, 8]
    cut = decontamination.clean(docs, items, "spans", pass_bytes=pass_bytes)
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[1] == "Quiet harbour lights drift  and the boats." and texts[3] is None
    assert decontamination.find(docs, items.limit(0)).filter("size(hits) > 0").count() == 0
    assert decontamination.find(nothing(spark), items).count() == 0


def test_whole_long_texts_are_scanned(spark):
    items = spark.createDataFrame([(1, "the very last words")], "item_id long, text string")
    docs = spark.createDataFrame([(5, LONG + "THE very last, words")], "doc_id long, text string")
    row = decontamination.find(docs, items).first()
    assert row.n_words == 33004 and row.hits == list(range(33000, 33004))


# Packing


def check_packing(rows, texts, size):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for doc, text in texts:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), size)):
            part = ids[start : start + size]
            want[doc, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        assert places[0][0] == 0 and sum(n for _, n in places) <= size
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))
    return len(bins), -(-sum(r.length for r in rows) // size)


def test_packing_of_the_documents(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    bins, least = check_packing(QUERIES["op8_best_fit_packing"](spark, FOLDER).collect(), texts, 4096)
    assert bins <= least + 3


@pytest.mark.parametrize("tasks", [3, 1000])
def test_packing_of_awkward_rows(spark, tasks):
    docs = documents(spark, extra=True)
    packed = packing.pack(docs, tokenizer_path(), length=64, task_pieces=tasks, with_ids=True)
    rows = packed.collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 64)
    whole = {r.sequence_id: (r.length, len(r.ids)) for r in packing.sequences(packed).collect()}
    assert all(n * 4 == size <= 256 for n, size in whole.values())
    assert packing.pack(nothing(spark), tokenizer_path()).count() == 0


def test_words_that_come_again_stay_known(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 50)
    own, learned = packing.Encoder(corpus_pipeline.tokenizer_path()), []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda words: (learned.extend(words), learn(words)))
    texts = [f"Again, {' '.join(f'own{k}x{n}.' for n in range(30))} again" for k in range(20)]
    found = [own.encode([t])[0] for t in texts]
    assert learned.count("again") == 1 and len(own.known) + len(own.older) < 250
    assert found == packing.Encoder(corpus_pipeline.tokenizer_path()).encode(texts)


def test_a_bounded_number_of_bins_stays_open():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 5, 7)] == [(0, 0), (1, 0), (2, 0)]
    assert bins.open == 2  # the third piece closed its own bin, the fullest
    assert bins.place(3) == (0, 6)
    assert bins.place(6) == (3, 0) and bins.open == 2


# The pipeline


def test_pipeline_keeps_what_its_stages_decide(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = {r.doc_id for r in quality.score(docs, model).collect() if r.predicted}
    assert {r.doc_id for r in quality.keep_good(docs, model).collect()} == kept
    known = {d for d in kept if any(map(str.isalpha, texts[d]))}
    rows = [(d, texts[d]) for d in sorted(known)]
    root = near_groups(rows)
    kept = {min(rows[j][0] for j in range(len(rows)) if root[j] == r) for r in set(root)}
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    windows = decontamination.Windows([(str(r.item_id), r.text.encode()) for r in items])
    kept = {d for d in kept if not len(windows.scan([texts[d].encode()])[0][1])}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == kept
    check_packing(rows, [(d, texts[d]) for d in kept], 4096)


def test_pipeline_stages_stand_awkward_and_empty_rows(spark):
    for rows in (documents(spark, extra=True), nothing(spark)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            if name != "packing":
                assert docs.columns == rows.columns
        docs.count()


def test_item_list_digest(spark):
    row = QUERIES["op9_decontamination"](spark, FOLDER).filter("not contaminated").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()


def test_the_identified_language_steers_the_packing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(200)
    unmarked = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    kept = corpus_pipeline.identified_documents(spark, unmarked, FOLDER)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    found = {r.doc_id: r.lang for r in kept.collect()}
    assert None not in found.values() and len(set(found.values())) > 1
    packed = corpus_pipeline.packed_sequences(spark, kept, FOLDER).collect()
    of_sequence = defaultdict(set)
    places = defaultdict(list)
    for r in packed:
        assert r.lang == found[r.doc_id]
        of_sequence[r.sequence_id].add(r.lang)
        places[r.sequence_id].append((r.offset, r.length))
    assert all(len(languages) == 1 for languages in of_sequence.values())
    for rows in places.values():
        end = 0
        for offset, length in sorted(rows):
            assert offset == end
            end += length
        assert end <= 4096

"""Toxicity: folding, exceptions, awkward rows, held-out marks."""

import zlib

from tarmac.llm import toxicity
from tarmac.llm.common import read
from tests.llm.cases import documents, nothing

FOLDER = "/root/testdata/sf0.01"


def scores(spark, model, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.score for r in sorted(toxicity.score(df, model).collect())]


def test_folding():
    assert toxicity.folded("An 1D10T, іdіоt\n$cum! M0r0n") == " an idiot idiot scum moron "
    assert toxicity.folded("") == toxicity.folded(" ?! ") == "  "


def test_neighbouring_hits_and_exceptions(spark):
    model = toxicity.Lexicon({"idiot": 7.0, "trash": 7.0}, {"trash bin": 7.0})
    both, once, taken, clean = scores(spark, model, "idiot trash", "the idiot", "a trash bin", "quiet idiotic words")
    assert both > once > 0.5 and taken == clean == 0
    assert scores(spark, model, "idiot " + "calm " * 100_000)[0] < 0.5


def test_entries_that_meet_in_a_word():
    kept = toxicity._apart([("idio*", 5, 9), ("idiot", 5, 9), ("lowe*", 4, 8), ("lowei*", 4, 8), ("loweis", 4, 3)])
    assert set(kept) == {"idiot", "lowei*"}


def test_stems_and_exceptions_are_learned(spark):
    texts = [(i, f"calm words zorbel{chr(97 + i % 20)}k and mud", 1) for i in range(200)]
    texts += [(i, f"calm words about a mud bath and w{i}", 0) for i in range(200, 400)]
    df = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.drop("toxic"), df.drop("text"))
    assert list(model.words) == ["zorbel*"] and model.exceptions == {}
    assert [s > 0.5 for s in scores(spark, model, "Z0RBELxyz!", "a zorb", "mud")] == [True, False, False]


def test_awkward_rows(spark):
    docs = documents(spark, extra=True)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, none)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count() and all((r.score, r.predicted) == (0, 0) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id or "").encode()) % 5 == 0) for r in rows if r.doc_id)
    assert toxicity.score(nothing(spark), model).count() == 0


def test_held_out_rows(spark):
    docs, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    clean = [r.predicted for r in rows if r.toxic == 0]
    toxic = [r.predicted for r in rows if r.toxic == 1]
    assert sum(clean) <= 0.02 * len(clean) and sum(toxic) >= 0.4 * len(toxic)

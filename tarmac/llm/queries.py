"""The operators as checked queries over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (
    decontamination,
    language,
    licences,
    maxent,
    neighbours,
    packing,
    periodic,
    prefixes,
    quality,
    simhash,
    toxicity,
    warc,
    wrappers,
)
from tarmac.llm.common import read, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op3_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, folder, "labels")))


@query
def op4_language_kernel(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return language.identify(docs, language.fit(docs))


@query
def op7_simhash_pigeonring(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"), shingle=3)
    bits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.withColumn("fingerprint", bits)


@query
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), tokenizer_path())


@query
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    hits = F.size("hits").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


ORACLES["op9_decontamination"] = """
with item_words as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from benchmark where text is not null
), windows as (
    select distinct item_id, least(10, len(w)) as n,
        list_slice(w, s, s + least(10, len(w)) - 1) as words
    from item_words, unnest(range(1, len(w) - least(10, len(w)) + 2)) as t(s)
    where len(w) > 0
), doc_words as (
    select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from documents
), spans as (
    select r, s, n, list_slice(w, s, s + n - 1) as words
    from doc_words, (select distinct n from windows), unnest(range(1, len(w) - n + 2)) as t(s)
), found as (
    select spans.r, spans.s, spans.n, windows.item_id from spans join windows using (n, words)
), hit as (
    select r, count(distinct p) as n_hit from found, unnest(range(s, s + n)) as t(p) group by r
), items as (
    select r, count(distinct item_id) as n_items,
        string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as listed
    from found group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit using (r) left join items using (r)
"""


@query
def op2_warc_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(read(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLES["op2_warc_normalise"] = """
with payloads as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
        sha1(coalesce(html, '')) as digest
    from pages
), numbered as (
    select *, max(page_id) over (partition by digest) as newest from payloads
), written as (
    select *, list_aggregate(list_transform(range(0, 32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(digest, 1 + 5 * (i // 4), 5))::bigint) >> (15 - 5 * (i % 4))) & 31)::int + 1,
        1)), 'string_agg', '') as payload_digest
    from numbered
)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
    case when page_id = newest then 'response' else 'revisit' end as record_type,
    case when page_id <> newest then newest end as refers_to
from written
"""


@query
def op6_wrapper_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extract(read(spark, folder, "pages"))


@query
def op5_maxent_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.score(read(spark, folder, "documents"))


@query
def op10_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_duplicates(read(spark, folder, "embeddings"))


ORACLES["op10_nn_descent"] = """
with recursive usable as (
    select row_number() over () as r, vec_id, embedding::double[] as v
    from embeddings
    where embedding is not null and len(embedding) > 0 and list_count(embedding) = len(embedding)
        and list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
        and list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links as (
    select a.r as a, b.r as b, a.vec_id as a_id, b.vec_id as b_id
    from usable a join usable b on a.r <> b.r
    where len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9
), reached as (
    select r, vec_id as least from usable
    union
    select links.b, reached.least from reached join links on links.a = reached.r
), component as (
    select r, min(least) as component_id from reached group by r
), counted as (
    select a as r, count(*) as n_links from links group by a
)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from usable join component using (r) left join counted using (r)
union all
select vec_id, 0, vec_id, true from embeddings
where embedding is null or len(embedding) = 0 or list_count(embedding) <> len(embedding)
    or not list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
    or not list_bool_or(list_transform(embedding, lambda x: x <> 0))
"""


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.document_licences(read(spark, folder, "documents"))


WORD = "[^\\x20\\x09-\\x0D]+"


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    # every tenth text repeats its words from a on with period p
    cut = docs.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    cut = cut.withColumn("n", F.size("words")).filter("h % 10 = 0 and n > 0")
    cut = cut.withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.col("g") % F.col("n"))
    cut = cut.withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    cycled = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)])), ' ')")
    cycled = cut.select("doc_id", cycled.alias("text"))
    plain = docs.withColumn("h", h).filter((F.col("h") % 10 != 0) | (F.size(words) <= 0) | F.col("text").isNull())
    found = periodic.periodic_runs(plain.select("doc_id", "text").union(cycled))
    best = periodic.longest()
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["start"]).alias("start"),
        best["length"].alias("length"),
        (-best["period"]).alias("period"),
        F.floor(1000 * best["length"] / -best["period"]).alias("exponent_milli"),
        "runs_sha256",
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_toxicity_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, folder, "labels")))


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    own = stored(prefixes.sequences(read(spark, folder, "conversations")), "conversations")
    heads = own.filter("conv_id % 100 = 0").selectExpr("conv_id as base", "slice(steps, 1, 5) as head")
    cut = own.withColumn("base", F.expr("conv_id - conv_id % 100"))
    cut = cut.withColumn("h", F.expr("cast(crc32(cast(cast(conv_id as string) as binary)) % 6 as int)"))
    rebuilt = "concat(slice(coalesce(head, slice(steps, 1, 0)), 1, h), slice(steps, h + 1, greatest(size(steps) - h, 0)))"
    return prefixes.trie(cut.join(heads, "base", "left").selectExpr("conv_id", f"{rebuilt} as steps"))

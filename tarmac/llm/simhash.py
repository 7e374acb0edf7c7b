"""SimHash near duplicates with pigeonring filtering.

A fingerprint takes, bit by bit, the majority of the hashes of a text's word
shingles. Two fingerprints link if they differ in at most three of 64 bits.

Candidates: the bits form a ring of eight segments. If two fingerprints differ
in at most t bits, some segment starts a chain whose first l segments differ in
at most floor(l * t / 8) bits together, for every l. For t = 3 the first two
segments of that chain are equal and the next three hold one difference at
most, so one half of their 24 bits is equal too. Fingerprints are dealt by
these 28 bits for each start and half; the other chain budgets are checked
before the full difference. Only a spanning forest of the links of a bucket is
kept, never all its pairs.

``keep_one`` also links texts that share four fifths of their shingles, whose
fingerprints mostly lie further apart: they meet by their rarest shingles, of which
such texts share one, are pruned by the numbers of their distinct shingles, and
compared shingle by shingle. In crowds, bits of the shingles' parity prune them too.

A bucket beyond a fixed size is dealt again: of its other 36 bits, three of six
equal parts must agree, which leaves 18 bits. A part that is still too large is
linked by stars: all fingerprints that agree after three of the 18 bits are
blanked link with the smallest of them. Both give the same links as comparing
all pairs, with work in proportion to the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import components, free_name, map_batches, stored, utf8

SHINGLE, SEED, NEAR = 5, 42, 3
SEGMENTS, WIDTH = 8, 8
#: Distinct fingerprints that are compared in one bucket; larger ones are dealt again.
BUCKET = 2048
#: Similarity of near copies.
SIMILAR = 0.8
#: Rows of a key that are compared at once. In larger crowds each row is compared with
#: the next few first, then with all that this did not link, in blocks of rows.
CROWD, NEXT, BLOCK = 64, 4, 1024
#: Words of 64 bits that tell the texts of a crowd apart: of use up to 2000 shingles a text.
PARITY = [f"parity_{k}" for k in range(16)]
_HELD_LINKS = 1 << 20
_BITS_AT_ONCE = 1 << 15


def _budget(chain: int) -> int:
    return chain * NEAR // SEGMENTS


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the text's word shingles, repeats included; a shorter text is one shingle."""
    words = text.lower().split()
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= shingle:
        return np.array([digest(join(words), SEED)] if words else [], dtype="<u8")
    rows = zip(*(words[k:] for k in range(shingle)), strict=False)
    return np.array([digest(join(row), SEED) for row in rows], dtype="<u8")


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BITS_AT_ONCE):
        part = hashes[at : at + _BITS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint16 if len(bits) < 65536 else np.int64)
    set_bits = np.flatnonzero(2 * counts > len(hashes))
    return sum(1 << int(b) for b in set_bits)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the text's word shingles, repeats included."""
    return _majority(shingle_hashes(text, shingle))


def with_fingerprints(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """The table with one more column: the fingerprint as a signed long."""
    source = free_name(docs, "text_bytes")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle) for t in batch[source].to_pylist()]
            prints = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(prints)], names=[*names, name]
            )

    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    return map_batches(docs.withColumn(source, utf8("text")), added, schema)


def _rotated(value: Column, bits: int) -> Column:
    if not bits:
        return value
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def _rotate(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    bits = bits.astype(np.uint64)
    return np.where(
        bits == 0, values, values << bits | values >> ((np.uint64(64) - bits) % np.uint64(64))
    )


def _keys(value: Column) -> Column:
    """The 16 buckets of a fingerprint: start and half above 28 equal bits."""
    out = []
    for start in range(SEGMENTS):
        turned = _rotated(value, start * WIDTH)
        first = F.shiftrightunsigned(turned, 36)
        last = F.shiftleft(F.shiftrightunsigned(turned, 48), 12).bitwiseOR(
            F.shiftrightunsigned(turned, 24).bitwiseAND(F.lit(0xFFF).cast("long"))
        )
        for half, bits in enumerate((first, last)):
            out.append(F.lit((2 * start + half) << 28).cast("long").bitwiseOR(bits))
    return F.array(*out)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as connect what the given links connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def _linked(keys: np.ndarray, values: np.ndarray, chained: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of equal keys, which come sorted; as a spanning forest."""
    starts = keys >> 29 if chained else None
    turned = _rotate(values, starts * WIDTH) if chained else values
    left, right, held = [], [], 0
    rows, shift = np.arange(len(keys)), 1
    while len(rows):
        rows = rows[rows + shift < len(keys)]
        rows = rows[keys[rows] == keys[rows + shift]]
        differ = turned[rows] ^ turned[rows + shift]
        near = np.bitwise_count(differ) <= NEAR
        if chained:
            for chain in range(1, SEGMENTS):
                tops = differ >> np.uint64(64 - chain * WIDTH)
                near &= np.bitwise_count(tops) <= _budget(chain)
        found = rows[near]
        left.append(values[found])
        right.append(values[found + shift])
        held += len(found)
        if held > _HELD_LINKS:
            a, b = forest(np.concatenate(left), np.concatenate(right))
            left, right, held = [a], [b], len(a)
        shift += 1
    if not held:
        return values[:0], values[:0]
    return forest(np.concatenate(left), np.concatenate(right))


def _bucket_links(chained: bool, most: int):
    """Streams rows sorted by key; yields links, and rows of buckets beyond ``most``."""

    def batch_of(kind: int, key, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(a), kind, dtype=np.int32)),
                pa.array(np.asarray(key, dtype=np.int64)),
                pa.array(a.view(np.int64)),
                pa.array(b.view(np.int64)),
            ],
            names=["kind", "key", "a", "b"],
        )

    def settled(keys: np.ndarray, values: np.ndarray, large: set[int]) -> Iterator[pa.RecordBatch]:
        runs = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
        sizes = np.diff(np.append(runs, len(keys)))
        over = np.repeat((sizes > most) | np.isin(keys[runs], list(large)), sizes)
        if over.any():
            yield batch_of(1, keys[over], values[over], values[over])
        a, b = _linked(keys[~over], values[~over], chained)
        if len(a):
            yield batch_of(0, np.zeros(len(a)), a, b)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        large: set[int] = set()  # the key at hand, once part of its bucket was passed on
        for batch in batches:
            keys = np.concatenate([keys, batch["key"].to_numpy()])
            values = np.concatenate([values, batch["value"].to_numpy().view(np.uint64)])
            if len(keys) < 16 * most:
                continue
            end = np.searchsorted(keys, keys[-1])
            if len(keys) - end > most:
                yield from settled(keys, values, large)
                large = {int(keys[-1])}
                keys, values = keys[:0], values[:0]
            elif end:
                yield from settled(keys[:end], values[:end], large)
                large = large & {int(keys[-1])}
                keys, values = keys[end:], values[end:]
        if len(keys):
            yield from settled(keys, values, large)

    return linked


_FOUND = "kind int, key long, a long, b long"
_PARTS = list(combinations(range(6), 3))


def _again(rows: DataFrame) -> DataFrame:
    """Large buckets by (bucket, three of the six parts of the other 36 bits)."""
    c = F.col
    turned = c("a")
    for start in range(1, SEGMENTS):
        turned = F.when(
            F.shiftrightunsigned(c("key"), 29) == start, _rotated(c("a"), start * WIDTH)
        ).otherwise(turned)
    second = F.shiftrightunsigned(c("key"), 28).bitwiseAND(F.lit(1).cast("long")) == 1
    middle = F.when(second, F.shiftrightunsigned(turned, 36)).otherwise(
        F.shiftrightunsigned(turned, 24)
    )
    other = F.shiftleft(middle.bitwiseAND(F.lit(0xFFF).cast("long")), 24).bitwiseOR(
        turned.bitwiseAND(F.lit(0xFFFFFF).cast("long"))
    )
    keys = []
    for number, chosen in enumerate(_PARTS):
        mask = sum(0x3F << (6 * part) for part in chosen)
        free = ~mask & ((1 << 36) - 1)
        keys.append(
            F.struct(
                F.xxhash64("key", F.lit(number), c("other").bitwiseAND(F.lit(mask).cast("long"))).alias("key"),
                F.lit(free).cast("long").alias("free"),
            )
        )
    return (
        rows.select("key", "a", other.alias("other"))
        .withColumn("sub", F.explode(F.array(*keys)))
        .select(
            F.col("sub.key").alias("key"),
            c("a").alias("value"),
            "other",
            F.col("sub.free").alias("free"),
        )
    )


def _stars(rows: DataFrame) -> DataFrame:
    """Links of parts with 18 open bits: blank any three, link with the smallest."""
    c = F.col
    places = F.filter(
        F.sequence(F.lit(0), F.lit(35)), lambda k: F.bit_get(c("free"), k) == F.lit(1)
    )
    single = F.transform(places, lambda k: F.pow(F.lit(2.0), k).cast("long"))
    triples = F.array(
        *[
            F.element_at("bits", i + 1) + F.element_at("bits", j + 1) + F.element_at("bits", k + 1)
            for i, j, k in combinations(range(18), 3)
        ]
    )
    rest = c("other") - c("other").bitwiseAND(c("blank"))
    blanked = (
        rows.withColumn("bits", single)
        .select("key", "value", "other", F.explode(triples).alias("blank"))
        .select(F.xxhash64("key", "blank", rest).alias("star"), "value")
    )
    least = blanked.groupBy("star").agg(F.min("value").alias("least"))
    return blanked.join(least, "star").select(
        F.col("value").alias("a"), F.col("least").alias("b")
    )


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect the given distinct fingerprints ``value`` as all
    pairs of at most three differing bits would."""
    spark = prints.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = prints.select(F.explode(_keys(F.col("value"))).alias("key"), "value")
    sorted_rows = keyed.repartition(parts, "key").sortWithinPartitions("key")
    found = stored(map_batches(sorted_rows, _bucket_links(True, bucket), _FOUND), "simhash")
    out = found.filter("kind = 0").select("a", "b")
    large = found.filter("kind = 1").select("key", "a")
    if large.isEmpty():
        return out
    parted = stored(_again(large), "simhash")
    again = parted.select("key", "value").repartition(parts, "key").sortWithinPartitions("key")
    more = stored(map_batches(again, _bucket_links(False, bucket), _FOUND), "simhash")
    out = out.union(more.filter("kind = 0").select("a", "b"))
    dense = more.filter("kind = 1").select("key").distinct()
    if dense.isEmpty():
        return out
    return out.union(_stars(parted.join(dense, "key", "left_semi")))


def groups(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """value and component of each fingerprint that has links to smaller ones."""
    return components(links(prints, bucket)).select(
        F.col("node").alias("value"), "component"
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (signed long) and component_id of every row.

    Texts without words, null ones included, have fingerprint zero and link like
    any other. component_id is the smallest doc_id that links reach. Repeated rows
    repeat, extra columns are left behind; a group of null doc_ids only has none.
    """
    prints = stored(
        with_fingerprints(docs.select("doc_id", "text"), "value", shingle).select("doc_id", "value"),
        "fingerprints",
    )
    least = stored(prints.groupBy("value").agg(F.min("doc_id").alias("least")), "fingerprints")
    reached = least.join(groups(least.select("value"), bucket), "value", "left").select(
        "value", "least", F.coalesce("component", "value").alias("component")
    )
    first = reached.groupBy("component").agg(F.min("least").alias("component_id"))
    named = reached.join(first, "component").select("value", "component_id")
    return prints.join(named, "value", "left").select(
        "doc_id", F.col("value").alias("fingerprint"), "component_id"
    )


# Near copies of a given similarity


def _set_of(hashes: np.ndarray) -> np.ndarray:
    """The distinct hashes in order; texts without words have one of their own."""
    return np.unique(hashes) if len(hashes) else np.zeros(1, dtype="<u8")


def _counted(hashes: np.ndarray) -> np.ndarray:
    """The half of all shingles whose texts are counted; texts meet by these first."""
    return hashes % 2 == 0


def _with_sets(docs: DataFrame, names: dict[str, str], shingle: int) -> DataFrame:
    """The table with the fingerprint of each text, the hash of its set of shingles
    (its unit), their number, and how many of them are counted."""
    source, columns = free_name(docs, "text_bytes"), docs.columns
    made = [names[k] for k in ("value", "unit", "size", "counted")]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = []
            for text in batch[source].to_pylist():
                hashes = shingle_hashes(text, shingle)
                own = _set_of(hashes)
                unit = xxhash.xxh64_intdigest(own.tobytes(), SEED)
                numbers.append((_majority(hashes), unit, len(own), int(_counted(own).sum())))
            numbers = np.array(numbers, dtype=np.uint64).reshape(-1, 4).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in columns), *(pa.array(n.copy()) for n in numbers.T)],
                names=[*columns, *made],
            )

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in made)])
    return map_batches(docs.withColumn(source, utf8("text")), added, schema)


def _prefix(size: int, least: float) -> int:
    """Of ``size`` shingles in any order that all texts follow, the first this many
    hold one that a similar text has among its own first ones."""
    return size - math.ceil(least * size - 1e-9) + 1


def _may(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Whether rows i and j can be similar if their key is the first that they share:
    by their sizes and by what comes after that key."""
    one, two = rows["size"][i], rows["size"][j]
    rest = np.minimum(one - rows["place"][i], two - rows["place"][j])
    good = np.minimum(one, two) >= least * np.maximum(one, two) - 1e-6
    return good & (rest >= least / (1 + least) * (one + two) - 1e-6)


def _runs(names: list[str], run: str, cut: int, found):
    """Streams rows sorted by ``run``; yields what is found in whole runs. A run beyond
    ``cut`` rows is cut."""

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new, n_new = {n: np.zeros(0, np.int64) for n in names}, [], 0
        for batch in batches:
            new.append(batch)
            n_new += batch.num_rows
            if n_new < max(_BITS_AT_ONCE, len(held[run])):
                continue
            held = {n: np.concatenate([h, *(b[n].to_numpy() for b in new)]) for n, h in held.items()}
            new, n_new = [], 0
            end = int(np.searchsorted(held[run], held[run][-1]))
            if len(held[run]) - end > cut:
                end = len(held[run])
            if end:
                yield from found({n: h[:end] for n, h in held.items()})
                held = {n: h[end:] for n, h in held.items()}
        held = {n: np.concatenate([h, *(b[n].to_numpy() for b in new)]) for n, h in held.items()}
        if len(held[run]):
            yield from found(held)

    return streamed


def _pairs_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
    )


def _begins(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _shared(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The keys that several units have, with the number of these."""
    once = _begins(rows["key"], rows["unit"])
    rows = {n: r[once] for n, r in rows.items()}
    begins = _begins(rows["key"])
    counts = np.diff(np.append(begins, len(once)))
    n = np.repeat(counts, counts)
    rows = [rows["key"], rows["unit"], rows["place"], n]
    yield pa.RecordBatch.from_arrays(
        [pa.array(r[n > 1].astype(np.int64)) for r in rows], names=["key", "unit", "place", "n"]
    )


def _first_pairs(least: float):
    """Of keys of up to ``CROWD`` rows all pairs; in a crowd those of each row with the
    next ones by size, and with the first, which leaves work in proportion to the rows."""

    def pairs(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = rows["key"]
        begins = _begins(keys)
        counts = np.diff(np.append(begins, len(keys)))
        crowded = np.repeat(counts, counts) > CROWD
        at = np.arange(len(keys))
        for shift in range(1, CROWD):
            at = at[at + shift < len(keys)]
            at = at[(keys[at] == keys[at + shift]) & (~crowded[at] | (shift <= NEXT))]
            found = at[_may(rows, at, at + shift, least)]
            yield _pairs_of(rows["unit"][found], rows["unit"][found + shift])
        first = np.repeat(begins, counts)
        at = np.flatnonzero(crowded & (np.arange(len(keys)) - first > NEXT))
        found = at[_may(rows, first[at], at, least)]
        yield _pairs_of(rows["unit"][first[found]], rows["unit"][found])

    return _runs(["key", "unit", "size", "place"], "key", 16 * _BITS_AT_ONCE, pairs)


def _parity(hashes: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of the distinct hashes fall on them. Sets differ
    in at least as many hashes as their bits."""
    bits = np.bincount(hashes >> np.uint64(1) & np.uint64(64 * len(PARITY) - 1), minlength=64 * len(PARITY))
    return np.packbits((bits & 1).astype(np.uint8), bitorder="little").view("<i8")


def _parities(units: DataFrame, texts: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """The parity bits of the wanted units."""
    # stored, so that its size is known and few of them need no shuffle of all texts
    wanted = stored(units.join(wanted, "unit", "left_semi").select("unit", "row"), "wanted")
    source = texts.select("row", utf8("text").alias("text")).join(wanted, "row").select("unit", "text")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [_parity(_set_of(shingle_hashes(t, shingle))) for t in batch["text"].to_pylist()]
            bits = np.array(bits, dtype=np.int64).reshape(-1, len(PARITY))
            yield pa.RecordBatch.from_arrays(
                [batch["unit"], *(pa.array(b.copy()) for b in bits.T)], names=["unit", *PARITY]
            )

    return map_batches(source, added, ", ".join(f"{n} long" for n in ["unit", *PARITY]))


def _other_pairs(least: float):
    """All pairs of a group that are on different sides, not linked yet, and whose parity
    bits differ in no more places than the sets of similar texts do."""

    def pairs(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        groups, ids, sizes = rows["group"], rows["unit"], rows["size"]
        parity = np.stack([rows[n] for n in PARITY], axis=1).view(np.uint64)
        ends = np.searchsorted(groups, groups, side="right")
        left, right, held = [], [], 0
        for i in range(len(groups)):
            j = np.arange(i + 1, ends[i])
            j = j[(rows["side"][j] != rows["side"][i]) & (rows["component"][j] != rows["component"][i])]
            j = j[_may(rows, np.full(len(j), i), j, least)]
            differ = np.bitwise_count(parity[j] ^ parity[i]).sum(axis=1, dtype=np.int64)
            j = j[differ <= (1 - least) / (1 + least) * (sizes[j] + sizes[i]) + 1e-6]
            left.append(np.full(len(j), ids[i]))
            right.append(ids[j])
            held += len(j)
            if held > _HELD_LINKS:
                yield _pairs_of(np.concatenate(left), np.concatenate(right))
                left, right, held = [], [], 0
        if held:
            yield _pairs_of(np.concatenate(left), np.concatenate(right))

    names = ["group", "unit", "size", "place", "side", "component", *PARITY]
    return _runs(names, "group", 1 << 62, pairs)


def _crowds(
    dealt: DataFrame, reached: DataFrame, units: DataFrame, texts: DataFrame, shingle: int
) -> DataFrame:
    """The rows of crowds that are not linked as a whole, with their parity bits, in groups
    of two blocks each: each pair of a crowd is in one group, on different sides of it."""
    c = F.col
    named = dealt.join(reached.withColumnRenamed("node", "value"), "value", "left").withColumn(
        "component", F.coalesce("component", "value")
    )
    open_keys = (
        named.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter((c("n") > CROWD) & (c("lo") != c("hi")))
        .select("key", F.ceil(c("n") / BLOCK).alias("blocks"))
    )
    block = F.pmod(F.xxhash64("unit"), c("blocks"))
    met = stored(named.join(open_keys, "key").withColumn("block", block), "crowds")
    met = met.join(_parities(units, texts, met.select("unit").distinct(), shingle), "unit")
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), c("blocks") - 1)))
    group = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    # within one block every row is a side of its own
    side = F.when(c("block") == c("other"), c("unit")).otherwise(c("block"))
    return met.select(group.alias("group"), side.alias("side"), *dealt.columns, "component", *PARITY)


def _similar(pairs: DataFrame, units: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs of units whose sets of word shingles are similar enough (Jaccard)."""
    c = F.col
    needed = pairs.select(c("a").alias("unit")).union(pairs.select("b")).distinct()
    needed = stored(units.join(needed, "unit", "left_semi").select("unit", "row"), "wanted")
    some = texts.select("row", utf8("text").alias("text")).join(needed, "row")
    some = stored(some.select("unit", "text"), "alike_texts", "zstd")
    met = pairs.join(some.select(c("unit").alias("a"), c("text").alias("left")), "a").join(
        some.select(c("unit").alias("b"), c("text").alias("right")), "b"
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(16)
        def shingles(text: bytes) -> set:
            words = text.lower().split()
            if len(words) <= shingle:
                return {tuple(words)}
            return set(zip(*(words[k:] for k in range(shingle)), strict=False))

        for batch in batches:
            good = []
            for left, right in zip(batch["left"].to_pylist(), batch["right"].to_pylist(), strict=True):
                one, two = shingles(left), shingles(right)
                both = len(one & two)
                good.append(both >= least * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return map_batches(met.select("a", "b", "left", "right"), compared, "a long, b long")


def _dealt(texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """Rows (key, unit, place): the counted shingles of each text, whose place follows
    from their numbers, and as many others, by hash, as its prefix needs beyond these."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in (keys, units, places)]
            return pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns], names=["key", "unit", "place"]
            )

        for batch in batches:
            keys, units, places, held = [], [], [], 0
            for text, unit in zip(batch["text"].to_pylist(), batch["unit"].to_pylist(), strict=True):
                hashes = _set_of(shingle_hashes(text, shingle))
                counted = _counted(hashes)
                first, other = hashes[counted], hashes[~counted]
                other = other[: max(0, _prefix(len(hashes), least) - len(first))]
                keys += [first.view(np.int64), other.view(np.int64)]
                units.append(np.full(len(first) + len(other), unit))
                places += [np.full(len(first), -1), len(first) + np.arange(len(other))]
                held += len(units[-1])
                if held > _HELD_LINKS:
                    yield batch_of()
                    keys, units, places, held = [], [], [], 0
            if held:
                yield batch_of()

    source = texts.select("unit", utf8("text").alias("text"))
    return map_batches(source, dealt, "key long, unit long, place long")


def _telling(units: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """The shingles (key, unit, value, size, place) by which similar texts find each other.

    All texts order their distinct shingles alike: the counted ones first, rarest
    first, then the others by hash. Two texts of the similarity share one of the first
    n - ceil(least * n) + 1 of each. Shingles of one text only keep their place, but
    need not be dealt.
    """
    c = F.col
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(texts, shingle, least).repartition(parts, "key").sortWithinPartitions("key", "unit")
    shared = map_batches(
        dealt, _runs(["key", "unit", "place"], "key", 1 << 62, _shared),
        "key long, unit long, place long, n long",
    )
    shared = stored(shared, "shared")
    listed = (
        shared.filter("place < 0")
        .groupBy("unit")
        .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("shared"))
    )
    own = c("counted") - F.size("shared")
    prefix = c("size") - F.ceil(c("size") * least - 1e-9) + 1
    first = F.slice("shared", F.lit(1), F.greatest(prefix - own, F.lit(0)).cast("int"))["key"]
    columns = ["key", "unit", "value", "size", "place"]
    counted = units.join(listed, "unit").select(
        "unit", "value", "size", own.alias("own"), F.posexplode(first).alias("at", "key")
    )
    others = shared.filter("place >= 0").join(units, "unit")
    return counted.withColumn("place", c("own") + c("at")).select(columns).union(others.select(columns))


def similar_links(
    units: DataFrame,
    texts: DataFrame,
    linked: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILAR,
) -> DataFrame:
    """Links (a, b) between the ``value``s of similar texts: units (unit, row, value,
    size, counted), all texts (row, unit, text), and the links (a, b) of values known so
    far. Together with these they connect what all pairs would.

    Texts that share a telling shingle are compared by their whole sets of shingles;
    only those that pass the counts are fetched. A crowd is compared in two rounds, so
    that texts that the first one linked are not compared again.
    """
    c = F.col
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def links_of(pairs: DataFrame) -> DataFrame:
        alike = _similar(stored(pairs.distinct(), "alike"), units, texts, shingle, similarity)
        one, two = (units.select(c("unit").alias(k), c("value").alias(f"value_{k}")) for k in "ab")
        named = alike.join(one, "a").join(two, "b")
        return stored(named.select(c("value_a").alias("a"), c("value_b").alias("b")), "similar")

    dealt = stored(_telling(units, texts, shingle, similarity), "telling")
    ordered = dealt.repartition(parts, "key").sortWithinPartitions("key", "size", "unit")
    first = links_of(map_batches(ordered, _first_pairs(similarity), "a long, b long"))
    if dealt.groupBy("key").count().filter(c("count") > CROWD).isEmpty():
        return first
    rest = _crowds(dealt, components(first.union(linked)), units, texts, shingle)
    ordered = rest.repartition(parts, "group").sortWithinPartitions("group")
    return first.union(links_of(map_batches(ordered, _other_pairs(similarity), "a long, b long")))


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET, similarity: float | None = SIMILAR
) -> DataFrame:
    """One row of each group, that of the smallest doc_id, with all its columns.

    Groups are linked by fingerprints, and with ``similarity`` also by the shared
    shingles of texts whose fingerprints lie further apart than three bits. Equal
    doc_ids are told apart by their text; of equal rows one stays.
    """
    columns = docs.columns
    made = ("value", "unit", "size", "counted", "row")
    names = {k: free_name(docs, f"simhash_{k}") for k in made}
    rows = _with_sets(docs, names, shingle).withColumn(names["row"], F.monotonically_increasing_id())
    rows = stored(rows, "fingerprints", "zstd")
    own = rows.select(*(F.col(names[k]).alias(k) for k in names), "doc_id", "text")
    keys = own.select(
        "value",
        "row",
        F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.col("row")).alias("place"),
    )
    edges = links(keys.select("value").distinct(), bucket)
    if similarity is not None:
        # one row of each set of shingles stands for all with it, whatever they repeat
        least = [F.min(k).alias(k) for k in ("row", "value", "size", "counted")]
        units = stored(own.groupBy("unit").agg(*least), "distinct")
        same = own.select("unit", F.col("value").alias("a")).distinct()
        same = same.join(units.select("unit", F.col("value").alias("b")), "unit").select("a", "b")
        edges = edges.union(same.filter("a != b"))
        edges = edges.union(
            similar_links(units, own.select("row", "unit", "text"), edges, shingle, similarity)
        )
    reached = components(edges).select(F.col("node").alias("value"), "component")
    first = (
        keys.join(reached, "value", "left")
        .groupBy(F.coalesce("component", "value").alias("component"))
        .agg(F.min("place").alias("place"))
        .select(F.col("place.row").alias(names["row"]))
    )
    return rows.join(first, names["row"], "left_semi").select(*columns)

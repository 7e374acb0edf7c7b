"""Conversation prefix trie by van Emde Boas recursion.

A stretch of depths is cut at half: the prefix above the cut is named, the name is
the root of the lower forest, and both halves are cut again. So depth ``d`` is named
from depth ``d - low(d)``, ``low`` its lowest set bit, and the turns between. All
tries of one size are built at once; their totals are grafted upward, small ones
first: the total of a lower root goes to the ``low(d)`` nodes above it, once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import map_batches, stored

ROOT = hashlib.md5(b"").digest()
#: Rows that a task sends at once.
ROWS = 2000
NAME = ["n1", "n2"]


def _pair(name: bytes) -> tuple[int, int]:
    return int.from_bytes(name[:8], "big", signed=True), int.from_bytes(name[8:], "big", signed=True)


def names(keys: list[bytes]) -> list[bytes]:
    """Names of the prefixes of 0, 1, ... turns."""
    out = [ROOT]
    for d in range(1, len(keys) + 1):
        low = d & -d
        out.append(hashlib.md5(out[d - low] + b"".join(keys[d - low : d])).digest())
    return out


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("n1", "int64"), ("n2", "int64"), ("p1", "int64"), ("p2", "int64"),
             ("depth", "int64"), ("conv_id", "int64"), ("size", "int64"), ("last", "bool")]
    schema = pa.schema([(n, pa.bool_() if k == "bool" else pa.int64()) for n, k in kinds])
    rows: list[tuple] = []

    def sent():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
        )

    for batch in batches:
        for conv, keys, sizes in zip(*(batch[c].to_pylist() for c in ("conv_id", "keys", "sizes")), strict=True):
            named = [_pair(n) for n in names(keys)]
            for d, own in enumerate(named):
                above = named[d - 1] if d else (None, None)
                rows.append((*own, *above, d, conv, sizes[d - 1] if d else 0, d == len(keys)))
                if len(rows) >= ROWS:
                    yield sent()
                    rows.clear()
    if rows:
        yield sent()


def _ways_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name = pa.struct([("n1", pa.int64()), ("n2", pa.int64())])
    for batch in batches:
        for keys, first in zip(batch["keys"].to_pylist(), batch["first"].to_pylist(), strict=True):
            named = [_pair(n) for n in names(keys)]
            for lo in range(max(first, 1), len(named), ROWS):
                own = range(lo, min(lo + ROWS, len(named)))
                up = [[dict(zip(NAME, n, strict=True)) for n in named[d - (d & -d) : d]] for d in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([named[d][i] for d in own], pa.int64()) for i in (0, 1)] + [pa.array(up, pa.list_(name))],
                    names=[*NAME, "up"],
                )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node over its ids, which come in order; only the digest is held."""
    own, state = None, None
    for batch in batches:
        done = []
        for a, b, conv in zip(*(batch[c].to_pylist() for c in ("n1", "n2", "conv_id")), strict=True):
            if (a, b) != own:
                if own is not None:
                    done.append((*own, state.hexdigest()))
                own, state = (a, b), hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
        yield _digest_rows(done)
    if own is not None:
        yield _digest_rows([(*own, state.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["n1", "n2", "ends_sha256"]
    )


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id and its steps (key, size) in order of turn, null first, ties by key.

    Null role and text count as empty; rows without conv_id belong to no conversation.
    A conversation is one row of 24 bytes a turn, without its texts.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat_ws(":", F.length(role), F.concat(role, text)).cast("binary")))
    step = F.struct("turn", key.alias("key"), F.length(text).cast("long").alias("size"))
    found = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), step.alias("s"))
    return found.groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("steps")).select(
        "conv_id", F.transform("steps", lambda s: F.struct(s["key"].alias("key"), s["size"].alias("size"))).alias("steps")
    )


def trie(seqs: DataFrame) -> DataFrame:
    """The nodes of the trie over sequences (conv_id, steps), one row a distinct prefix.

    conv_id is the smallest member; subtrees include their top. Sequences without
    steps end at the root; an empty table has no node. Only the depth reaches the driver.
    """
    c = F.col
    kept = stored(seqs.select("conv_id", c("steps.key").alias("keys"), c("steps.size").alias("sizes")), "sequences")
    walks = map_batches(
        kept, _walks, "n1 long, n2 long, p1 long, p2 long, depth long, conv_id long, size long, last boolean"
    )
    nodes = stored(
        walks.groupBy(*NAME).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("depth").alias("depth"),
            F.max("size").alias("size"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        ),
        "nodes",
    )
    children = nodes.filter("depth > 0").groupBy(c("p1").alias("n1"), c("p2").alias("n2")).agg(
        F.count("*").alias("n_children")
    )
    base = stored(nodes.join(children, NAME, "left").fillna(0, ["n_children"]), "nodes")
    first = base.groupBy("conv_id").agg(F.min("depth").alias("first"))
    ways = stored(map_batches(kept.join(first, "conv_id").select("keys", "first"), _ways_up,
                              "n1 long, n2 long, up array<struct<n1: long, n2: long>>"), "ways")
    totals = base.select(
        *NAME, "depth", (c("n_children") == 0).cast("long").alias("n_leaves"),
        ((c("n_convs") - 1) * c("size")).alias("saved_tokens"),
    )
    summed = [F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")]
    deepest = base.agg(F.max("depth")).first()[0] or 0
    half = 1
    while half <= deepest:
        roots = totals.filter(c("depth").bitwiseAND(-c("depth")) == half).groupBy(*NAME, "depth").agg(*summed)
        grafts = roots.join(ways, NAME).select(
            F.posexplode("up").alias("i", "to"), (c("depth") - half).alias("top"), "n_leaves", "saved_tokens"
        )
        grafts = grafts.groupBy(c("to.n1").alias("n1"), c("to.n2").alias("n2"), (c("top") + c("i")).alias("depth"))
        totals = totals.union(stored(grafts.agg(*summed), "grafts"))
        half *= 2
    ends = walks.filter("last").select(*NAME, "conv_id").repartition(*NAME).sortWithinPartitions(*NAME, "conv_id")
    ends = map_batches(ends, _digests, "n1 long, n2 long, ends_sha256 string")
    above = base.select(c("n1").alias("p1"), c("n2").alias("p2"), c("conv_id").alias("parent_conv_id"))
    return (
        base.join(totals.groupBy(*NAME).agg(*summed), NAME)
        .join(ends, NAME, "left")
        .join(above, ["p1", "p2"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
    )

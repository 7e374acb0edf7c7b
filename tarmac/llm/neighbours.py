"""Near-duplicate vectors by NN-descent over balls.

Equal vectors are one node. Nodes within half the link angle of a leader form a
ball: all its members link with each other, by the triangle inequality, so a
crowd of near copies is counted and never paired. A neighbour graph of the
leaders starts from random-hyperplane buckets and is refined by joins of
neighbours with neighbours of neighbours. A list whose last neighbour is still
within reach is saturated and grows. A sample of leaders is compared with all
of them to audit the recall; if it is short, all lists grow and the descent
goes on. Pairs of balls within reach are then settled in double precision: all
of their members link, or members are compared in blocks.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import components, map_batches, stored

NEAR = 0.9
LIST, TREES, LEAF, TREE_LIST, LOCAL = 8, 8, 1024, 4, 48
ROUNDS, SETTLED, GROWTHS = 6, 0.01, 3
#: Leaders that the audit compares with all, and the recall it asks for.
AUDIT, RECALL = 256, 0.98
#: Members of one block when two balls are compared member by member.
BLOCK = 256
_SLACK = 1e-12


def unit(vector: np.ndarray) -> bytes | None:
    """The vector at length one in double precision; None if it has no direction."""
    if not len(vector) or not np.isfinite(vector).all():
        return None
    vector = vector / (np.abs(vector).max() or 1.0)
    norm = np.sqrt(vector @ vector)
    return (vector / norm).tobytes() if norm > 0 else None


def _units(rows: DataFrame) -> DataFrame:
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = []
            for values in batch["embedding"].to_pylist():
                good = values is not None and None not in values
                units.append(unit(np.array(values, dtype=np.float64)) if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(units, pa.binary())], names=["vec_id", "unit"]
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return map_batches(rows.select("vec_id", "embedding"), made, f"vec_id {kind}, unit binary")


def _matrix(units, kind=np.float64) -> np.ndarray:
    return np.array([np.frombuffer(u, dtype=np.float64) for u in units]).astype(kind)


def _bucketed(nodes: DataFrame, trees: int, leaf: int, seed: int, largest: int) -> DataFrame:
    """Nodes with their bucket in each tree: the signs of their products with random
    planes, as many as make buckets of about ``leaf``. Larger buckets are parted by
    hash into groups of at most about ``largest``."""
    bits = max(0, math.ceil(math.log2(max(1, nodes.count()) / leaf)))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            keys = np.zeros((len(batch), trees), dtype=np.int64)
            units = batch["unit"].to_pylist()
            sizes = np.array([len(u) // 8 for u in units])
            for size in np.unique(sizes).tolist():
                if size not in planes:
                    draw = np.random.default_rng([seed, size])
                    planes[size] = draw.normal(size=(size, trees * bits))
                own = np.flatnonzero(sizes == size)
                signs = (_matrix([units[i] for i in own]) @ planes[size] > 0).reshape(
                    len(own), trees, bits
                )
                keys[own] = signs @ powers + (size << 40)
            keys += np.arange(trees) << 32
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(keys), pa.list_(pa.int64()))],
                names=[*batch.schema.names, "buckets"],
            )

    schema = nodes.schema.simpleString()[7:-1] + ",buckets:array<bigint>"
    dealt = map_batches(nodes, signed, schema).withColumn("bucket", F.explode("buckets"))
    dealt = dealt.drop("buckets")
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / largest)
    return (
        dealt.join(sizes, "bucket")
        .withColumn("part", F.pmod(F.xxhash64("node", "bucket"), parts))
        .drop("size")
    )


# Balls


def _lead(ids: np.ndarray, vectors: np.ndarray, near: float) -> np.ndarray:
    """The leader of each row: the first of the rows left takes all within reach."""
    leader = np.full(len(ids), -1, dtype=np.int64)
    for k in range(len(ids)):
        if leader[k] < 0:
            own = (leader < 0) & (vectors @ vectors[k] >= near)
            own[k] = True
            leader[own] = ids[k]
    return leader


def _led(nodes: DataFrame, near: float, seed: int, leaf: int) -> DataFrame:
    """node and leader of every node, by one pass over hyperplane buckets."""

    def lead(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        leader = _lead(group["node"].to_numpy(), _matrix(group["unit"]), near)
        return pd.DataFrame({"node": group["node"], "leader": leader})

    dealt = _bucketed(nodes.select("node", "unit"), 1, leaf, seed, 2 * leaf)
    return dealt.groupBy("bucket", "part").applyInPandas(lead, "node long, leader long")


def _with_dot(rows: DataFrame, left: str, right: str, name: str = "dot") -> DataFrame:
    """The rows with the double-precision product of two vector columns, without these."""
    kept = [c for c in rows.columns if c not in (left, right)]

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch[left].to_pylist(), batch[right].to_pylist(), strict=True)
            dots = [
                float(np.frombuffer(a, dtype=np.float64) @ np.frombuffer(b, dtype=np.float64))
                for a, b in pairs
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(dots, pa.float64())], names=[*kept, name]
            )

    schema = rows.select(*kept).schema.simpleString()[7:-1] + f",{name}:double"
    return map_batches(rows, multiplied, schema)


def balls(nodes: DataFrame, near: float, leaf: int = LEAF) -> DataFrame:
    """node, leader and dot (their product) of every node.

    Leaders that took others meet once more, for a crowd may have been dealt to
    several buckets; their members move to the new leader if it is in reach.
    """
    c = F.col
    reach = math.sqrt((1 + near) / 2) + _SLACK  # half the link angle
    first = stored(_led(nodes, reach, 1, leaf), "led")
    heavy = first.filter(c("node") != c("leader")).select(c("leader").alias("node")).distinct()
    again = _led(stored(nodes.join(heavy, "node", "left_semi"), "heavy"), reach, 2, leaf)
    moved = first.join(
        again.select(c("node").alias("leader"), c("leader").alias("next")), "leader", "left"
    )
    vectors = nodes.select(c("node").alias("id"), c("unit").alias("id_unit"))
    near_next = _with_dot(
        moved.withColumn("next", F.coalesce("next", "leader"))
        .join(nodes.select("node", "unit"), "node")
        .join(vectors, c("next") == c("id"))
        .drop("id"),
        "unit",
        "id_unit",
    )
    # A leader that moves takes along only members in reach; the others keep it as a
    # name, so one that is gone from its own ball must still have a ball: the first
    # of those left leads it.
    placed = near_next.select(
        "node",
        F.when(c("dot") >= reach, c("next")).alias("ball"),
        c("leader").alias("old"),
    )
    placed = stored(placed, "placed")
    left = placed.filter("ball is null").select("node", "old")
    led = _led(
        stored(nodes.join(left, "node", "left_semi"), "left"), reach, 3, leaf
    )
    return stored(
        _with_dot(
            placed.filter("ball is not null")
            .select("node", c("ball").alias("leader"))
            .union(led)
            .join(nodes.select("node", "unit"), "node")
            .join(vectors, c("leader") == c("id"))
            .drop("id"),
            "unit",
            "id_unit",
        ),
        "balls",
    )


# Descent


def _best(candidates: DataFrame, lists: DataFrame) -> DataFrame:
    """The nearest neighbours of each node, as many as its list is long."""
    distinct = candidates.groupBy("a", "b").agg(
        F.max("sim").alias("sim"), F.min("fresh").alias("fresh")
    )
    order = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    return (
        distinct.join(lists.select(F.col("node").alias("a"), "most"), "a")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= F.col("most"))
        .select("a", "b", "sim", "fresh", "place", "most")
    )


def _pairs(ids: np.ndarray, vectors: np.ndarray, most: int, worst: np.ndarray | None):
    """The nearest others of each row that beat its worst neighbour: a, b, sim."""
    sims = vectors @ vectors.T
    np.fill_diagonal(sims, -2)
    most = min(most, len(ids) - 1)
    if most < 1:
        return ids[:0], ids[:0], np.zeros(0)
    top = np.argpartition(-sims, most - 1, axis=1)[:, :most]
    found = np.take_along_axis(sims, top, axis=1)
    good = found > (-2 if worst is None else worst[:, None])
    rows, columns = np.nonzero(good)
    return ids[rows], ids[top[rows, columns]], found[rows, columns]


def _planted(leaders: DataFrame, trees: int, leaf: int) -> DataFrame:
    """First neighbours (a, b, sim, fresh): the nearest in each bucket of each tree."""

    def nearest(group: pd.DataFrame) -> pd.DataFrame:
        a, b, sim = _pairs(
            group["node"].to_numpy(), _matrix(group["unit"], np.float32), TREE_LIST, None
        )
        return pd.DataFrame({"a": a, "b": b, "sim": sim.astype(np.float64), "fresh": True})

    dealt = _bucketed(leaders.select("node", "unit"), trees, leaf, 11, 2 * leaf)
    return dealt.groupBy("bucket", "part").applyInPandas(
        nearest, "a long, b long, sim double, fresh boolean"
    )


def _local(graph: DataFrame, leaders: DataFrame) -> DataFrame:
    """Neighbours meet neighbours: candidates (a, b, sim, fresh) from around every node
    with a fresh link. A node with many reverse neighbours meets them in parts."""
    c = F.col
    ways = graph.select(c("a").alias("center"), c("b").alias("node"), "fresh").union(
        graph.select(c("b").alias("center"), c("a").alias("node"), "fresh")
    )
    around = ways.groupBy("center").agg(
        F.max("fresh").alias("moving"), F.count("*").alias("degree")
    )
    parts = F.ceil(c("degree") / LOCAL)
    dealt = (
        ways.select("center", "node")
        .join(around.filter("moving"), "center")
        .select("center", "node", F.pmod(F.xxhash64("node", "center"), parts).alias("part"))
        .distinct()
    )
    worst = graph.groupBy(c("a").alias("node")).agg(
        F.when(F.count("*") >= F.max("most"), F.min("sim")).otherwise(-2.0).alias("worst")
    )
    known = leaders.select("node", "unit").join(worst, "node", "left")
    known = known.select("node", "unit", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
    members = dealt.join(known, "node").groupBy("center", "part").agg(
        F.collect_list(F.struct("node", "worst", "unit")).alias("members")
    )

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for group in batch["members"].to_pylist():
                sizes = {len(m["unit"]) for m in group}
                for size in sizes:
                    own = [m for m in group if len(m["unit"]) == size]
                    out.append(
                        _pairs(
                            np.array([m["node"] for m in own], dtype=np.int64),
                            _matrix([m["unit"] for m in own], np.float32),
                            LIST,
                            np.array([m["worst"] for m in own]),
                        )
                    )
            a, b, sim = (np.concatenate(part) if out else [] for part in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())],
                names=["a", "b", "sim"],
            )

    found = map_batches(members.select("members"), met, "a long, b long, sim double")
    return found.withColumn("fresh", F.lit(True))


def _reach(near: float, wide: Column, other: Column) -> Column:
    """The least product of two leaders whose balls, of these angles, may hold a link."""
    return F.cos(F.least(F.lit(math.acos(near)) + wide + other, F.lit(math.pi))) - 1e-5


def _audit(graph: DataFrame, leaders: DataFrame, near: float, queries: int) -> float:
    """The share of true neighbours within reach that the graph has, for a sample of
    leaders, by comparing each with all leaders in blocks."""
    c = F.col
    chosen = leaders.orderBy(F.xxhash64("node"), "node").limit(queries)
    sample = chosen.select("node", "unit", "wide").toPandas()  # ``queries`` rows at most
    if sample.empty:
        return 1.0
    by_size = {size: own for size, own in sample.groupby(sample["unit"].map(len))}
    limit = math.acos(near)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, nodes = batch["unit"].to_pylist(), batch["node"].to_numpy()
            wide, lengths = batch["wide"].to_numpy(), np.array([len(u) for u in units])
            for size, own in by_size.items():
                rows = np.flatnonzero(lengths == size)
                if not len(rows):
                    continue
                sims = _matrix(own["unit"]) @ _matrix([units[i] for i in rows]).T
                ids = own["node"].to_numpy()
                angle = limit + own["wide"].to_numpy()[:, None] + wide[rows][None]
                hit = (sims >= np.cos(np.minimum(angle, np.pi))) & (ids[:, None] != nodes[rows])
                q, r = np.nonzero(hit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[q], pa.int64()), pa.array(nodes[rows][r], pa.int64())],
                    names=["a", "b"],
                )

    true = map_batches(leaders.select("node", "unit", "wide"), compared, "a long, b long")
    ways = graph.select("a", "b").union(graph.select(c("b"), c("a"))).distinct()
    found = true.join(ways.withColumn("found", F.lit(1)), ["a", "b"], "left").agg(
        F.count("*").alias("n"), F.count("found").alias("found")
    ).first()
    return found["found"] / found["n"] if found["n"] else 1.0


def descend(leaders: DataFrame, near: float, leaf: int = LEAF, audit: int = AUDIT) -> DataFrame:
    """Neighbour lists (a, b, sim) of the leaders (node, unit, wide)."""
    c = F.col
    lists = stored(leaders.select("node", "wide", F.lit(LIST).alias("most")), "lists")
    graph = stored(_best(_planted(leaders, TREES, leaf), lists), "graph")
    count = lists.count()
    for growth in range(GROWTHS + 1):
        for _ in range(ROUNDS):
            new = _local(graph, leaders)
            old = graph.select("a", "b", "sim", F.lit(False).alias("fresh"))
            wide = lists.select(c("node").alias("b"), c("wide").alias("b_wide"))
            graph = stored(_best(old.unionByName(new), lists), "graph")
            # A saturated list: its last neighbour is still within reach.
            full = (
                graph.filter(c("place") == c("most"))
                .join(lists.select(c("node").alias("a"), "wide"), "a")
                .join(wide, "b")
                .filter(c("sim") >= _reach(near, c("wide"), c("b_wide")))
                .select(c("a").alias("node"), F.lit(True).alias("full"))
            )
            lists = stored(
                lists.join(full, "node", "left").select(
                    "node", "wide", F.when(c("full"), c("most") * 2).otherwise(c("most")).alias("most")
                ),
                "lists",
            )
            moved = graph.agg(F.count_if("fresh").alias("n")).first()["n"]
            if moved <= SETTLED * count * LIST and full.isEmpty():
                break
        recall = _audit(graph, leaders, near, audit)
        if recall >= RECALL:
            break
        if growth < GROWTHS:
            lists = stored(lists.withColumn("most", c("most") * 2), "lists")
            more = _planted(leaders, TREES, leaf * 2 ** (growth + 1))
            graph = stored(_best(graph.select("a", "b", "sim", "fresh").unionByName(more), lists), "graph")
    if recall < RECALL:
        warnings.warn(f"audited recall of the neighbour lists is {recall:.3f}", stacklevel=2)
    return graph.select("a", "b", "sim")


# Links


def _blocks(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """The members of balls in blocks: leader, block, members."""
    dealt = members.join(sizes, "leader").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK))
    )
    return dealt.groupBy("leader", "block").agg(
        F.collect_list(F.struct("node", "n", "unit")).alias("rows")
    )


def _compared(pairs: DataFrame, blocks: DataFrame, near: float) -> DataFrame:
    """Links between the members of pairs of balls: rows (a, b, node, links)."""
    c = F.col
    met = pairs.join(
        blocks.select(c("leader").alias("a"), c("rows").alias("left")), "a"
    ).join(blocks.select(c("leader").alias("b"), c("rows").alias("right")), "b")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, left, right in zip(*(batch[k].to_pylist() for k in names), strict=True):
                near_ = _matrix([m["unit"] for m in left]) @ _matrix([m["unit"] for m in right]).T
                near_ = near_ >= near
                for own, links in (
                    (left, near_ @ np.array([m["n"] for m in right])),
                    (right, np.array([m["n"] for m in left]) @ near_),
                ):
                    out += [(a, b, m["node"], int(n)) for m, n in zip(own, links, strict=True) if n]
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(col, pa.int64()) for col in columns], names=["a", "b", "node", "links"]
            )

    names = ["a", "b", "left", "right"]
    return map_batches(met.select(*names), counted, "a long, b long, node long, links long")


def near_duplicates(
    vectors: DataFrame, near: float = NEAR, leaf: int = LEAF, audit: int = AUDIT
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing; so do vectors of different lengths with each other. Repeated rows
    link with each other like any equal vectors. A null vec_id stays null, and its
    row is kept if no other vec_id is in its component.
    """
    c = F.col
    rows = stored(_units(vectors), "units")
    nodes = stored(
        rows.filter("unit is not null")
        .groupBy("unit")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    led = balls(nodes, near, leaf)
    members = led.join(nodes, "node")
    sizes = stored(
        members.groupBy("leader").agg(
            F.sum("n").alias("n"),
            F.count("*").alias("members"),
            F.min("least").alias("least"),
            F.when(F.count("*") > 1, F.acos(F.least(F.min("dot"), F.lit(1.0))) + _SLACK)
            .otherwise(0.0)
            .alias("wide"),
        ),
        "sizes",
    )
    leaders = stored(
        nodes.select("node", "unit").join(
            sizes.select(c("leader").alias("node"), "wide"), "node"
        ),
        "leaders",
    )
    graph = descend(leaders, near, leaf, audit)
    ends = leaders.join(
        sizes.select(c("leader").alias("node"), "n", "members"), "node"
    )
    one = ends.select(*(c(k).alias(f"a_{k}") for k in ("node", "unit", "wide", "n", "members")))
    two = ends.select(*(c(k).alias(f"b_{k}") for k in ("node", "unit", "wide", "n", "members")))
    hopeful = graph.filter(c("sim") >= math.cos(min(math.pi, 2 * math.acos(near))) - 1e-5)
    hopeful = hopeful.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    met = _with_dot(
        hopeful.join(one, c("a") == c("a_node")).join(two, c("b") == c("b_node")), "a_unit", "b_unit"
    )
    angle = F.acos(F.least(F.greatest("dot", F.lit(-1.0)), F.lit(1.0)))
    wide = c("a_wide") + c("b_wide")
    limit = math.acos(near)
    met = stored(
        met.filter(angle <= limit + wide + _SLACK).select(
            "a",
            "b",
            "a_n",
            "b_n",
            F.when((c("a_members") == 1) & (c("b_members") == 1), F.when(c("dot") >= near, 2).otherwise(0))
            .when(angle + wide <= limit - 1e-9, 2)
            .otherwise(1)
            .alias("state"),
        ),
        "pairs",
    )
    whole = met.filter("state = 2")
    partial = met.filter("state = 1").select("a", "b")
    involved = partial.select(c("a").alias("leader")).union(partial.select(c("b"))).distinct()
    blocks = _blocks(
        members.select("leader", "node", "n", "unit").join(involved, "leader", "left_semi"),
        sizes.select("leader", "members"),
    )
    compared = stored(_compared(partial, blocks, near), "compared")
    edges = whole.select("a", "b").union(compared.select("a", "b").distinct())
    reached = components(edges)
    named = (
        sizes.select("leader", "least")
        .join(reached.select(c("node").alias("leader"), "component"), "leader", "left")
        .withColumn("component", F.coalesce("component", "leader"))
    )
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    between = (
        whole.select(c("a").alias("leader"), c("b_n").alias("links"))
        .union(whole.select(c("b"), c("a_n")))
        .groupBy("leader")
        .agg(F.sum("links").alias("between"))
    )
    single = compared.groupBy("node").agg(F.sum("links").alias("single"))
    counted = (
        led.select("node", "leader")
        .join(sizes.select("leader", "n"), "leader")
        .join(between, "leader", "left")
        .join(single, "node", "left")
        .join(named.select("leader", "component"), "leader")
        .join(first, "component")
        .select(
            "node",
            (c("n") - 1 + F.coalesce("between", F.lit(0)) + F.coalesce("single", F.lit(0))).alias(
                "n_links"
            ),
            "component_id",
        )
    )
    by_unit = nodes.select("node", "unit").join(counted, "node").drop("node")
    found = rows.join(by_unit, "unit", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(c("unit").isNull(), c("vec_id")).otherwise(c("component_id")).alias("component_id"),
    )
    return found.withColumn("kept", c("vec_id").eqNullSafe(c("component_id")))

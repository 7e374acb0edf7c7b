"""The prefix trie against a slow one built node by node."""

import hashlib
import zlib
from collections import defaultdict

from tarmac.llm import prefixes
from tarmac.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def slow_trie(convs):
    members = defaultdict(list)
    for conv, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(conv)
    out = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = lambda n: sum(len(m) == len(n) + 1 and m[:-1] == n for m in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(map(str, sorted(x for x in own if len(convs[x]) == len(node))))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), kids(node),
                    sum(kids(n) == 0 for n in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ordered(rows):
    convs = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if r[0] is not None:
            convs[r[0]].append((r[2] or "", r[3] or ""))
    return convs


def test_query_equals_a_slow_one(spark):
    own = ordered(map(tuple, spark.read.parquet(f"{FOLDER}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()))
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    assert told(QUERIES["op13_prefix_trie"](spark, FOLDER)) == slow_trie(rebuilt)


def test_awkward_rows(spark):
    rows = [(1, None, None, "a"), (1, 2, "u", None), (2, 1, "", "a"), (2, 2, "u", ""), (10, 1, "", "a"), (None, 1, "u", "b")]
    rows += [(3, t, "u", "x" * (t % 3)) for t in range(37)] + [(4, t, "u", "x" * (t % 3)) for t in range(21)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as depth", "'y' as n1", "1 as keys")
    assert told(prefixes.trie(prefixes.sequences(df))) == slow_trie(ordered(rows))
    none = spark.createDataFrame([], SCHEMA)
    assert prefixes.trie(prefixes.sequences(none)).count() == 0

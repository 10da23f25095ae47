import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from beaconflow.llm import trie
from beaconflow.llm.trie import TernaryTree, medians, prefix_trie, rebuilt, turn_sequences

SCHEMA = "conv_id long, turn long, role string, text string"


def spliced(rows):
    """conv_id -> its rebuilt turns, for rows (conv_id, turn, role, text) without equal turns."""
    own = defaultdict(list)
    for c, _, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1])):
        own[c].append((role or "", text or ""))
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: tuple(own.get(c - c % 5, [])[: h[c]] + own[c][h[c] :]) for c in own}


def brute(sequences):
    """The rows of a trie, counted, from conv_id -> turns."""
    members, kids, leaves, saved, out = defaultdict(list), Counter(), Counter(), Counter(), Counter()
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        kids[p[:-1]] += bool(p)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not kids[p]
        saved[p] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(sequences[c]) == len(p))))
        above = min(members[p[:-1]]) if p else None
        out[min(m), len(p), above, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def nodes(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("rows, fan, shards", [(4096, 64, 4), (7, 2, 9)])
def test_matches_brute_force_on_the_whole_table(spark, monkeypatch, rows, fan, shards):
    """Small trees, many shards and rounds of two make most nodes boundary nodes."""
    monkeypatch.setattr(trie, "TREE_ROWS", rows)
    monkeypatch.setattr(trie, "FAN", fan)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
        got = nodes(prefix_trie(rebuilt(turn_sequences(table))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(spliced(map(tuple, table.select("conv_id", "turn", "role", "text").collect())))


def test_a_frequent_conversation_and_prefixes_of_others(spark, monkeypatch):
    """Copies that reach over many trees, a conversation that is a prefix of others, and several heads."""
    monkeypatch.setattr(trie, "TREE_ROWS", 16)
    common = [("system", "s"), ("user", "hello"), ("assistant", "é")]
    rows = []
    for c in range(400):
        own = common if c % 3 else common[: c % 4] + [("user", f"{c % 7}")] * (c % 2)
        rows += [(c, t, r, x) for t, (r, x) in enumerate(own or common[:1])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes(prefix_trie(turn_sequences(df))) == brute(
        {c: tuple((r.role, r.text) for r in g) for c, g in _grouped(df.collect()).items()}
    )
    assert nodes(prefix_trie(rebuilt(turn_sequences(df)))) == brute(spliced(rows))


def _grouped(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        out[r.conv_id].append(r)
    return out


def test_edge_cases(spark):
    long = "ü" * 200_000
    rows = [(5, None, None, None), (5, 0, "user", long), (6, 3, "user", ""), (6, 1, "user", long), (-7, 0, "", "x"), (11, 0, "user", "a")]
    rows += [(1000, t, "user", "again") for t in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = {5: (("", ""), ("user", long)), 6: (("user", long), ("user", "")), -7: (("", "x"),), 11: (("user", "a"),)}
    plain[1000] = (("user", "again"),) * 3000
    assert nodes(prefix_trie(turn_sequences(df))) == brute(plain)
    # a base that is absent gives nothing: conversation 11 may lose its turn, and ends in the root then
    h = zlib.crc32(b"11") % 9
    assert h > 0 and rebuilt(turn_sequences(df)).where("conv_id = 11").first().turns == []
    assert nodes(prefix_trie(rebuilt(turn_sequences(df.where("conv_id = 11"))))) == brute({11: ()})
    assert prefix_trie(rebuilt(turn_sequences(df.limit(0)))).collect() == []
    assert prefix_trie(rebuilt(turn_sequences(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)))).collect() == []
    clash = df.withColumn("code", F.lit(1)).withColumn("size", F.lit("x")).withColumn("depth", F.lit(2)).withColumn("turns", F.lit(0))
    assert nodes(prefix_trie(turn_sequences(clash))) == brute(plain)
    # equal rows are turns of their own; turns of one number have one order whatever the input's
    twice = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")], SCHEMA)
    one, other = (nodes(prefix_trie(turn_sequences(x))) for x in (twice, twice.orderBy("text")))
    assert one == other and max(r[1] for r in one) == 3


def test_ternary_tree_is_balanced_by_medians():
    assert sorted(medians(1000)) == list(range(1000))
    tree = TernaryTree()
    paths = {k: tree.insert([k, 5]) for k in medians(1000)}
    assert len(tree.split) == 2001 and tree.insert([77, 5]) == paths[77]
    above = {**{x: i for i, x in enumerate(tree.low) if x}, **{x: i for i, x in enumerate(tree.high) if x}}
    deep = 0
    for k in range(1000):
        node, steps = paths[k][1], 0
        while node in above:
            node, steps = above[node], steps + 1
        deep = max(deep, steps)
    assert deep <= 10
    parents = dict(tree.walk())
    assert all(parents[p[2]] == p[1] and parents[p[1]] == 0 for p in paths.values())

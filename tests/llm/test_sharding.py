import hashlib
import random
import zlib

import pytest

from beaconflow.llm import sharding
from beaconflow.llm.sharding import balanced_shards

SCHEMA = "doc_id long, text string"


def best_capacity(sizes, shards):
    """Smallest largest part of a contiguous partition, by dynamic programming."""
    total = [0]
    for s in sizes:
        total.append(total[-1] + s)
    best = total[:]
    for _ in range(shards - 1):
        best = [min((max(best[j], total[i] - total[j]) for j in range(i + 1)), default=0) for i in range(len(total))]
    return best[-1]


def expected(rows, shards):
    groups = {}
    for doc, text in rows:
        data = (text or "").encode()
        key = hashlib.md5(data).hexdigest()
        groups.setdefault(key, []).append((doc, len(data) + 1, zlib.crc32(data)))
    order = sorted(groups)
    sizes = [sum(d[1] for d in groups[k]) for k in order]
    capacity = best_capacity(sizes, shards)
    out, shard, used, slot = [], 0, 0, 0
    for key, size in zip(order, sizes, strict=True):
        if used + size > capacity:
            shard, used, slot = shard + 1, 0, 0
        used += size
        for doc, bytes_, crc in sorted(groups[key], key=lambda d: (d[0] is not None, d[0])):
            out.append((doc, bytes_, crc, shard, slot))
            slot += 1
    return sorted(out, key=str), capacity


def found(df):
    assert df.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("digits", [1, 3])
def test_is_the_best_partition_of_the_whole_table(spark, monkeypatch, digits):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", digits)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, capacity = expected(rows, 8)
    got = found(balanced_shards(docs))
    assert got == want
    sizes = {}
    for _, size, _, shard, _ in got:
        sizes[shard] = sizes.get(shard, 0) + size
    assert max(sizes.values()) == capacity


def test_a_group_of_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 1)
    rng = random.Random(1)
    rows = [(i, "the same" if i % 3 == 0 else "t" * rng.randrange(40) + str(i)) for i in range(300)]
    assert found(balanced_shards(spark.createDataFrame(rows, SCHEMA).repartition(5), 5)) == expected(rows, 5)[0]


def test_cuts_agree_with_dynamic_programming():
    rng = random.Random(7)
    for _ in range(300):
        bins = [sharding.Bin(f"{i:03x}", rng.choice([1, 1, 2, 5, rng.randrange(1, 60)]), 1) for i in range(rng.randrange(1, 40))]
        shards = rng.randrange(1, 9)
        cuts = sharding.Cuts(bins, shards)
        assert cuts.smallest(cuts.least) == cuts.smallest(cuts.most) == best_capacity([b.size for b in bins], shards)
        assert cuts.open_bins() == []


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "é"), (3, "x"), (3, "x"), (4, "y" * 100_000)]
    assert found(balanced_shards(spark.createDataFrame(rows, SCHEMA), 3)) == expected(rows, 3)[0]
    clash = spark.createDataFrame([(1, "a", 9, "k")], SCHEMA + ", size int, key string")
    assert found(balanced_shards(clash)) == [(1, 2, zlib.crc32(b"a"), 0, 0)]
    assert balanced_shards(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        balanced_shards(clash, 0)

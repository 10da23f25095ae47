import math

import numpy as np
import pytest

from beaconflow.llm import neighbours
from beaconflow.llm.neighbours import Graph, build_index, every_nearest, fit, nearest, usable_vectors

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, x, queries, k=10):
    out = {}
    for q in queries:
        i = ids.index(q)
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[q] = [(ids[j], d[j]) for j in order]
    return out


def recall(got, want):
    hit = sum(len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) for q, w in want.items())
    return hit / sum(len(w) for w in want.values())


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_the_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], float)
    got = results(every_nearest(table))
    want = brute(ids, x, [i for i in ids if i % 100 == 0])
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert recall(got, want) >= 0.95
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (f[1], f[0]))
        for v, d in found:
            assert d == pytest.approx(math.dist(x[ids.index(v)], x[ids.index(q)]), rel=1e-12)


def test_clustered_vectors_search_few_lists():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(64, 16)) * 5
    x = (centres[rng.integers(0, 64, 16384)] + rng.normal(size=(16384, 16))).astype(np.float32).astype(float)
    graph = fit(x, len(x))
    searched = [len(own) for own, _ in graph.search(x[:200], graph.ratio)]
    assert len(graph.centroids) == 64 and np.mean(searched) < 16


def test_the_walk_finds_what_a_full_scan_finds():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 12))
    graph = fit(x, 3000 * 40)
    hit = total = 0
    for (own, d), q in zip(graph.search(x[:100], 1.3), x[:100], strict=True):
        full = np.sqrt(((graph.centroids - q) ** 2).sum(axis=1))
        want = set(np.flatnonzero(full <= 1.3 * full.min()).tolist())
        hit, total = hit + len(want & set(own.tolist())), total + len(want)
        assert (np.diff(d) >= 0).all()
    assert hit >= 0.98 * total and isinstance(graph, Graph)


def test_many_equal_vectors_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    monkeypatch.setattr(neighbours, "LIST_SIZE", 40)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 8)).astype(np.float32).astype(float)
    x[::3] = x[0]
    ids = [int(i) for i in rng.permutation(900)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], SCHEMA)
    queries = [i for i in ids if i % 30 == 0]
    got, want = results(every_nearest(df, every=30)), brute(ids, x, queries)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    hot = [q for q in queries if (x[ids.index(q)] == x[0]).all()]
    assert hot and all(got[q] == [(v, 0.0) for v, _ in want[q]] for q in hot)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(0, None), (100, []), (200, [0.0, 0.0]), (300, [1.0, None]), (400, [nan, 1.0]), (500, [inf, 1.0]), (None, [1.0, 1.0]), (600, [1.0, 1.0, 1.0])]
    good = [(700, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (800, [3.0, 4.0]), (800, [3.0, 4.0])]
    df = spark.createDataFrame([(i, v, 5, "l") for i, v in odd + good], SCHEMA + ", v int, list string")
    assert results(every_nearest(df)) == {700: [(1, 0.5), (2, 0.5), (800, math.dist((1, 0), (3, 4)))], 800: [(1, math.dist((1, 0.5), (3, 4))), (2, math.dist((1, 0.5), (3, 4))), (700, math.dist((1, 0), (3, 4)))]}
    assert every_nearest(df.limit(0)).collect() == [] and every_nearest(df.where("vec_id < 600")).where("query_id > 2").collect() == []
    one = usable_vectors(df.where("vec_id = 700"))
    assert nearest(build_index(one), one).collect() == []

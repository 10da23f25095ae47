import numpy as np
from pyspark.sql import functions as F

from beaconflow.llm import pigeonhole
from beaconflow.llm.pigeonhole import blocks, budgets, near_vectors, rotated

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, threshold=0.93):
    """vec_id -> (links, component) for distinct ids of usable vectors."""
    least, links = {r[0]: r[0] for r in rows}, {r[0]: 0 for r in rows}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    unit = {i: np.array(v, float) / np.linalg.norm(v) for i, v, _ in rows}
    for i, v, label in rows:
        for j, w, other in rows:
            if i < j and label == other and len(v) == len(w) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                least[max(a, b)] = min(a, b)
    return {i: (links[i], root(i)) for i in least}


def judged(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def graded(rng, n, dim):
    """Vectors around a few centres, at angles on both sides of the threshold, and copies."""
    rows = []
    for i in range(n):
        centre = np.random.default_rng(i % 5).normal(size=dim)
        v = centre / np.linalg.norm(centre) + rng.normal(size=dim) * rng.choice([0.0, 0.02, 0.05, 0.2]) / np.sqrt(dim / 16)
        rows.append((i * 3 + 1, (v * rng.uniform(0.1, 9)).tolist(), int(rng.integers(0, 3))))
    return rows


def test_matches_brute_force_on_the_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert judged(near_vectors(table)) == brute([(r.vec_id, r.embedding, r.label) for r in table.collect()])


def test_pairs_around_the_threshold_in_parts_of_cells(spark, monkeypatch):
    rng = np.random.default_rng(4)
    for dim, part in ((16, 4096), (64, 11), (3, 50)):
        monkeypatch.setattr(pigeonhole, "PART", part)
        rows = graded(rng, 240, dim)
        want = brute(rows)
        assert judged(near_vectors(spark.createDataFrame(rows, SCHEMA))) == want
        assert sum(n for n, _ in want.values()) > 100


def test_edge_cases(spark):
    inf = float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.1], 1), (3, [0.0, 0.0], 1), (4, None, 1), (5, [1.0, None], 1), (6, [1.0, inf], 1), (7, [], 1)]
    rows += [(8, [1.0, float("nan")], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.0], 2), (11, [1.0], 1), (12, [1e-200, 0.0], 1), (13, [1e200, 1e199], 1)]
    got = judged(near_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert {i: x for i, x in got.items() if x != (0, i)} == {i: (3, 1) for i in (1, 2, 12, 13)}
    # repeated rows count each; copies are a class of their own; a null id links with nothing
    rows = [(4, [1.0, 0.0], 1)] * 3 + [(2, [1.0, 0.05], 1), (None, [1.0, 0.0], 1)]
    out = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in out) == [(0, 0, None, True), (2, 3, 2, True)] + [(4, 3, 2, False)] * 3
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("usable", F.lit(0))
    assert near_vectors(clash).columns == ["vec_id", "n_links", "component_id", "kept"]


def test_many_copies_are_one_class_and_near_copies_send_one_row_each(spark):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=32)
    rows = [(i, centre.tolist(), 0) for i in range(2000)] + [(5000 + i, (centre + rng.normal(size=32) * 0.01).tolist(), 0) for i in range(300)]
    got = judged(near_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert set(got.values()) == {(2299, 0)}


def test_budgets_leave_no_near_pair_without_a_block():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(20_000, 20))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * side  # pairs at exactly the threshold
    gap = (rotated(a) - rotated(b)) ** 2
    kept = [gap[:, d].sum(axis=1) <= limit for d, limit in zip(blocks(20), budgets(20, 0.93), strict=True)]
    assert np.any(kept, axis=0).all()
    assert (rotated(a[:7]) == rotated(a)[:7]).all()

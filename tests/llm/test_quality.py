import numpy as np
from pyspark.sql import functions as F

from beaconflow.llm.quality import STATISTICS, Discriminant, held_out, measure, quality, statistics, train

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality(docs, labels)
    rows = out.where("held_out").join(labels, "doc_id").select("quality", "score", "predicted").collect()
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    area = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert area > 0.85 and np.mean((s >= 0.3) == y) > 0.9
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_discriminant_is_that_of_the_gaussians():
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, (4000, 3)), rng.normal(1, [0.5, 1, 2], (8000, 3))
    moments = lambda x: (len(x), x.sum(axis=0), x.T @ x)
    model = Discriminant(*map(np.array, zip(moments(a), moments(b), strict=True)))
    x = np.vstack([a[:500], b[:500]])
    density = lambda x, m, s: (-0.5 * ((x - m) / s) ** 2 - np.log(s)).sum(axis=1)
    true = 1 / (1 + np.exp(-(density(x, 1, np.array([0.5, 1, 2])) - density(x, 0, np.ones(3)) + np.log(2))))
    assert np.abs(model.scores(x) - true).mean() < 0.06


def test_training_is_the_same_as_on_one_machine(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = train(measure(docs).repartition(7), labels)
    rows = docs.join(labels, "doc_id").select("text", "quality").collect()
    x, y = np.array([statistics(r.text.encode()) for r in rows]), np.array([r.quality for r in rows])
    assert np.allclose(model.mean, [x[y == k].mean(axis=0) for k in (0, 1)])
    assert x.shape[1] == len(STATISTICS)


def test_edge_cases(spark):
    schema = "doc_id long, text string, score int, x string"
    rows = [(1, None, 1, "a"), (2, "", 2, "b"), (None, " ", 3, "c"), (3, "word", 4, "d"), (3, "word", 4, "d"), (4, "w " * 300_000, 5, "e")]
    docs = spark.createDataFrame(rows, schema)
    some = spark.createDataFrame([(3, 1), (4, 0), (1, 1), (2, None), (None, 1), (1, 9), (77, 1)], "doc_id long, quality int")
    for labels in (some, some.limit(0), some.where("quality = 1")):
        out = quality(docs, labels).collect()
        assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert quality(docs.limit(0), some).collect() == []


def test_labels_held_out_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: round(r.score, 9) for r in quality(docs, x).collect()} for x in (labels, other))
    assert a == b

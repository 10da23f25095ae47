
import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconflow.llm import toxicity as tox
from beaconflow.llm.gru import UNITS, Network
from beaconflow.llm.toxicity import drop_toxic, score, toxicity, train, windows

SF = "/root/testdata/sf0.1"


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    net = Network(5)
    for k in net.p:
        net.p[k] = net.p[k].astype(float) + rng.normal(0, 0.1, net.p[k].shape)
    features = rng.normal(size=(9, 5))
    codes, mask = rng.integers(0, 9, (4, 6)), np.ones((4, 6))
    mask[1, 4:] = 0
    mask[2, :] = 0
    labels = np.array([0, 1, 1, 0.0])
    _, g = net.gradients(features, codes, mask, labels)
    loss = lambda: net.gradients(features, codes, mask, labels)[0]
    for k, p in net.p.items():
        for i in range(0, p.size, max(1, p.size // 7)):
            keep = p.flat[i]
            p.flat[i] = keep + 1e-3
            up = loss()
            p.flat[i] = keep - 1e-3
            down = loss()
            p.flat[i] = keep
            assert abs((up - down) / 2e-3 - g[k].flat[i]) < 2e-4, (k, i)
    assert UNITS * 2 == len(net.p["out"])


def test_masked_and_plain_windows_agree():
    rng = np.random.default_rng(1)
    net = Network(4)
    gates = net.project(rng.normal(size=(6, 4)).astype(np.float32))
    codes = rng.integers(0, 6, (3, 8))
    assert np.allclose(net.logits(gates, codes), net.logits(gates, codes, np.ones((3, 8), np.float32)), atol=1e-6)
    padded = np.hstack([codes, np.zeros((3, 4), int)])
    mask = np.hstack([np.ones((3, 8)), np.zeros((3, 4))]).astype(np.float32)
    assert np.allclose(net.logits(gates, codes), net.logits(gates, padded, mask), atol=1e-6)


def test_windows_hold_every_word():
    counts = np.array([0, 1, 31, 32, 33, 48, 49, 500, 0])
    doc, start, size = windows(counts)
    for d, n in enumerate(counts.tolist()):
        seen = set()
        for s, k in zip(start[doc == d], size[doc == d], strict=True):
            seen.update(range(s, s + k))
        assert seen == set(range(n)) and (doc == d).any()
        assert (size[doc == d] == min(n, 32)).all()


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, train(docs, labels.where(~tox.held_out()))


def test_held_out_accuracy(spark, fitted):
    docs, labels, model = fitted
    rows = score(docs.join(labels.where(tox.held_out()), "doc_id"), model).select("toxic", "score").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    assert s.min() >= 0 and s.max() <= 1
    assert y[s >= 0.3].mean() > 0.9 and (s[y == 1] >= 0.3).mean() > 0.85
    assert (s[y == 0] >= 0.3).mean() < 0.01
    assert -np.mean(np.log(np.where(y == 1, s, 1 - s).clip(1e-6))) < 0.2


def test_one_bad_word_deep_in_a_long_text_counts(spark, fitted):
    docs, _, model = fitted
    clean = docs.where("lang = 'en' and source = 'src1' and length(text) between 800 and 3000").limit(20).collect()
    bad = ("idiot", "moron", "scum", "stupid", "trash")
    base = [r.text for r in clean if not any(b in r.text.lower() for b in bad)]
    long = " ".join(base * 30)
    rows = [(i, t.replace(" the ", f" {bad[i % 5]}, the ", 1)) for i, t in enumerate(base)] + [(100, long), (101, long + " Moron! " + long)]
    rows += [(200 + i, t) for i, t in enumerate(base)]
    got = {r.doc_id: r.score for r in score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[101] >= 0.3
    changed = [i for i, (t, b) in enumerate(zip(base, rows, strict=False)) if b[1] != t]
    assert len(changed) > 10 and np.mean([got[i] >= 0.3 for i in changed]) > 0.9
    assert np.mean([got[200 + i] < 0.3 for i in range(len(base))]) > 0.9


def test_edge_cases(spark, fitted):
    docs, labels, model = fitted
    rows = [(1, None, "a", 1.0), (2, "", "b", 2.0), (None, " ", "c", 3.0), (3, "you idiot", "d", 4.0), (3, "you idiot", "d", 4.0), (4, "x" * 500_000, "e", 5.0)]
    some = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = score(some, model)
    assert out.columns == ["doc_id", "text", "lang", "score"] and all(0 <= r.score <= 1 for r in out.collect())
    assert score(spark.createDataFrame([], some.schema), model).collect() == []
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity(some.drop("score"), nothing).collect()} == {0}
    assert drop_toxic(some, nothing).count() == len(rows)
    odd = spark.createDataFrame([(None, 1), (3, None), (3, 7), (2, 0)], "doc_id long, toxic int")
    assert toxicity(some, odd).count() == len(rows)


def test_labels_held_out_do_not_matter(spark, fitted):
    docs, labels, _ = fitted
    few = docs.where("doc_id < 300")
    other = labels.withColumn("toxic", F.when(tox.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: (r.held_out, r.score) for r in toxicity(few, x).collect()} for x in (labels, other))
    assert a == b and {h for h, _ in a.values()} == {True, False}

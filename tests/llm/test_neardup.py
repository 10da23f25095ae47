import random
from math import comb

import numpy as np
from pyspark.sql import functions as F

from beaconflow.llm import neardup
from beaconflow.llm.graph import components
from beaconflow.llm.neardup import drop_near_duplicates, near_duplicates
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def judged(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_matches_brute_force_on_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert judged(near_duplicates(docs)) == brute.near_duplicates(rows)


def test_graded_copies_link_across_stars(spark, monkeypatch):
    """Chains of edits, where the smallest id of a bucket is not similar to all; blocks of a few members."""
    monkeypatch.setattr(neardup, "BLOCK", 7)
    rng, rows = random.Random(3), []
    for group in range(6):
        words = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for step in range(15):
            words = list(words)
            for _ in range(2):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append((group * 100 + rng.randrange(100) + step * 1000, " ".join(words)))
    rows = list(dict(rows).items())
    assert judged(near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute.near_duplicates(rows)


def test_copies_below_the_threshold_send_rows_for_members_not_for_pairs(spark, monkeypatch):
    """Groups of 150, 300 and 600 edited copies, at 0.46 to each other on average, of which few are linked."""
    sent = {}
    keep = neardup.shared_table

    def counted(df, name):
        out = keep(df, name)
        sent.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(neardup, "shared_table", counted)
    rng, crossing = random.Random(6), []
    for n in (150, 300, 600):
        words = [f"w{i}" for i in range(200)]
        rows = [(i, " ".join(f"x{rng.randrange(10**6)}" if rng.random() < 0.045 else w for w in words)) for i in range(n)]
        sent.clear()
        assert judged(near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute.near_duplicates(rows)
        crossing.append(sent["crossing"][0])
        assert sent["links"][1] < n
    assert crossing[2] < 6 * crossing[0]  # pairs grow by 16


def test_edge_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(300_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, long), (8, long + " x"), (9, "É b")]
    rows += [(10, "é b"), (11, "a b c"), (12, "a b c")]
    assert judged(near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute.near_duplicates(rows)
    null = spark.createDataFrame([(None, "one two"), (4, "one two")], SCHEMA)
    assert {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(null).collect()} == {(None, None, True), (4, 4, True)}
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(2, "a b", "x", 1), (1, "a b", "y", 2), (1, "a b", "y", 2)], SCHEMA + ", kept string, set_id int")
    assert sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(clash).collect()) == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert [tuple(r) for r in drop_near_duplicates(clash).collect()] == [(1, "a b", "y", 2)]


def test_a_large_group_of_copies_is_one_component(spark):
    rows = [(i, "the same words again and again here") for i in range(3000)] + [(9999, "something else")]
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA)).groupBy("component_id").count().collect()
    assert {(r.component_id, r["count"]) for r in out} == {(0, 3000), (9999, 1)}


def test_odd_sketches_estimate_high_similarities():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        common = rng.integers(1, 2**62, 800).astype(np.uint64)
        own = rng.integers(1, 2**62, (2, 100)).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, x])) for x in own)
        s = neardup._fold(neardup._min_samples([a, b])).view(np.uint64)
        errors.append(neardup.estimate(np.bitwise_count(s[0] ^ s[1]).sum()) - 0.8)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(500, 900)] + [(3, 3)]
    out = components(spark.createDataFrame(links, "a long, b long"))
    assert out.select("node").distinct().count() == out.count() == 61 + 401
    sizes = out.groupBy("component").agg(F.count("*").alias("n")).collect()
    assert {(r.component, r.n) for r in sizes} == {(100, 61), (7, 401)}


def test_sketches_drop_no_pair_at_the_threshold():
    """20,000 pairs of a similarity of exactly 0.75, judged by the sketches' limit."""
    rng = np.random.default_rng(5)
    common, own = rng.integers(1, 2**62, (20_000, 1, 30)), rng.integers(1, 2**62, (20_000, 2, 5))
    sets = np.concatenate([np.repeat(common, 2, axis=1), own], axis=2).astype(np.uint64).reshape(40_000, 35)
    s = neardup._fold(neardup._min_samples(list(sets))).view(np.uint64)
    bits = np.bitwise_count(s[::2] ^ s[1::2]).sum(axis=1)
    assert bits.max() <= neardup.most_differing_bits(0.75 - neardup.MARGIN)


def test_sketches_lose_less_than_the_bands():
    """The chance that a pair at 0.75 has too many differing bits, from the chain of odd bins under random throws."""
    samples, bits, most = neardup.SAMPLES, neardup.BITS, neardup.most_differing_bits(0.75 - neardup.MARGIN)
    odd, k, lost = np.eye(1, bits + 1)[0], np.arange(bits + 1), 0.0
    for differing in range(samples + 1):
        lost += comb(samples, differing) * 0.25**differing * 0.75 ** (samples - differing) * odd[most + 1 :].sum()
        for _ in range(2):
            more = odd * (bits - k) / bits
            less = odd * k / bits
            odd = np.r_[0, more[:-1]] + np.r_[less[1:], 0]
    assert lost < 0.1 * (1 - 0.75**neardup.ROWS) ** neardup.BANDS

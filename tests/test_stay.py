import random

import pytest
from pyspark.sql import functions as F

from beaconflow.operators.skew import Skew
from beaconflow.operators.stay import StayConfig, dwell, label_stay
from beaconflow.streaming.labels import stay_step
from tests.stay_cases import CASES, MINUTE, millis

TINY = Skew(share=8, min_rows=12)


def config(limits, **options):
    return StayConfig(tuple(x * MINUTE for x in limits), timeout_ms=30 * MINUTE, **options)


@pytest.mark.parametrize("name", CASES)
def test_golden_sequences_in_arrival_order(name):
    limits, records = CASES[name]
    stays = {}
    for time, expected in records:
        labels = stay_step(stays, millis(time), list(expected), config(limits))
        for area, minutes in expected.items():
            if minutes is not None:
                assert labels[area] == minutes * MINUTE, (time, area)


@pytest.mark.parametrize("name", [n for n, (_, rows) in CASES.items() if [t for t, _ in rows] == sorted(t for t, _ in rows) and n != "1"])
def test_golden_sequences_in_time_order(spark, name):
    limits, records = CASES[name]
    rows = [(i, "u", millis(t), a) for i, (t, labels) in enumerate(records) for a in labels]
    df = spark.createDataFrame(rows, "seq long, imsi string, ts_ms long, area string")
    got = {(r.seq, r.area): r.stay for r in dwell(df, config(limits)).collect()}
    for i, (_, labels) in enumerate(records):
        for area, minutes in labels.items():
            if minutes is not None:
                assert got[i, area] == minutes * MINUTE


def test_threshold_options(spark):
    rows = [(i, "u", m * MINUTE, "a") for i, m in enumerate([0, 12, 27])]
    df = spark.createDataFrame(rows, "seq long, imsi string, ts_ms long, area string")

    def labels(**options):
        return [r.stay // MINUTE for r in dwell(df, config((10, 15, 20), **options)).orderBy("seq").collect()]

    assert labels() == [0, 10, 20]
    assert labels(match_max=False) == [0, 10, 15]
    assert labels(output_threshold=False) == [0, 12, 27]


def test_same_time_gives_zero(spark):
    rows = [(0, "u", 0, "a"), (1, "u", 20 * MINUTE, "a"), (2, "u", 20 * MINUTE, "a"), (3, "u", 21 * MINUTE, "a")]
    df = spark.createDataFrame(rows, "seq long, imsi string, ts_ms long, area string")
    got = [r.stay // MINUTE for r in dwell(df, config((20,))).orderBy("seq").collect()]
    assert got == [0, 20, 0, 20]


def skewed_visits(spark, seed=3):
    rng = random.Random(seed)
    rows, seq = [], 0
    for user, n in [("hot", 300), ("warm", 60), *[(f"u{i}", 5) for i in range(20)]]:
        t = 0
        for _ in range(n):
            t += rng.choice([0, 1, 3, 7, 20, 31, 65]) * MINUTE
            for area in rng.sample(["a1", "a2", "a3"], rng.randint(1, 3)):
                rows.append((seq, user, t, area))
            seq += 1
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "seq long, imsi string, ts_ms long, area string")


def test_cutting_hot_users_changes_nothing(spark):
    visits = skewed_visits(spark)
    cfg = config((5, 10, 20))
    whole = dwell(visits, cfg, skew=None)
    cut = dwell(visits, cfg, skew=TINY)
    assert "UNION" in cut._jdf.queryExecution().toString().upper()  # it really was cut
    assert sorted(whole.collect()) == sorted(cut.select(whole.columns).collect())


def test_label_stay_regroups_per_record(spark):
    visits = skewed_visits(spark)
    cfg = config((5, 10, 20))
    records = visits.groupBy("seq", "imsi", "ts_ms").agg(
        F.map_from_entries(F.collect_list(F.struct("area", F.lit("true")))).alias("area_onsite")
    ).withColumn("note", F.concat(F.lit("n"), "seq"))
    bare = spark.createDataFrame([(9999, "u1", 5, {}, "empty")], records.schema)
    records = records.unionByName(bare)
    for skew in (None, TINY):
        out = label_stay(records, cfg, skew=skew)
        assert out.count() == records.count()
        assert out.where("note = 'empty'").first()["area_onsite_stay"] == {}
        flat = out.select("seq", F.explode("area_onsite_stay").alias("area", "stay"))
        want = dwell(visits, cfg, skew=None).select("seq", "area", F.col("stay").cast("string"))
        assert sorted(flat.collect()) == sorted(want.collect())


def test_records_of_equal_seq_all_stay(spark):
    """Equal seq, time and even equal rows, also of a user without id, and of a hot user that is cut."""
    rows = [(0, "u", 0, "x"), (0, "u", 0, "y"), (0, "u", 5 * MINUTE, "x"), (0, "u", 5 * MINUTE, "x"), (1, None, 0, "x"), (1, None, 0, "x")]
    rows += [(i // 4, "h", i * MINUTE, "x") for i in range(60)]
    df = spark.createDataFrame(rows, "seq long, imsi string, ts_ms long, note string")
    df = df.withColumn("area_onsite", F.expr("map('a', 'true', 'b', 'true')"))
    for skew in (None, TINY):
        out = label_stay(df, config([3]), skew=skew)
        got = sorted(((r.seq, r.imsi, r.ts_ms, r.note) for r in out.collect()), key=str)
        assert got == sorted(rows, key=str) and out.columns[:2] == ["imsi", "seq"]
        labels = {(r.seq, r.ts_ms): r.area_onsite_stay for r in out.where("imsi = 'h'").collect()}
        assert labels[0, 3 * MINUTE] == labels[1, 4 * MINUTE] | {"a": str(3 * MINUTE), "b": str(3 * MINUTE)}


def test_areas_and_stays_take_one_shuffle(spark):
    df = spark.range(50).selectExpr("id as seq", "cast(id % 7 as string) as imsi", "id * 1000 as ts_ms", "map('a', 'true') as area_onsite")
    plan = label_stay(df, config([3]), skew=None)
    plan.count()
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1

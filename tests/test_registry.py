import __spark_entry__ as driver
from beaconflow.operators.cooldown import cooldown
from beaconflow.operators.skew import Skew


def test_every_oracle_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert {q for q in set(driver.queries()) - set(driver.oracle_sql()) if q != "pipeline" and not q.startswith("op")} == set()


def test_entry_has_a_stable_schema(spark):
    df = driver.entry(spark)
    assert df.columns == ["key", "value"] and df.count() > 0


def plan_of(df):
    df.count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_is_needed(spark):
    df = driver.queries()["last_device"](spark, "/root/testdata/sf0.001")
    plan = plan_of(df)
    assert "value:double" not in plan and "event_type:string" not in plan


def test_label_pipeline_shuffles_once(spark):
    df = driver.queries()["label_pipeline"](spark, "/root/testdata/sf0.001")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_plain_data_gets_a_plain_plan_and_hot_data_is_cut(spark):
    rows = spark.range(2000).selectExpr("id as seq", "if(id >= 0, 'u', 'v') as imsi", "id * 7 as ts_ms")
    plain = cooldown(rows, 1000)._jdf.queryExecution().executedPlan().toString()
    assert plain.count("Exchange hashpartitioning") == 1 and "Union" not in plain
    cut = cooldown(rows, 1000, skew=Skew(10, 50))
    assert "Union" in cut._jdf.queryExecution().executedPlan().toString()
    # The hot user's rows really end up in several groups.
    from pyspark.sql import functions as F

    from beaconflow.operators.skew import SLICE, find_cuts, with_slices

    offset = F.pmod("ts_ms", F.lit(1000))
    sizes = with_slices(rows, "imsi", offset, find_cuts(rows, "imsi", offset, Skew(10, 50))).groupBy(SLICE).count()
    biggest = sizes.agg(F.max("count")).first()[0]
    assert sizes.count() >= 15 and biggest <= 200

import pytest
from pyspark.sql import functions as F

from beaconflow.operators.stay import StayConfig
from beaconflow.streaming import events as E
from beaconflow.streaming import runner as R
from beaconflow.streaming.labels import UserLabels, label_users
from beaconflow.streaming.once import once_per_key
from tests.stay_cases import MINUTE
from tests.test_streaming import as_stream, records, rows_of

BIG = (1 << 53) + 1


def odd(spark):
    """Names that Python would not have as they are, and whole numbers that no float holds beside nulls of another user."""
    df = records(spark, n=60).withColumn("__own", F.when(F.col("imsi") != "u1", F.col("seq") + BIG))
    return df.withColumn("a b", F.col("imsi")).withColumn("imsi", F.when(F.col("imsi") != "u2", F.col("imsi")))


@pytest.mark.parametrize("kind", ["labels", "events", "once"])
def test_many_users_share_a_call(spark, kind):
    df = odd(spark)
    rows = as_stream(spark, df, ["seq < 30", "seq >= 30"])
    if kind == "labels":
        out = label_users(rows, UserLabels(StayConfig((30 * MINUTE,)), device=True))
    elif kind == "events":
        out = E.cooldown_stream(rows.drop("area_onsite"), 1)
    else:
        out = once_per_key(rows.drop("area_onsite"), df.select("imsi").limit(0), "imsi", "seq")
    assert "pmod(xxhash64(imsi" in out._jdf.queryExecution().toString()
    got = R.run_to_table(out, "odd").select("seq", "imsi", "__own", "a b")
    want = df.select("seq", "imsi", "__own", "a b")
    if kind == "once":
        want = want.groupBy("imsi").agg(F.min_by(F.struct("seq", "__own", "a b"), "seq").alias("r")).select("r.seq", "imsi", "r.__own", "r.a b")
    if kind == "events":
        first = df.groupBy("imsi", "ts_ms").agg(F.min("seq").alias("seq"))
        want = want.join(first.select("seq"), "seq", "left_semi")
    assert rows_of(got) == rows_of(want)

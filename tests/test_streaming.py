import random
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from beaconflow.operators.bucketed import BucketedTable
from beaconflow.operators.cooldown import cooldown
from beaconflow.operators.correlate import correlate_sources
from beaconflow.operators.stay import StayConfig, dwell
from beaconflow.operators.track import track
from beaconflow.session import new_shared_path
from beaconflow.sources import sinks
from beaconflow.streaming import events as E
from beaconflow.streaming import runner as R
from beaconflow.streaming import tables as S
from beaconflow.streaming.labels import UserLabels, label_users
from beaconflow.streaming.once import once_per_key, processed_keys
from beaconflow.streaming.refresh import RefreshingLookup
from tests.stay_cases import CASES, MINUTE, millis


def as_stream(spark, df, parts):
    """``df`` as a stream of one micro-batch per element of ``parts`` (predicates)."""
    path = new_shared_path(spark, "input")
    for part in parts:
        df.where(part).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def records(spark, seed=5, n=400):
    rng = random.Random(seed)
    times = sorted(rng.randrange(3000) for _ in range(n))
    rows = [
        (i, f"u{rng.randrange(12)}", t * MINUTE, rng.choice("abc"), f"d{rng.randrange(4)}", str(20 + rng.randrange(9)),
         str(100 + rng.randrange(9)), f"c{rng.randrange(9)}", {a: "true" for a in rng.sample(["A", "B", "C"], rng.randrange(4))})
        for i, t in enumerate(times)
    ]
    return spark.createDataFrame(
        rows,
        "seq long, imsi string, ts_ms long, source string, imei string, geo_latitude string, geo_longitude string, "
        "lac_ci string, area_onsite map<string,string>",
    )


THIRDS = ["seq < 100", "seq between 100 and 250", "seq > 250"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_labels_over_batches_equal_batch_form(spark):
    df = records(spark)
    cfg = StayConfig((30 * MINUTE, 60 * MINUTE, 200 * MINUTE), timeout_ms=240 * MINUTE)
    stream = label_users(as_stream(spark, df, THIRDS), UserLabels(cfg, device=True, movement=True))
    out = R.run_to_table(stream, "labels")
    assert out.select("batch").distinct().count() == 3
    columns = ["seq", "last_imei", "distance_km", "elapsed_ms", "speed_kmh", "last_lac_ci"]
    assert rows_of(out.select(columns)) == rows_of(track(df).select(columns))
    stays = out.select("seq", F.explode("area_onsite_stay").alias("area", "stay"))
    visits = df.select("seq", "imsi", "ts_ms", F.explode(F.map_keys("area_onsite")).alias("area"))
    want = dwell(visits, cfg).select("seq", "area", F.col("stay").cast("string"))
    assert rows_of(stays) == rows_of(want)
    assert rows_of(out.select("seq", F.to_json("area_onsite"))) == rows_of(df.select("seq", F.to_json("area_onsite")))


def test_late_records_in_arrival_order(spark):
    """Every golden sequence at once, one user each, cut into micro-batches in the middle."""
    rows, want = [], {}
    for name, (limits, steps) in CASES.items():
        if len(limits) > 1:
            continue
        for i, (time, labels) in enumerate(steps):
            rows.append((i, name, millis(time), dict.fromkeys(labels, "true")))
            want.update({(name, i, a): v * MINUTE for a, v in labels.items() if v is not None})
    df = spark.createDataFrame(rows, "seq long, imsi string, ts_ms long, area_onsite map<string,string>")
    cfg = StayConfig((20 * MINUTE,), timeout_ms=30 * MINUTE)
    stream = label_users(as_stream(spark, df, ["seq < 2", "seq = 2", "seq > 2"]), UserLabels(cfg))
    out = R.run_to_table(stream.select("seq", "imsi", "area_onsite_stay"), "late")
    got = {(r.imsi, r.seq, a): int(v) for r in out.collect() for a, v in r.area_onsite_stay.items()}
    assert {k: got[k] for k in want} == want


def test_cooldown_over_batches(spark):
    df = records(spark).select("seq", "imsi", "ts_ms")
    want = rows_of(cooldown(df, 300 * MINUTE))
    stream = E.cooldown_stream(as_stream(spark, df, THIRDS), 300 * MINUTE)
    assert rows_of(R.run_to_table(stream, "cooldown").drop("batch")) == want
    timed = as_stream(spark, df.withColumn("at", F.timestamp_millis("ts_ms")), THIRDS).withWatermark("at", "0 seconds")
    expiring = E.cooldown_stream(timed, 300 * MINUTE, expire=True).select("seq", "imsi", "ts_ms")
    assert rows_of(R.run_to_table(expiring, "cooldown").drop("batch")) == want


@pytest.mark.parametrize("require_all", [False, True])
def test_correlation_over_batches(spark, require_all):
    df = records(spark).select("seq", "imsi", "ts_ms", "source")
    args = (["a", "b", "c"], 400 * MINUTE, 200 * MINUTE, require_all)
    stream = E.correlate_stream(as_stream(spark, df, THIRDS), *args)
    assert rows_of(R.run_to_table(stream, "correlate").drop("batch")) == rows_of(correlate_sources(df, *args))


def test_running_count_keeps_idle_keys(spark):
    df = spark.createDataFrame([(0, "k", "a"), (1, "k", "b"), (2, "x", "z"), (3, "k", "c")], "seq long, k string, v string")
    parts = ["seq < 2", "seq = 2", "seq = 3"]
    kept = R.run_to_table(E.running_count_stream(as_stream(spark, df, parts), "k", "v", "seq"), "count", "update")
    assert rows_of(R.latest_per_key(kept, ["k"])) == [("k", "a", 3), ("x", "z", 1)]


class FakeState:
    """Stands for the state of one key: an idle key times out before its next rows arrive."""

    def __init__(self):
        self.value, self.hasTimedOut, self.timeout = None, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def test_idle_keys_are_forgotten_on_request():
    # A processing-time timeout keeps an available-now query running, so the
    # update itself is driven here.
    update, state = E._running_update(True, "k"), FakeState()

    def batch(*rows):
        return [f.to_dict("records")[0] for f in update(("k",), iter([pd.DataFrame(rows, columns=["__seq", "__value"])]), state)]

    assert batch((1, "b"), (0, "a")) == [{"k": "k", "first_value": "a", "n": 2}]
    assert batch((2, "c")) == [{"k": "k", "first_value": "a", "n": 3}] and state.timeout == 1
    state.hasTimedOut = True
    assert list(update(("k",), iter([]), state)) == [] and not state.exists
    state.hasTimedOut = False
    assert batch((3, "d")) == [{"k": "k", "first_value": "d", "n": 1}]


def test_last_active_over_batches(spark):
    df = records(spark).withColumn("event", F.lit("e"))
    updates = R.run_to_table(E.last_active_stream(as_stream(spark, df, THIRDS)), "active", "update")
    got = R.latest_per_key(updates, ["event", "imsi", "source"])
    assert rows_of(got) == rows_of(df.groupBy("event", "imsi", "source").agg(F.max("ts_ms").alias("last_active_ms")))


def test_restart_continues_where_it_stopped(spark):
    df = records(spark).select("seq", "imsi", "ts_ms")
    path = new_shared_path(spark, "restart")
    handler = R.write_batches_to(f"{path}/out")
    df.where(THIRDS[0]).coalesce(1).write.parquet(f"{path}/in")

    def run():
        stream = spark.readStream.schema(df.schema).parquet(f"{path}/in")
        R.start_batches(E.cooldown_stream(stream, 300 * MINUTE), handler, f"{path}/checkpoint").awaitTermination()

    run()
    df.where(f"not ({THIRDS[0]})").coalesce(1).write.mode("append").parquet(f"{path}/in")
    run()
    assert rows_of(spark.read.parquet(f"{path}/out").drop("batch")) == rows_of(cooldown(df, 300 * MINUTE))


def test_delivery_and_gate(spark):
    df = records(spark, n=30).select("seq", "imsi")
    seen = {"a": [], "b": []}
    consumers = {name: lambda batch, i, name=name: seen[name].append((i, batch.count(), batch.is_cached)) for name in seen}
    handler = R.delivering(lambda b: b.where("seq > 9"), consumers)
    open_, shut = R.gated(handler, "08:00:00", "20:00:00", lambda: datetime(2015, 4, 1, 12)), R.gated(
        handler, "08:00:00", "20:00:00", lambda: datetime(2015, 4, 1, 8)
    )
    for h in (open_, shut):
        stream = as_stream(spark, df, ["seq < 20", "seq >= 20"])
        run = R.start_batches(stream, h, new_shared_path(spark, "gate"))
        run.awaitTermination()
    # A batch that the gate turns away is not even read.
    assert [p["numInputRows"] for p in run.recentProgress] == [0, 0]
    assert seen["a"] == seen["b"] == [(0, 10, True), (1, 10, True)]


def test_archive_names_one_folder_per_batch(spark):
    df = records(spark, n=30).selectExpr("cast(seq as string) as value")
    path = new_shared_path(spark, "archive")
    stream = as_stream(spark, df, ["value < '2'", "value >= '2'"])
    R.with_trigger(sinks.archive_stream(stream, f"{path}/out", f"{path}/c", "p-", ".log"), None).start().awaitTermination()
    got = spark.read.schema("value string, archive string").text(f"{path}/out")
    assert got.count() == 30
    assert all(r.archive.startswith("p-2") and r.archive.endswith(".log") for r in got.select("archive").collect())


def test_matches_are_counted_per_batch(spark):
    df = records(spark, n=30).selectExpr("seq", "concat(imei, if(seq % 3 = 0, 'x', '')) as value")
    kept, count = sinks.matching_lines(as_stream(spark, df, ["seq < 15", "seq >= 15"]).select("value"), "x")
    path = new_shared_path(spark, "matching")
    run = R.start_batches(kept, R.write_batches_to(f"{path}/out"), f"{path}/checkpoint")
    run.awaitTermination()
    assert count is None
    assert [p["observedMetrics"]["matching"]["matched"] for p in run.recentProgress] == [5, 5]


def test_batch_sizes_outlive_the_progress_reports(spark):
    keep = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(keep)
    spark.conf.set(keep, "2")
    try:
        path, seen = new_shared_path(spark, "sizes"), []
        df = records(spark, n=30).select("seq")
        stream = as_stream(spark, df, [f"seq % 6 = {i}" for i in range(6)])
        handler = R.counting(lambda batch, i: seen.append(batch.count()), f"{path}/sizes")
        run = R.start_batches(stream, handler, f"{path}/checkpoint")
        run.awaitTermination()
        assert len(run.recentProgress) < 6
        assert [tuple(r) for r in R.batch_sizes(spark, f"{path}/sizes").orderBy("batch").collect()] == [(i, 5) for i in range(6)]
        assert seen == [5] * 6
    finally:
        spark.conf.set(keep, before)


def test_a_failing_reload_keeps_the_old_copy(spark):
    now, broken, loads = [0.0], [False], []

    def load():
        loads.append(1)
        if broken[0]:
            return spark.range(1).selectExpr("raise_error('the source is down') as v")
        return spark.createDataFrame([(len(loads),)], "v int")

    lookup = RefreshingLookup(load, ttl_seconds=10, clock=lambda: now[0])
    first = lookup.current()
    broken[0], now[0] = True, 20.0
    assert lookup.current().first().v == 1 and len(loads) == 2 and lookup.versions == 1
    broken[0] = False
    assert lookup.current().first().v == 3 and lookup.versions == 2
    # whoever still reads the copy before, can; the one before that is gone
    assert first.first().v == 1
    now[0] = 40.0
    assert lookup.current().first().v == 4
    with pytest.raises(Exception):
        first.collect()
    lookup.close()
    broken[0] = True
    with pytest.raises(Exception):
        RefreshingLookup(load).current()


def test_refreshing_lookup(spark):
    now, loads = [0.0], []

    def load():
        loads.append(1)
        return spark.createDataFrame([(len(loads),)], "v int")

    lookup = RefreshingLookup(load, ttl_seconds=10, clock=lambda: now[0])
    assert lookup.current().first().v == 1 and lookup.current() is lookup.current()
    now[0] = 9.9
    assert lookup.current().first().v == 1
    now[0] = 10.0
    assert lookup.current().first().v == 2 and len(loads) == 2
    lookup.close()


def test_a_retried_batch_counts_nothing_twice(spark):
    path = new_shared_path(spark, "tables")
    rows = spark.createDataFrame([("a", 1, 5), ("b", 2, 7), ("a", 3, 1)], "u string, seq long, m long")
    later = spark.createDataFrame([("a", 4, 2), ("c", 5, 3)], "u string, seq long, m long")
    totals = BucketedTable.create(spark.createDataFrame([("a", 100)], "u string, m long"), f"{path}/totals", ["u"], 4)
    count = S.accumulate("u", "seq", ["m"], totals, f"{path}/sums")
    for batch, i in ((rows, 0), (rows, 0), (later, 1), (later, 1)):
        count(batch, i)
    sums = {r.seq: r.total_m for r in spark.read.parquet(f"{path}/sums").collect()}
    assert sums == {1: 105, 2: 7, 3: 106, 4: 108, 5: 3}
    assert {r.u: r.m for r in totals.read().collect()} == {"a": 108, "b": 7, "c": 3}


def test_keys_are_processed_once_from_a_large_set(spark):
    rows = [(f"k{i % 30}" if i % 31 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, seq long")
    done = spark.createDataFrame([(f"k{i}",) for i in range(0, 30, 3)] * 2 + [("other",)], "k string")
    path = new_shared_path(spark, "once")
    stream = as_stream(spark, df, ["seq < 5", "seq between 5 and 90", "seq > 90"])
    query = R.start_batches(once_per_key(stream, done, "k", "seq"), R.write_batches_to(f"{path}/out"), f"{path}/checkpoint")
    query.awaitTermination()
    want, seen = [], {f"k{i}" for i in range(0, 30, 3)}
    for k, seq in rows:
        if k not in seen:
            seen.add(k)
            want.append((k, seq))
    got = spark.read.parquet(f"{path}/out")
    assert rows_of(got.select("k", "seq")) == sorted(want, key=repr)
    assert {r.k for r in processed_keys(spark, f"{path}/checkpoint", "k").collect()} == seen | {"other"}
    # a batch touches the states of its own keys, not of all that are done
    touched = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]]
    assert touched[1] <= len(want)
    assert R.run_to_table(once_per_key(as_stream(spark, df, ["seq < 0"]), done.limit(0), "k", "seq"), "none").count() == 0

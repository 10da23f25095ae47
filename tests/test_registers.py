import random

import pytest
from pyspark.sql import functions as F

from beaconflow.operators import keyed_table as U
from beaconflow.operators import registers as W
from beaconflow.operators.bucketed import BucketedTable
from beaconflow.session import new_shared_path
from beaconflow.streaming import runner as R
from beaconflow.streaming import tables as S

FEED = "id string, name string, note string, flag string, seq long"
FIELDS = {"name": "name", "note": "note"}


def feed_rows(n=600, keys=25, seed=3):
    rng = random.Random(seed)
    seqs = rng.sample(range(10 * n), n)
    rows = [(f"k{rng.randrange(keys)}", f"n{s}", rng.choice([None, f"o{s}"]), rng.choice(["1", "0", "0", "-1", "?"]), s) for s in seqs]
    return rows + [(None, "x", "y", "1", 5), ("k0", "x", "y", None, 10**9)]


def last_writer(rows):
    """(key, field) -> value, from changes in the order of seq."""
    store = {}
    for key, name, note, flag, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[4]):
        if flag == "-1":
            store = {k: v for k, v in store.items() if k[0] != key}
        elif flag in ("0", "1"):
            store.update({(key, f): v for f, v in (("name", name), ("note", note)) if v is not None})
    return store


def changes(feed):
    return W.change_state(feed, U.key_of(["id"]), FIELDS, "flag")


def seen(state):
    return {(r.hash_key, r.field): r.value for r in W.current(state).collect()}


def test_any_order_and_cut_of_runs_gives_the_same_table(spark):
    rows = feed_rows()
    want = last_writer(rows)
    for seed in range(3):
        shuffled = random.Random(seed).sample(rows, len(rows))
        state = None
        for part in (shuffled[:150], shuffled[150:400], shuffled[100:], shuffled[:3]):
            own = W.merge_registers(changes(spark.createDataFrame(part, FEED)))
            merged = own if state is None else W.merge_registers(state, own)
            state = W.compacted(merged) if seed else merged
        assert seen(state) == want


def test_an_older_write_and_an_older_delete_come_too_late(spark):
    new = spark.createDataFrame([("k", "new", "n", "1", 10)], FEED)
    old = spark.createDataFrame([("k", "old", "o", "1", 5), ("k", None, None, "-1", 7)], FEED)
    for first, second in ((new, old), (old, new)):
        assert seen(W.merge_registers(W.merge_registers(changes(first)), changes(second))) == {("k", "name"): "new", ("k", "note"): "n"}
    newer = spark.createDataFrame([("k", None, None, "-1", 10), ("j", None, None, "-1", 1)], FEED)
    state = W.merge_registers(changes(new), changes(newer))
    assert seen(state) == {("k", "name"): "new", ("k", "note"): "n"}  # at equal seq the write stays
    newer = newer.withColumn("seq", F.lit(11))
    state = W.compacted(W.merge_registers(state, changes(newer)))
    assert seen(state) == {} and state.count() == 2
    assert W.compacted(state, before=12).count() == 0


def test_field_deletes_one_record_tables_and_odd_rows(spark):
    flags = U.ChangeFlags(insert="1", update=None, delete="-1")
    rows = [("a", "x", "y", "1", 1), ("a", "x", "y", "-1", 2), ("b", "z", "", "1", 3), ("b", "q", "q", "0", 4), ("b", "w", None, "1", None)]
    feed = spark.createDataFrame(rows, FEED)
    key = U.key_of(["id"])
    state = W.change_state(feed, key, {"name": "name"}, "flag", flags, delete_mode="fields")
    assert seen(W.merge_registers(state)) == {("b", "name"): "z"}  # a null seq is older than any
    state = W.change_state(feed, key, {"all": ["name", "note"]}, "flag", flags, onehash="t", skip_empty=True)
    assert seen(W.merge_registers(state)) == {("t", "b"): "z,"}
    assert seen(W.merge_registers(changes(feed.limit(0)))) == {}
    with pytest.raises(ValueError):
        W.change_state(feed, key, FIELDS, "flag", delete_mode="row")


def test_merging_shuffles_once_by_key_and_field(spark):
    plan = W.merge_registers(changes(spark.createDataFrame(feed_rows(), FEED)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(hash_key") == 1 and "field" in plan.split("Exchange hashpartitioning(")[1][:60]


def size(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def test_a_change_writes_the_buckets_that_it_touches(spark):
    rows = spark.range(40_000).selectExpr("cast(id as string) as k", "id * 3 as n")
    table = BucketedTable.create(rows, new_shared_path(spark, "bucketed"), ["k"], buckets=32)
    first = table.manifest()
    whole = size(spark, f"{table.path}/data")
    add = lambda old, new: old.unionByName(new).groupBy("k").agg(F.sum("n").alias("n"))
    written = {}
    for keys in (1, 3):
        change = spark.range(keys).selectExpr("cast(id * 1000 as string) as k", "1 as n")
        before = table.manifest()
        touched = table.update(change, add)
        after = table.manifest()
        new = {f.split("/")[0] for b, f in after.folders.items() if f != before.folders[b]}
        assert len(touched) == len({b for b in after.folders if after.folders[b] != before.folders[b]}) <= keys
        written[keys] = sum(size(spark, f"{table.path}/data/{v}") for v in new) / len(touched)
    assert all(0.5 * whole / 32 < w < 2 * whole / 32 for w in written.values())
    got = {r.k: r.n for r in table.read().collect()}
    assert len(got) == 40_000 and got["0"] == 2 and got["1000"] == 3001 and got["1001"] == 3003
    # readers of an older manifest still see what it names, until it is cleaned up
    assert table.read(manifest=first).agg(F.sum("n")).first()[0] == 3 * 40_000 * 39_999 // 2
    assert table.vacuum(keep=2) and table.read().count() == 40_000 and not table.vacuum(keep=2)


def test_batches_once_empty_tables_null_keys_and_two_writers(spark):
    table = BucketedTable.create(spark.createDataFrame([], "k string, n long"), new_shared_path(spark, "bucketed"), ["k"], 4)
    add = lambda old, new: old.unionByName(new).groupBy("k").agg(F.sum("n").alias("n"))
    rows = spark.createDataFrame([("a", 1), (None, 5), ("a", 2)], "k string, n long")
    assert table.read().collect() == []
    for batch in (0, 0, 1, 0):
        table.update(rows, add, batch)
    assert {r.k: r.n for r in table.read().collect()} == {"a": 6, None: 10}
    assert table.update(rows.limit(0), add, 2) == [] and table.manifest().batch == 2
    table.update(rows, lambda old, new: old.limit(0))
    assert table.read().collect() == [] and table.manifest().folders == {}
    stale = table.manifest()
    table.update(rows, add)
    with pytest.raises(RuntimeError):
        table._commit(type(stale)(stale.number + 1, 4, ["k"], stale.schema))
    with pytest.raises(ValueError):
        BucketedTable.create(spark.createDataFrame([(1,)], "bucket int"), "x", ["bucket"])


def test_a_stream_of_changes_in_any_order(spark):
    rows = feed_rows(300)
    path = new_shared_path(spark, "feed")
    df = spark.createDataFrame(rows, FEED)
    for part in (2, 0, 1):
        df.where(F.pmod(F.xxhash64("seq"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(f"{path}/in")
    state = BucketedTable.create(spark.createDataFrame([], W.STATE), f"{path}/state", ["hash_key"], 8)
    stream = spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    handler = S.apply_feed(state, changes)

    def twice(batch, batch_id):
        handler(batch, batch_id)
        handler(batch, batch_id)

    R.start_batches(stream, twice, f"{path}/checkpoint").awaitTermination()
    assert state.manifest().batch == 2 and seen(state.read()) == last_writer(rows)


def test_streams_of_an_empty_table_and_of_null_ids(spark):
    from queryset.views import arrivals

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert R.run_to_table(arrivals(events.limit(0), 4), "empty").count() == 0
    some = events.limit(50).withColumn("event_id", F.when(F.col("event_id") % 5 > 0, F.col("event_id")))
    out = R.run_to_table(arrivals(some, 3), "nulls")
    assert out.count() == 50 and out.select("batch").distinct().count() == 3
    assert out.where("event_id is null").select("batch").distinct().collect() == [(0,)]
    bounds = out.groupBy("batch").agg(F.min("event_id").alias("low"), F.max("event_id").alias("high")).orderBy("batch").collect()
    assert all(a.high < b.low for a, b in zip(bounds, bounds[1:], strict=False))

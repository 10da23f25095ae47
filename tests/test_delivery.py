import json

import pytest
from pyspark.sql import functions as F

from beaconflow.operators import lookups as J
from beaconflow.session import new_shared_path
from beaconflow.sources import shared_files as S
from beaconflow.sources.rolling import RollingArchive
from beaconflow.streaming import runner as R


def test_a_retried_batch_goes_to_those_that_have_not_taken_it(spark):
    taken, away = [], {("b", 0): 2, ("c", 1): 1}

    def consumer(name):
        def consume(batch, batch_id):
            if away.get((name, batch_id), 0):
                away[name, batch_id] -= 1
                raise ConnectionError(name)
            taken.append((batch_id, name, batch.count()))

        return consume

    ledger = R.Ledger(spark, new_shared_path(spark, "ledger"))
    consumers = {name: consumer(name) for name in ("a", "b", "c/d")} | {"c": consumer("c")}
    prepared = []
    handler = R.delivering(lambda b: prepared.append(1) or b.where("id > 0"), consumers, ledger)
    for batch_id in (0, 1, 2, 3):
        for _ in range(4):
            try:
                handler(spark.range(3 + batch_id), batch_id)
                break
            except R.DeliveryError as error:
                assert "b" in str(error) or "c" in str(error)
    assert sorted(taken) == [(i, n, 2 + i) for i in range(4) for n in ("a", "b", "c", "c/d")]
    assert [(b, n) for b, n, _ in taken].index((0, "b")) > [(b, n) for b, n, _ in taken].index((0, "c"))
    before = len(prepared)
    handler(spark.range(3), 3)
    assert len(prepared) == before  # nobody waits, nothing is computed
    assert S.names(spark, ledger._path) == ["batch=2", "batch=3"]
    with pytest.raises(ConnectionError):
        R.delivering(lambda b: b, {"x": lambda b, i: (_ for _ in ()).throw(ConnectionError())})(spark.range(1), 0)


def test_the_batch_log_replaces_a_batch_that_is_run_again(spark):
    path = new_shared_path(spark, "log")
    log = R.BatchLog(spark, path, "mine")

    class Progress:
        name, batchId, numInputRows, timestamp, durationMs = "mine", 0, 5, "2024-01-01T00:00:00.000Z", {"triggerExecution": 7}

    class Event:
        progress = Progress()

    for name, batch, n in (("mine", 0, 5), ("other", 1, 9), ("mine", 0, 6), ("mine", 1, 0), ("mine", 2, 1)):
        Event.progress.name, Event.progress.batchId, Event.progress.numInputRows = name, batch, n
        log.onQueryProgress(Event)
    assert [tuple(r) for r in log.read().orderBy("batch").collect()] == [
        (0, 6, "2024-01-01T00:00:00.000Z", 7), (2, 1, "2024-01-01T00:00:00.000Z", 7)
    ]


def lines(spark, start, n, width=20):
    return spark.range(start, start + n, 1, 2).select(F.lpad(F.col("id").cast("string"), width, "0").alias("value"))


def test_a_rolling_archive_keeps_its_bounds_and_every_line_once(spark):
    now = [0.0]
    archive = RollingArchive(spark, new_shared_path(spark, "rolling"), 5000, 100.0, lambda: now[0])
    assert archive.read().collect() == [] and archive.files() == []
    want, at = [], 0
    for batch_id, n in enumerate((40, 40, 200, 3, 90, 0, 500, 10)):  # 21 bytes a line
        batch = lines(spark, at, n)
        for _ in range(2):  # each batch comes twice
            archive.take(batch, batch_id)
        want += [f"{i:020d}" for i in range(at, at + n)]
        at += n
        assert sorted(r.value for r in archive.read().collect()) == want
    sizes = [size for _, size in archive.files()]
    assert sizes and max(sizes) <= 5250  # the largest small file is half of 500 lines
    archive.close()
    files = archive.files()
    assert len(files) == archive.state().packs and sorted(r.value for r in archive.read().collect()) == want
    assert [r.value for path, _ in files for r in spark.read.text(path).collect()] == want  # packs hold the lines in order
    assert all(a + b > 5000 for (_, a), (_, b) in zip(files[:-2], files[1:-1], strict=True))
    # age closes a pack that is not full
    archive.take(lines(spark, at, 2), 8)
    packs = archive.state().packs
    now[0] = 200.0
    archive.take(lines(spark, at + 2, 2), 9)
    assert archive.state().packs == packs + 1 and archive.state().since == {}
    # a writer that stopped after its manifest leaves files that nobody reads twice
    state = archive.state()
    name = "batch=000000000009/part-left"
    S.put_text(spark, f"{archive.path}/incoming/{name}", "again\n")
    S.put_text(spark, f"{archive.path}/manifest/{state.number}.json", json.dumps({**state.__dict__, "packed": [name]}))
    assert archive.read().where("value = 'again'").count() == 0
    archive.take(lines(spark, at + 4, 1), 10)
    assert archive.read().count() == at + 5


def test_a_filter_of_many_needed_keys_prunes_the_dimension_before_its_shuffle(spark):
    records = spark.range(4000).selectExpr("concat('k', id * 5) as a", "if(id % 7 = 0, null, concat('k', id * 5 + 1)) as b")
    dimension = spark.range(60_000).selectExpr("if(id = 9, null, concat('k', id)) as key", "id", "array(id) as __x")
    keys = [F.col("a"), F.col("b")]
    want = sorted(r.id for r in J.needed_keys(records, keys, dimension, "key", small=True).collect())
    found = J.needed_keys(records, keys, dimension, "key", small=False)
    assert sorted(r.id for r in found.collect()) == want and found.columns == dimension.columns and len(want) == 7428
    plan = found._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("Exchange hashpartitioning(key") :]  # below the dimension's own exchange
    assert "bitmapBitPosition" in side
    wanted = records.selectExpr("explode(array(a, b)) as key").distinct()
    kept = J.passing(dimension, J.key_filter(wanted, "key"), "key").count()
    assert len(want) <= kept < len(want) + 0.06 * 60_000
    assert J.needed_keys(records.limit(0), keys, dimension, "key", small=False).collect() == []


def test_keys_too_many_for_a_filter_meet_the_whole_dimension(spark, monkeypatch):
    monkeypatch.setattr(J, "FILTER_BYTES", 10)
    records = spark.range(50).selectExpr("concat('k', id) as a")
    dimension = spark.range(200).selectExpr("concat('k', id) as key", "id")
    assert J.key_filter(records.withColumnRenamed("a", "key"), "key") is None
    assert J.needed_keys(records, [F.col("a")], dimension, "key", small=False).count() == 50

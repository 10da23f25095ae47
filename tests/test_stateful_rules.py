import random
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from beaconflow.operators.correlate import correlate_sources
from beaconflow.operators.stay import StayConfig
from beaconflow.plans.labelling import LabelPlan
from beaconflow.plans.stateful import Need, apply_rules, apply_rules_stream, fetch_needs
from beaconflow.session import new_shared_path
from beaconflow.streaming import events as E
from beaconflow.streaming import runner as R
from beaconflow.streaming.labels import UserLabels, label_users

MINUTE = 60_000


@dataclass
class Spent:
    """A rule of an application: what a user has spent so far, by the price of each record's item, and the dearest item."""

    name: str = "spent"
    inputs: list = field(default_factory=lambda: ["item", "prices__price"])
    state: str = "total double, top string, top_price double"
    outputs: str = "spent double, dearest string"
    needs: list = field(default_factory=lambda: [Need("prices", "item", "name", ("price",))])

    def step(self, state, rows):
        total, top, most = state or (0.0, None, -1.0)
        prices = rows["prices__price"].fillna(0.0).to_numpy()
        sums, tops = total + np.cumsum(prices), []
        for item, price in zip(rows["item"], prices, strict=True):
            if price > most:
                top, most = item, price
            tops.append(top)
        return (float(sums[-1]), top, float(most)), pd.DataFrame({"spent": sums, "dearest": tops})


@dataclass
class Repeats:
    """Another one: how often the same item came in a row."""

    name: str = "repeats"
    inputs: list = field(default_factory=lambda: ["item"])
    state: str = "item string, n long"
    outputs: str = "repeats long"
    needs: list = field(default_factory=list)

    def step(self, state, rows):
        last, n = state or (None, 0)
        out = []
        for item in rows["item"]:
            n = n + 1 if item == last else 1
            last = item
            out.append(n)
        return (last, n), pd.DataFrame({"repeats": out})


RULES = [Spent(), Repeats()]


def bought(spark, n=500):
    rng = random.Random(4)
    rows = [(f"u{rng.randrange(7)}" if rng.random() < 0.97 else None, i, 1000 + i, rng.choice("abcx")) for i in range(n)]
    return spark.createDataFrame(rows, "imsi string, seq long, ts_ms long, item string")


def as_stream(spark, df, parts):
    path = new_shared_path(spark, "input")
    for part in parts:
        df.where(part).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def lookups(spark):
    return {"prices": spark.createDataFrame([("a", 1.5), ("b", 2.0), ("c", 9.25)], "name string, price double")}


def brute(rows):
    prices, users, out = {"a": 1.5, "b": 2.0, "c": 9.25}, {}, set()
    for r in sorted(rows, key=lambda r: r.seq):
        total, top, most, last, n = users.get(r.imsi, (0.0, None, -1.0, None, 0))
        price = prices.get(r.item, 0.0)
        top, most = (r.item, price) if price > most else (top, most)
        n = n + 1 if r.item == last else 1
        users[r.imsi] = (total + price, top, most, r.item, n)
        out.add((r.imsi, r.seq, str(total + price), top, str(n)))
    return out


def labelled(df):
    at = lambda rule, name: F.col("labels")[rule][name]
    return {tuple(r) for r in df.select("imsi", "seq", at("spent", "spent"), at("spent", "dearest"), at("repeats", "repeats")).collect()}


def test_rules_with_state_in_batch_and_stream(spark):
    df, plan = bought(spark), LabelPlan(stateful=RULES)
    want = brute(df.collect())
    assert labelled(plan.label(df, lookups(spark), skew=None)) == want
    stream = as_stream(spark, df, ["seq < 100", "seq between 100 and 101", "seq > 101"])
    assert labelled(R.run_to_table(plan.label_stream(stream, lookups(spark)), "rules")) == want


def test_runs_of_any_size_in_a_batch(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = bought(spark, 120)
        out = apply_rules(fetch_needs(df, RULES, lookups(spark)), RULES)
        got = {(r.imsi, r.seq, str(r.spent), r.dearest, str(r.repeats)) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == brute(df.collect())


def test_rules_share_a_lookup_and_clashes_are_errors(spark):
    df = bought(spark, 10).withColumn("tags", F.create_map(F.lit("k"), F.col("item")))
    both = fetch_needs(df, [Spent(), Spent(name="again")], lookups(spark))
    assert both.columns == [*df.columns, "prices__price"]
    out = apply_rules(both, [Spent()])
    assert {r.tags["k"] == r.item for r in out.collect()} == {True}
    assert apply_rules(both.limit(0), [Spent()]).collect() == [] and apply_rules(df, []) is df
    with pytest.raises(ValueError):
        apply_rules(both, [Spent(), Spent(name="again")])
    with pytest.raises(ValueError):
        fetch_needs(df, [Spent(), Spent(needs=[Need("prices", "upper(item)", "name", ("price",))])], lookups(spark))


def run_and_count(stream):
    """The stream's rows, and how many states are left."""
    path = new_shared_path(stream.sparkSession, "expiring")
    query = R.start_batches(stream, R.write_batches_to(f"{path}/out"), f"{path}/checkpoint")
    query.awaitTermination()
    operators = query.lastProgress["stateOperators"]
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out"), operators[0]["numRowsTotal"]


def waves(spark):
    """Forty users in a first hour; a day and two days later one more each."""
    rows = [(f"u{i % 40}", i, 1440 * MINUTE + i * MINUTE // 2, "ab"[i // 40 % 2], {"A": "true"}) for i in range(120)]
    rows += [("late", 200 + k, (2 + k) * 1440 * MINUTE, "a", {"A": "true"}) for k in range(3)]
    df = spark.createDataFrame(rows, "imsi string, seq long, ts_ms long, source string, area_onsite map<string,string>")
    return df, ["seq < 60", "seq between 60 and 199", "seq = 200", "seq = 201", "seq = 202"]


def test_states_of_correlation_stays_rules_and_events_end(spark):
    df, parts = waves(spark)
    stream = lambda d: as_stream(spark, d, parts).withColumn("at", F.timestamp_millis("ts_ms")).withWatermark("at", "0 seconds")

    slim = df.drop("area_onsite")
    args = (["a", "b"], 120 * MINUTE, 60 * MINUTE)
    want = {r.seq for r in correlate_sources(slim, *args).collect()}
    for expire in (False, True):
        out, left = run_and_count(E.correlate_stream(stream(slim), *args, expire=expire))
        assert {r.seq for r in out.collect()} == want
        assert left <= 2 if expire else left == 41

    config = UserLabels(StayConfig((10 * MINUTE,), timeout_ms=60 * MINUTE), device=False)
    seen = []
    for forget in (None, 60 * MINUTE):
        out, left = run_and_count(label_users(stream(df), config, forget_ms=forget).drop("at"))
        seen.append({(r.seq, tuple(r.area_onsite_stay.items())) for r in out.collect()})
        assert left <= 2 if forget else left == 41
    assert seen[0] == seen[1]
    with pytest.raises(ValueError):
        label_users(stream(df), config, forget_ms=1)

    items = slim.withColumnRenamed("source", "item")
    counts = []
    for forget in (None, 60 * MINUTE):
        out, left = run_and_count(apply_rules_stream(stream(items), [Repeats()], forget_ms=forget).drop("at"))
        counts.append((out.count(), left))
    assert counts[0][0] == counts[1][0] == 123 and counts[1][1] < counts[0][1] / 5

    terms = {"e": E.EventTerms(("a", "b"), 120 * MINUTE, 60 * MINUTE)}
    events = slim.withColumnRenamed("imsi", "user").withColumn("event", F.lit("e"))
    lefts = []
    for expire in (False, True):
        out, left = run_and_count(E.business_events_stream(stream(events), terms, expire=expire).drop("at"))
        assert {r.seq for r in out.collect()} == want
        lefts.append(left)
    assert lefts[1] < lefts[0] / 5


def test_one_source_fires_as_the_walk_does():
    rng = random.Random(3)
    for _ in range(200):
        times = sorted(rng.randrange(300) for _ in range(rng.randrange(30)))
        interval, start = rng.choice([0, 1, 10, 80]), rng.choice([None, 5, 150])
        walk, jump = E.EventLock(start), E.EventLock(start)
        want = [walk.fires(t, "-", ["-"], interval, 10**9, False) for t in times]
        assert E.fired_alone(jump, np.array(times, np.int64), "-", interval).tolist() == want and jump.lock == walk.lock
    rows = pd.DataFrame({"t": pd.array([1, None, 2], "Int64")}).sort_values("t")
    assert E.fired_rows(E.EventLock(), rows, E.EventTerms(("-",), 100, 0), "t", None).tolist() == [True, False, True]

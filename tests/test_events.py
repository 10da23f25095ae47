import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from beaconflow.operators import cooldown as C
from beaconflow.operators.cooldown import cooldown
from beaconflow.operators.correlate import correlate_sources, duplicate_keys_in_batch, last_active
from beaconflow.operators.rules import EventRule, business_projection, event_rule_flags, event_rule_tree, split_expressions
from beaconflow.operators.skew import SLICE, Skew, with_slices
from beaconflow.streaming.events import EventLock

TINY = Skew(share=8, min_rows=10)


def greedy(rows, interval):
    """Brute force: rows (user, ts, seq) that fire."""
    lock, out = {}, []
    for user, ts, seq in sorted(rows):
        if user not in lock or lock[user] + interval <= ts:
            lock[user] = ts
            out.append((user, ts, seq))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "imsi string, ts_ms long, seq long")


def fired(df):
    return sorted(tuple(r) for r in df.collect())


def test_equality_fires(spark):
    rows = [("u", 0, 0), ("u", 9, 1), ("u", 10, 2), ("u", 19, 3), ("u", 20, 4)]
    assert fired(cooldown(frame(spark, rows), 10)) == [rows[0], rows[2], rows[4]]


def test_distance_is_to_the_last_fired_row(spark):
    rows = [("u", t, i) for i, t in enumerate([0, 6, 12, 18, 24])]
    assert [t for _, t, _ in fired(cooldown(frame(spark, rows), 10))] == [0, 12, 24]


def random_rows(seed, span, hot):
    rng = random.Random(seed)
    rows = [("hot", rng.randrange(span), i) for i in range(hot)]
    rows += [(f"u{rng.randrange(30)}", rng.randrange(span), hot + i) for i in range(200)]
    return rows


@pytest.mark.parametrize(
    "seed, span, interval, hot",
    [(1, 1000, 10, 400), (2, 1000, 300, 400), (3, 1000, 5000, 300), (4, 100_000, 7, 300), (5, 50, 8, 500),
     (6, 20_000, 1000, 900), (7, 3000, 97, 600)],
)
def test_cooldown_of_hot_users_is_exact(spark, seed, span, interval, hot):
    rows = random_rows(seed, span, hot)
    want = greedy(rows, interval)
    assert fired(cooldown(frame(spark, rows), interval, skew=None)) == want
    assert fired(cooldown(frame(spark, rows), interval, skew=TINY)) == want
    assert fired(cooldown(frame(spark, rows), interval, skew=Skew(share=200, min_rows=3))) == want


def test_scan_state_survives_batch_borders(spark):
    rows = random_rows(8, 5000, 500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        want = greedy(rows, 150)
        assert fired(cooldown(frame(spark, rows), 150, skew=None)) == want
        assert fired(cooldown(frame(spark, rows), 150, skew=TINY)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_gaps_and_runs(spark):
    rows = [("hot", t, i) for i, t in enumerate([*range(0, 300, 3), *range(1000, 1100), *range(5000, 9000, 37)])]
    for interval in (10, 33, 100, 1000):
        assert fired(cooldown(frame(spark, rows), interval, skew=Skew(share=50, min_rows=5))) == greedy(rows, interval)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=60), st.integers(1, 80), st.lists(st.integers(0, 79), max_size=6))
def test_column_walk_equals_brute_force(times, interval, cuts):
    """The three scans on their own, on plain Arrow batches."""
    import pyarrow as pa

    from beaconflow.operators import cooldown as C

    cuts = sorted({c for c in cuts if c < interval})
    rows = sorted((t, i) for i, t in enumerate(times))
    column = {t: sum(c <= t % interval for c in cuts) for t in times}

    def batch(triples):
        users, slices, entries = zip(*triples)
        return pa.RecordBatch.from_arrays(
            [pa.array(users), pa.array(slices, pa.int32()), pa.array(entries, pa.int64())],
            names=["u", C.SLICE, "entry"],
        )

    cells_in = sorted(("h", column[t], t) for t in times)
    half = len(cells_in) // 2
    parts = [p for p in (cells_in[:half], cells_in[half:]) if p]
    cells = [r for b in C._chain_scan("u", interval)(iter([batch(p) for p in parts])) for r in b.to_pylist()]
    cells.sort(key=lambda r: (r["entry"] // interval, r[C.SLICE]))
    walked = [
        r for b in C._walk_scan("u", interval)(iter([pa.RecordBatch.from_pylist(cells)])) for r in b.to_pylist()
    ]
    got = set()
    for r in walked:
        lock = None
        for t in sorted({t for t in times if column[t] == r[C.SLICE] and r["entry"] <= t <= r["last"]}):
            if lock is None or t >= lock + interval:
                lock = t
                got.add(t)
    assert sorted(got) == [t for _, t, _ in greedy([("h", t, i) for t, i in rows], interval)]


SOURCES = ["a", "b", "c"]


def correlated(rows, interval, delay, require_all, sources=SOURCES):
    locks, out = {}, []
    for user, ts, seq, source in sorted(rows):
        lock = locks.setdefault(user, EventLock())
        if lock.fires(ts, source, sources, interval, delay, require_all):
            out.append((user, ts, seq, source))
    return out


@pytest.mark.parametrize("require_all", [False, True])
@pytest.mark.parametrize("seed, span, interval, delay", [(1, 2000, 100, 20), (2, 5000, 400, 15), (3, 500, 50, 3), (4, 9000, 90, 2)])
def test_correlation_equals_row_by_row(spark, seed, span, interval, delay, require_all):
    rng = random.Random(seed)
    rows = [(u, t, s, rng.choice(SOURCES)) for u, t, s in random_rows(seed, span, 300)]
    df = spark.createDataFrame(rows, "imsi string, ts_ms long, seq long, source string")
    want = correlated(rows, interval, delay, require_all)
    for skew in (None, TINY):
        assert fired(correlate_sources(df, SOURCES, interval, delay, require_all, skew=skew)) == want


def test_correlation_contract(spark):
    # Fires on every row until both sources are there, then rests, then any source fires.
    rows = [("u", 0, 0, "a"), ("u", 5, 1, "a"), ("u", 8, 2, "b"), ("u", 9, 3, "a"), ("u", 58, 4, "b")]
    df = spark.createDataFrame(rows, "imsi string, ts_ms long, seq long, source string")
    assert [r[2] for r in fired(correlate_sources(df, ["a", "b"], 50, 10))] == [0, 1, 2, 4]
    assert [r[2] for r in fired(correlate_sources(df, ["a", "b"], 50, 10, require_all=True))] == [2, 4]
    # Silent for longer than the delay: forgotten.
    assert [r[2] for r in fired(correlate_sources(df, ["a", "b"], 50, 2, require_all=True))] == [3]


def test_last_active_and_duplicates(spark):
    df = spark.createDataFrame(
        [("e", "u", "s", 5, 1), ("e", "u", "s", 3, 1), ("e", "v", "s", 4, 2)],
        "event string, imsi string, source string, ts_ms long, batch long",
    )
    assert fired(last_active(df)) == [("e", "u", "s", 5), ("e", "v", "s", 4)]
    assert fired(duplicate_keys_in_batch(df, "batch", "imsi")) == [(1, "u", 2)]


RULES = [EventRule("10", "x > 5", "2"), EventRule("2", "y = 'k'"), EventRule("3", "x < 9", "10")]


def test_rule_tree_and_flags_agree(spark):
    df = spark.createDataFrame([(i, "k" if i % 2 else None) for i in range(12)], "x int, y string")
    frames = event_rule_tree(df, RULES)
    assert sorted(r.x for r in frames["3"].collect()) == [7]
    flags = event_rule_flags(df, RULES)
    for rule in ("2", "10", "3"):
        assert sorted(r.x for r in flags.where(F.col(f"rule_{rule}")).collect()) == sorted(r.x for r in frames[rule].collect())


@pytest.mark.parametrize("rules", [[EventRule("1", "true", "9")], [EventRule("1", "true", "2"), EventRule("2", "true", "1")],
                                   [EventRule("1", "true", "1")], [EventRule("1", "true"), EventRule("1", "true")]])
def test_bad_rule_trees(spark, rules):
    with pytest.raises(ValueError):
        event_rule_tree(spark.range(1), rules)


def test_missing_label_does_not_match(spark):
    df = spark.sql("select map('area_onsite', map('X', 'true')) labels union all select map('other', map('X', 'true'))")
    assert event_rule_tree(df, [EventRule("1", "labels['area_onsite']['X'] = 'true'")])["1"].count() == 1


def test_projection_splits_only_at_the_top(spark):
    assert split_expressions("a, concat(b, ','), m['x,y'], (c)") == ["a", "concat(b, ',')", "m['x,y']", "(c)"]
    row = business_projection(spark.range(1), "id, concat('a', ',', 'b') as c").first()
    assert tuple(row) == (0, "a,b")


def test_rows_without_time_or_user_fire_and_disturb_nobody(spark):
    rng = random.Random(3)
    rows = [(u, rng.randrange(500), i) for i, u in enumerate(rng.choices(["u1", "u2", "hot"], [1, 1, 4], k=300))]
    odd = [("u2", None, 900), ("hot", None, 901), (None, 5, 902), (None, 5, 903), (None, None, 904)]
    for skew in (None, TINY):
        got = cooldown(frame(spark, rows + odd), 20, skew=skew).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, [*greedy(rows, 20), *odd]))


@pytest.mark.parametrize("interval", [1, 7, 60, 900, 20_000])
def test_walks_in_blocks_fire_what_one_walk_fires(spark, interval, monkeypatch):
    """Short and long intervals; no task of the walk gets more than a small part of the hot user's summaries."""
    rng = random.Random(interval)
    times = [rng.randrange(20_000) for _ in range(900)] + list(range(0, 20_000, 40)) + list(range(3, 20_000, 61))
    rows = [("hot", t, i) for i, t in enumerate(times)] + [(f"u{i % 9}", t, 5000 + i) for i, t in enumerate(times[:200])]
    sizes, real = [], C._walk_blocks

    def watched(cells, width, user, cuts):
        sizes.append((cells.count(), max(r["count"] for r in with_slices(cells.drop(SLICE), user, F.col("__slot"), cuts).groupBy(SLICE).count().collect())))
        return real(cells, width, user, cuts)

    monkeypatch.setattr(C, "_walk_blocks", watched)
    got = cooldown(frame(spark, rows), interval, skew=Skew(share=10, min_rows=30))
    assert fired(got) == greedy(rows, interval)
    if interval <= 900:
        assert sizes and all(largest < 0.2 * n + 30 for n, largest in sizes)


def test_correlation_takes_one_shuffle(spark):
    rows = spark.range(3000).selectExpr("concat('u', id % 40) as imsi", "id * 17 % 5000 as ts_ms", "id as seq", "if(id % 3 = 0, 'a', 'b') as source")
    for require_all in (False, True):
        df = correlate_sources(rows, ["a", "b"], 100, 1000, require_all)
        df.count()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Exchange REPARTITION" not in plan
        cut = correlate_sources(rows, ["a", "b"], 100, 1000, require_all, skew=TINY)
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, cut.collect()))

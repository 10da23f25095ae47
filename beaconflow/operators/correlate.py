"""Business events fed by several sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconflow.constants import COOLDOWN_MS, CORRELATION_DELAY_MS
from beaconflow.operators.cooldown import cooldown
from beaconflow.operators.skew import CARRY, DEFAULT_SKEW, HOT, SLICE, HotKeys, Skew, find_cuts, with_slices


def tag_sources(frames: dict[str, DataFrame], source: str = "source") -> DataFrame:
    """Several sources as one frame, each row tagged with its source id."""
    tagged = [df.withColumn(source, F.lit(name)) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def _seen(source: str, ts: str, name: str) -> Column:
    return F.when(F.col(source) == name, F.col(ts))


def _carry_rows(rows: DataFrame, user: str, ts: str, source: str, sources: list[str]) -> DataFrame:
    """For each slice of a hot user: when each source was last seen before it."""
    latest = [F.max(_seen(source, ts, s)).alias(f"__seen{i}") for i, s in enumerate(sources)]
    along = Window.partitionBy(user).orderBy(SLICE)
    return (
        rows.where(HOT)
        .groupBy(user, SLICE)
        .agg(F.max(ts).alias("__end"), *latest)
        .withColumns({f"__seen{i}": F.max(f"__seen{i}").over(along) for i in range(len(sources))})
        .withColumn("__into", F.lead(SLICE).over(along))
        .where("__into is not null")
        .select(
            user,
            F.col("__into").alias(SLICE),
            F.col("__end").alias(ts),
            *[f"__seen{i}" for i in range(len(sources))],
            F.lit(True).alias(HOT),
            F.lit(True).alias(CARRY),
        )
    )


def with_presence(
    rows: DataFrame,
    sources: list[str],
    delay_ms: int = CORRELATION_DELAY_MS,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    source: str = "source",
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
) -> DataFrame:
    """Add ``complete``: all sources were seen within ``delay`` up to this row or an earlier one."""
    cuts = find_cuts(rows, user, F.col(ts), skew)
    sliced = with_slices(rows, user, F.col(ts), cuts)
    seen = [f"__seen{i}" for i in range(len(sources))]
    full = sliced.withColumns(
        {**{c: _seen(source, ts, s) for c, s in zip(seen, sources)}, CARRY: F.lit(False)}
    )
    if cuts:
        full = full.unionByName(_carry_rows(sliced, user, ts, source, sources), allowMissingColumns=True)
    w = Window.partitionBy(user, SLICE).orderBy(ts, F.col(CARRY).desc(), seq)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Sources silent for longer than the delay are forgotten.
    alive = [F.coalesce(F.max(c).over(upto) >= F.col(ts) - delay_ms, F.lit(False)) for c in seen]
    full = full.withColumn("__now", reduce(lambda a, b: a & b, alive)).where(~F.col(CARRY))
    full = full.withColumn("complete", F.max("__now").over(upto))
    if cuts:
        # A hot user's first complete row may lie in an earlier slice: one row per hot user.
        opened = full.where(F.col(HOT) & F.col("__now")).groupBy(user).agg(F.min(ts).alias("__opened"))
        full = full.join(F.broadcast(opened), user, "left").withColumn(
            "complete",
            F.col("complete") | F.coalesce(F.col("__opened") < F.col(ts), F.lit(False)),
        )
    return full.select(*rows.columns, "complete")


def correlate_sources(
    rows: DataFrame,
    sources: list[str],
    interval_ms: int = COOLDOWN_MS,
    delay_ms: int = CORRELATION_DELAY_MS,
    require_all: bool = False,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    source: str = "source",
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
) -> DataFrame:
    """The rows that fire for a business event over several sources.

    Until all sources have been active within ``delay`` every row fires (none
    with ``require_all``); the row completing them fires and starts the first
    rest, after which any source fires again once the interval is over.
    """
    if len(sources) == 1:
        return cooldown(rows, interval_ms, user, ts, seq, skew=skew)
    if isinstance(skew, Skew):
        skew = HotKeys(rows, user, skew)
    marked = with_presence(rows, sources, delay_ms, user, ts, seq, source, skew)
    if require_all:
        return cooldown(marked.where("complete").drop("complete"), interval_ms, user, ts, seq, skew=skew, clustered=True)
    marked = marked.withColumn("__early", ~F.col("complete")).drop("complete")
    return cooldown(marked, interval_ms, user, ts, seq, free="__early", skew=skew, clustered=True).drop("__early")


def last_active(
    rows: DataFrame, event: str = "event", user: str = "imsi", source: str = "source", ts: str = "ts_ms"
) -> DataFrame:
    """Latest activity of each (event, user, source)."""
    return rows.groupBy(event, user, source).agg(F.max(ts).alias("last_active_ms"))


def duplicate_keys_in_batch(rows: DataFrame, batch: str, user: str) -> DataFrame:
    """Users firing more than once within one batch."""
    return rows.groupBy(batch, user).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def co_locate_by_user(rows: DataFrame, user: str = "imsi") -> DataFrame:
    """Bring each user's rows of one (bounded) micro-batch together."""
    return rows.repartition(F.col(user))

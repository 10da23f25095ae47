"""Continuous stay of a user in an area.

For records in time order a stay is a gap session per (user, area): a pause
longer than ``timeout`` starts it anew. A record is labelled when the stay
crosses one of the limits, both ends inclusive, so a limit that is met exactly
is met again by the next record. A record at the time of its predecessor gets 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconflow.constants import AREA_ONSITE, AREA_ONSITE_STAY, STAY_TIMEOUT_MS
from beaconflow.operators.skew import CARRY, DEFAULT_SKEW, HOT, SLICE, Cuts, HotKeys, Skew, find_cuts, with_slices


_NUMBER = "__number"


@dataclass(frozen=True)
class StayConfig:
    """Limits in milliseconds; which of several crossed limits counts; limit or true stay as label."""

    limits: tuple[int, ...]
    match_max: bool = True
    output_threshold: bool = True
    timeout_ms: int = STAY_TIMEOUT_MS
    ordered_limits: tuple[int, ...] = field(init=False)

    def __post_init__(self) -> None:
        if not self.limits:
            raise ValueError("at least one stay limit is needed")
        object.__setattr__(self, "ordered_limits", tuple(sorted(int(x) for x in self.limits)))


def crossing_label(old: Column, new: Column, config: StayConfig) -> Column:
    """The label of a stay growing from ``old`` to ``new``, 0 when no limit lies between."""
    crossed = [F.when((old <= x) & (new >= x), F.lit(x).cast("long")) for x in config.ordered_limits]
    # The limits are ascending, so the largest crossed one is the first from the end.
    best = F.coalesce(*(reversed(crossed) if config.match_max else crossed))
    label = best if config.output_threshold else F.when(best.isNotNull(), new)
    return F.coalesce(label, F.lit(0).cast("long"))


def _gap(config: StayConfig, previous: Column, ts: Column) -> Column:
    return previous.isNull() | (ts - previous > config.timeout_ms)


def _carry_rows(visits: DataFrame, user: str, ts: str, seq: str, config: StayConfig) -> DataFrame:
    """For each slice of a hot user and area: the last visit before it and the start of that stay."""
    inside = Window.partitionBy(user, SLICE, "area").orderBy(ts, seq)
    breaks = F.when(_gap(config, F.lag(ts).over(inside), F.col(ts)), F.col(ts))
    parts = (
        visits.where(HOT)
        .withColumn("__break", breaks)
        .groupBy(user, "area", SLICE)
        .agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.max("__break").alias("tail"))
    )
    along = Window.partitionBy(user, "area").orderBy(SLICE)
    # A slice without an inner break continues the stay of the slice before it,
    # unless the pause between the two is a break.
    joins_on = (F.col("tail") == F.col("first")) & ~_gap(config, F.lag("last").over(along), F.col("first"))
    return (
        parts.withColumn("__reset", F.when(~joins_on, F.col("tail")))
        .withColumn("__start", F.last("__reset", ignorenulls=True).over(along))
        .withColumn("__into", F.lead(SLICE).over(along))
        .where("__into is not null")
        .select(
            user,
            "area",
            F.col("__into").alias(SLICE),
            F.col("last").alias(ts),
            F.col("__start"),
            F.lit(True).alias(CARRY),
        )
    )


def dwell(
    visits: DataFrame,
    config: StayConfig,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
) -> DataFrame:
    """Add ``stay_start``, ``stay_ms`` and the label ``stay`` to rows of (user, area, time).

    One shuffle by user; the windows per area run inside it.
    """
    cuts = find_cuts(visits, user, F.col(ts), skew)
    sliced = with_slices(visits, user, F.col(ts), cuts)
    return _dwell_sliced(sliced, config, user, ts, seq, cuts).drop(SLICE, HOT)


def _dwell_sliced(visits: DataFrame, config: StayConfig, user: str, ts: str, seq: str, cuts: Cuts) -> DataFrame:
    rows = visits.withColumns({"__start": F.lit(None).cast("long"), CARRY: F.lit(False)})
    if cuts:
        rows = rows.unionByName(_carry_rows(visits, user, ts, seq, config), allowMissingColumns=True)
    # A carry row comes first in its slice whatever else happened at its time.
    w = Window.partitionBy(user, SLICE, "area").orderBy(ts, F.col(CARRY).desc(), seq)
    previous = F.lag(ts).over(w)
    rows = rows.withColumn("__prev", previous).withColumn("__new", _gap(config, F.col("__prev"), F.col(ts)))
    started = F.when(F.col(CARRY), F.col("__start")).when(F.col("__new"), F.col(ts))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("stay_start", F.last(started, ignorenulls=True).over(upto))
    old, new = F.col("__prev") - F.col("stay_start"), F.col(ts) - F.col("stay_start")
    fresh = F.col("__new") | (F.col("__prev") == F.col(ts))
    label = F.when(fresh, F.lit(0).cast("long")).otherwise(crossing_label(old, new, config))
    return (
        rows.where(~F.col(CARRY))
        .withColumns({"stay_ms": new, "stay": label})
        .drop("__start", "__prev", "__new", CARRY)
    )


def label_stay(
    records: DataFrame,
    config: StayConfig,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
) -> DataFrame:
    """Add the map area -> stay label (text) for the areas flagged on each record.

    Records are numbered within their user (and slice) before they are exploded
    and are regrouped by that number, so none is lost, whatever their ``seq``.
    Numbering, exploding, labelling and regrouping all happen within the one
    shuffle by user.
    """
    payload = [c for c in records.columns if c != user]
    hashable = [c for c, kind in records.dtypes if "map<" not in kind and kind != "variant"]
    cuts = find_cuts(records, user, F.col(ts), skew)
    along = Window.partitionBy(user, SLICE).orderBy(ts, seq, F.xxhash64(*hashable))
    sliced = with_slices(records, user, F.col(ts), cuts).withColumn(_NUMBER, F.row_number().over(along))
    visits = sliced.select(
        user,
        _NUMBER,
        SLICE,
        HOT,
        ts,
        F.struct(*payload).alias("__row"),
        F.posexplode_outer(F.map_keys(AREA_ONSITE)).alias("__at", "area"),
    )
    # One of a record's visits carries the record.
    visits = visits.withColumn("__row", F.when(F.coalesce("__at", F.lit(0)) == 0, F.col("__row"))).drop("__at")
    # Only the visits themselves take part in the carry computation.
    labelled = _dwell_sliced(visits, config, user, ts, _NUMBER, cuts)
    entry = F.when(F.col("area").isNotNull(), F.struct("area", F.col("stay").cast("string")))
    return (
        labelled.groupBy(user, SLICE, _NUMBER)
        .agg(F.first("__row", ignorenulls=True).alias("__row"), F.map_from_entries(F.collect_list(entry)).alias(AREA_ONSITE_STAY))
        .select(user, "__row.*", AREA_ONSITE_STAY)
        .select(user, seq, *[c for c in payload if c != seq], AREA_ONSITE_STAY)
    )


def last_activity(visits: DataFrame, user: str = "imsi", ts: str = "ts_ms") -> DataFrame:
    """The user's newest visit over all areas."""
    return visits.groupBy(user).agg(F.max(ts).alias("last_activity_ms"))

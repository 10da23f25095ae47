"""What changed since the user's previous record: device, place, speed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconflow.functions.geo import haversine_km
from beaconflow.operators.skew import (
    CARRY, DEFAULT_SKEW, HOT, SLICE, HotKeys, Skew, carry_last_rows, find_cuts, with_slices,
)


def _with_previous(
    rows: DataFrame, columns: dict[str, str], user: str, ts: str, seq: str, skew: Skew | HotKeys | None
) -> DataFrame:
    """Add the previous record's value of each column under its new name."""
    cuts = find_cuts(rows, user, F.col(ts), skew)
    sliced = with_slices(rows, user, F.col(ts), cuts)
    full = sliced.withColumn(CARRY, F.lit(False))
    if cuts:
        slim = sliced.select(*dict.fromkeys([user, ts, seq, SLICE, HOT, *columns]))
        full = full.unionByName(carry_last_rows(slim, user, [ts, seq]), allowMissingColumns=True)
    w = Window.partitionBy(user, SLICE).orderBy(ts, seq)
    return (
        full.withColumns({new: F.lag(old).over(w) for old, new in columns.items()})
        .where(~F.col(CARRY))
        .drop(SLICE, HOT, CARRY)
    )


def last_device(
    rows: DataFrame,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    imei: str = "imei",
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
) -> DataFrame:
    """Add ``last_imei``, the device of the user's previous record, "" at first."""
    out = _with_previous(rows, {imei: "last_imei"}, user, ts, seq, skew)
    return out.withColumn("last_imei", F.coalesce("last_imei", F.lit("")))


_MOVES = {"geo_latitude": "__lat", "geo_longitude": "__lng", "lac_ci": "last_lac_ci"}


def movement(
    rows: DataFrame,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
) -> DataFrame:
    """Add distance (km), elapsed time (ms), speed (km/h) and previous cell; null on the first record."""
    return _moved(_with_previous(rows, {**_MOVES, ts: "__prev_ts"}, user, ts, seq, skew), ts)


def track(
    rows: DataFrame,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
) -> DataFrame:
    """:func:`last_device` and :func:`movement` in one pass."""
    columns = {"imei": "last_imei", **_MOVES, ts: "__prev_ts"}
    out = _moved(_with_previous(rows, columns, user, ts, seq, skew), ts)
    return out.withColumn("last_imei", F.coalesce("last_imei", F.lit("")))


def _moved(rows: DataFrame, ts: str) -> DataFrame:
    here = [F.col(c).cast("double") for c in ("geo_latitude", "geo_longitude")]
    before = [F.col(c).cast("double") for c in ("__lat", "__lng")]
    elapsed = F.col(ts) - F.col("__prev_ts")
    return (
        rows.withColumns({"distance_km": haversine_km(*before, *here), "elapsed_ms": elapsed})
        .withColumn("speed_kmh", F.try_divide(F.col("distance_km") * 3_600_000, F.col("elapsed_ms")))
        .drop("__lat", "__lng", "__prev_ts")
    )

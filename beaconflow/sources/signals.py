"""Delimited signalling lines to typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconflow.constants import ANONYMOUS_ID, CALLED_EVENTS, MESSAGE_EVENTS
from beaconflow.functions.cells import device14, hex_code
from beaconflow.functions.text import split_fields, strict_int
from beaconflow.functions.times import millis, parse_signal_time

# Field order of the two record layouts.
LAYOUT_17 = (
    "eventID", "time", "lac", "ci", "callingimei", "calledimei", "callingimsi", "calledimsi",
    "callingphone", "calledphone", "eventresult", "alertstatus", "assstatus", "clearstatus",
    "relstatus", "xdrtype", "issmsalone",
)
LAYOUT_15 = tuple(f for f in LAYOUT_17 if f not in ("callingphone", "calledphone"))
LAYOUTS = {15: LAYOUT_15, 17: LAYOUT_17}

_STATUS_FIELDS = ("eventresult", "alertstatus", "assstatus", "clearstatus", "relstatus", "xdrtype", "issmsalone")


def is_anonymous(calling: Column, called: Column) -> Column:
    return (calling == ANONYMOUS_ID) & (called == ANONYMOUS_ID)


def is_valid_at(ts: Column, window_ms: int, now: Column) -> Column:
    """True unless ``ts + window`` lies before ``now``; a window of -1 accepts every time."""
    if window_ms < -1:
        raise ValueError("the validity window is -1 (off) or a number of milliseconds")
    return F.lit(True) if window_ms == -1 else millis(ts) + window_ms >= millis(now)


def subject_of(event: Column, alone: Column, calling: Column, called: Column) -> Column:
    """Whichever of ``calling`` and ``called`` the record is about; null if undecided."""
    return (
        F.when(event.isin(*CALLED_EVENTS), called)
        .when(event.isin(*MESSAGE_EVENTS), F.when(alone == 1, calling).when(alone == 2, called))
        .otherwise(calling)
    )


def drop_anonymous(df: DataFrame, calling: str = "callingimsi", called: str = "calledimsi") -> DataFrame:
    return df.where(~is_anonymous(F.col(calling), F.col(called)))


def within_validity(df: DataFrame, window_ms: int, now: Column | None = None, ts: str = "ts") -> DataFrame:
    return df.where(is_valid_at(F.col(ts), window_ms, F.current_timestamp() if now is None else now))


def resolve_subject(df: DataFrame) -> DataFrame:
    """Add ``imsi`` and ``imei`` of the record's subject; records without one are dropped."""
    return _with_subject(df).where(F.col("imsi").isNotNull())


def _with_subject(df: DataFrame) -> DataFrame:
    def pick(calling: str, called: str) -> Column:
        return subject_of(F.col("eventID"), F.col("issmsalone"), F.col(calling), F.col(called))

    return df.withColumns({"imsi": pick("callingimsi", "calledimsi"), "imei": pick("callingimei", "calledimei")})


def normalise_cell(df: DataFrame, lac: str = "lac", ci: str = "ci") -> DataFrame:
    """Integer cell codes to padded hex, device ids to 14 characters."""
    devices = {c: device14(F.col(c)) for c in ("callingimei", "calledimei") if c in df.columns}
    return df.withColumns({lac: hex_code(F.col(lac)), ci: hex_code(F.col(ci)), **devices})


def parse_signals(
    lines: DataFrame,
    layout: int = 17,
    delim: str = ",",
    validity_ms: int = -1,
    now: Column | None = None,
) -> DataFrame:
    """Typed fields of each line plus ``reject_reason``, null for a good record.

    Works on batch and streaming frames; columns beside ``value`` are kept.
    """
    names = LAYOUTS[layout]
    # Generators keep the optimizer from copying the split and the casts into
    # every expression and filter that uses them.
    kept = [F.col(c) for c in lines.columns]
    split = lines.select(*kept, F.explode(F.array(split_fields(F.col("value"), delim))).alias("__f"))
    raw = {name: F.get("__f", F.lit(i)) for i, name in enumerate(names)}
    fields = {name: raw.get(name, F.lit(None).cast("string")) for name in LAYOUT_17}
    fields |= {c: strict_int(fields[c]) for c in ("eventID", *_STATUS_FIELDS)}
    fields |= {c: hex_code(strict_int(fields[c])) for c in ("lac", "ci")}
    fields |= {c: device14(fields[c]) for c in ("callingimei", "calledimei")}
    fields["ts"] = parse_signal_time(fields["time"])
    fields["__n"] = F.size("__f")
    typed = F.inline(F.array(F.struct(*[c.alias(name) for name, c in fields.items()])))
    df = _with_subject(split.select(*kept, typed))
    moment = F.current_timestamp() if now is None else now
    bad_status = F.greatest(*[F.col(c).isNull().cast("int") for c in _STATUS_FIELDS]) == 1
    reason = (
        F.when(F.col("__n") != len(names), "field_count")
        .when(is_anonymous(F.col("callingimsi"), F.col("calledimsi")), "anonymous")
        .when(F.col("eventID").isNull(), "bad_number")
        .when(F.col("ts").isNull(), "bad_time")
        .when(~is_valid_at(F.col("ts"), validity_ms, moment), "expired")
        .when(F.col("lac").isNull() | F.col("ci").isNull(), "bad_cell")
        .when(bad_status, "bad_number")
        .when(F.col("imsi").isNull(), "no_subject")
    )
    return df.withColumn("reject_reason", reason).drop("__n")


def ingest_signals(lines: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(good records, rejected lines with the reason)."""
    parsed = parse_signals(lines, **options)
    good = parsed.where("reject_reason is null").drop("reject_reason", "value")
    extra = [c for c in lines.columns if c != "value"]
    rejects = parsed.where("reject_reason is not null").select(*extra, "value", "reject_reason")
    return good, rejects


def route_feed(lines: DataFrame, delim: str = ",", received_at: Column | None = None) -> DataFrame:
    """Front door of the feed: drop unusable lines and choose the partition key.

    ``received_at`` (text) is appended to the line first, as one more field.
    """
    value = F.col("value") if received_at is None else F.concat("value", F.lit(delim), received_at)
    kept = [c for c in lines.columns if c != "value"]
    lines = lines.select(*kept, value.alias("value"))

    def field(i: int) -> Column:
        return F.trim(F.get("__f", F.lit(i)))

    calling, called = field(6), field(7)
    other_party = field(0).isin(*map(str, CALLED_EVENTS)) | (
        (field(14) == "2") & field(0).isin(*map(str, MESSAGE_EVENTS))
    )
    # The generator keeps the split from being copied into filters and key.
    split = lines.select(*kept, "value", F.explode(F.array(split_fields(F.col("value"), delim))).alias("__f"))
    return (
        split.where((F.trim("value") != "") & (F.size("__f") >= 15))
        .where(~is_anonymous(calling, called) & ~((calling == "") & (called == "")))
        .withColumn("key", F.when(other_party, called).otherwise(calling))
        .drop("__f")
    )

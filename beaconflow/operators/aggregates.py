"""Counts, running totals and property maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from beaconflow.functions.text import literal_regex
from beaconflow.operators.skew import CARRY, DEFAULT_SKEW, HOT, SLICE, HotKeys, Skew, find_cuts, with_slices


def merge_distinct(incoming: DataFrame, existing: DataFrame | None = None, sep: str = ",") -> DataFrame:
    """Append new values to separated lists, in arrival order, each value once.

    ``incoming``: (hash_key, field, value, seq); ``existing``: (hash_key, field,
    value). Existing lists stay as they are, new values follow. A value is one
    list element and is not expected to contain the separator itself.
    """
    keys = ["hash_key", "field"]
    # Repeats collapse before the lists are built, so a hot key only brings its distinct values.
    firsts = (
        incoming.where("value is not null").groupBy(*keys, "value").agg(F.min("seq").alias("seq"))
    )
    lists = firsts.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "value"))), lambda x: x["value"]).alias("new")
    )
    if existing is None:
        return lists.select(*keys, F.array_join("new", sep).alias("value"))
    merged = existing.select(*keys, F.col("value").alias("old")).join(lists, keys, "full_outer")
    known = F.split("old", literal_regex(sep))
    added = F.coalesce(F.array_except("new", known), F.array().cast("array<string>"))
    value = F.when(F.col("old").isNull(), F.array_join("new", sep)).otherwise(
        F.array_join(F.concat(F.array("old"), added), sep)
    )
    return merged.select(*keys, value.alias("value"))




def load_audit(
    rows: DataFrame, flag: str, known_flags: list[str], batch_limit: int, elapsed_ms: int | None = None
) -> DataFrame:
    """One row: totals, batches, unknown flags, percent complete and rates of a load."""
    known = F.count_if(F.col(flag).isin(*known_flags))
    counts = rows.agg(F.count(F.lit(1)).alias("num_total"), known.alias("num_processed"))
    total, done = F.col("num_total"), F.col("num_processed")
    audit = counts.select(
        "num_total",
        total.alias("num_scanned"),
        "num_processed",
        (total - done).alias("num_unknown"),
        F.ceil(done / batch_limit).cast("long").alias("num_batches"),
        F.round(F.try_divide(done * 100.0, total), 4).alias("percent_processed"),
    )
    if elapsed_ms is not None:
        audit = audit.withColumns(
            {
                "elapsed_ms": F.lit(elapsed_ms).cast("long"),
                "rows_per_second": F.round(F.try_divide(done * 1000.0, F.lit(elapsed_ms)), 4),
            }
        )
    return audit


def observed_load(rows: DataFrame, flag: str, known_flags: list[str]) -> tuple[DataFrame, Observation]:
    """The same counts taken while the rows are written anyway."""
    audit = Observation()
    watched = rows.observe(
        audit,
        F.count(F.lit(1)).alias("num_scanned"),
        F.count_if(F.col(flag).isin(*known_flags)).alias("num_processed"),
        F.count_if(~F.coalesce(F.col(flag).isin(*known_flags), F.lit(False))).alias("num_unknown"),
    )
    return watched, audit


def throughput(rows: DataFrame, interval_ms: int, ts: str = "ts_ms") -> DataFrame:
    """Records and rate per interval."""
    start = F.col(ts) - F.pmod(F.col(ts), F.lit(interval_ms))
    return (
        rows.groupBy(start.alias("interval_start_ms"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("per_second", F.round(F.col("n") * 1000.0 / interval_ms, 6))
    )


def batch_counts(rows: DataFrame, batch: str) -> DataFrame:
    return rows.groupBy(batch).agg(F.count(F.lit(1)).alias("n"))


def running_count_by_key(rows: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """First value and number of occurrences per key."""
    return rows.groupBy(key).agg(F.min_by(value, seq).alias("first_value"), F.count(F.lit(1)).alias("n"))


def accumulate_to_table(
    rows: DataFrame,
    key: str,
    seq: str,
    measures: list[str],
    table: DataFrame | None = None,
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
) -> DataFrame:
    """Pass rows on with the stored counters after adding their measures (``total_<measure>``).

    ``table`` holds the counters so far: the key and one column per measure.
    """
    sums = [f"__m_{m}" for m in measures]
    full = rows.withColumns({**{c: F.col(m) for c, m in zip(sums, measures)}, CARRY: F.lit(0)})
    if table is not None:
        # The stored counters are a first row of their key: no seq, so slice 0.
        stored = [F.col(m).alias(c) for c, m in zip(sums, measures)]
        full = full.unionByName(table.select(key, *stored, F.lit(-1).alias(CARRY)), allowMissingColumns=True)
    cuts = find_cuts(rows, key, F.col(seq), skew)
    full = with_slices(full, key, F.col(seq), cuts)
    if cuts:
        full = full.unionByName(_carry_sums(full, key, sums), allowMissingColumns=True)
    w = Window.partitionBy(key, SLICE).orderBy(CARRY, seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {f"total_{m}": F.sum(c).over(w) for m, c in zip(measures, sums)}
    return full.withColumns(totals).where(F.col(CARRY) == 0).drop(SLICE, HOT, CARRY, *sums)


def _carry_sums(sliced: DataFrame, key: str, sums: list[str]) -> DataFrame:
    """Per slice of a hot key the sums of the slices before it."""
    parts = sliced.where(HOT).groupBy(key, SLICE).agg(*[F.sum(c).alias(c) for c in sums])
    along = Window.partitionBy(key).orderBy(SLICE)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        parts.withColumns({c: F.sum(c).over(upto) for c in sums})
        .withColumn("__into", F.lead(SLICE).over(along))
        .where("__into is not null")
        .select(key, F.col("__into").alias(SLICE), F.lit(-1).alias(CARRY), *sums)
    )


def stored_totals(rows: DataFrame, key: str, measures: list[str], table: DataFrame | None = None) -> DataFrame:
    """The counters table after all rows."""
    parts = rows.select(key, *measures)
    if table is not None:
        parts = parts.unionByName(table.select(key, *measures))
    return parts.groupBy(key).agg(*[F.sum(m).alias(m) for m in measures])


def pivot_properties(
    rows: DataFrame, entity: list[str], name: str = "name", value: str = "pvalue", into: str = "properties"
) -> DataFrame:
    """Entity-attribute-value rows to one map per entity; entities without properties get an empty map."""
    entry = F.when(F.col(name).isNotNull(), F.struct(F.col(name), F.col(value)))
    # One value per (entity, name) first: a repeated property keeps its last value in name order.
    single = rows.groupBy(*entity, name).agg(F.max(value).alias(value))
    return single.groupBy(*entity).agg(F.map_from_entries(F.collect_list(entry)).alias(into))

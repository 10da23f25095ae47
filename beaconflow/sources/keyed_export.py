"""Reading a keyed table ``(hash_key, field, value)`` back out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconflow.functions.text import wildcard_regex


def matching_rows(
    table: DataFrame, prefix: str | None = None, mid: str | None = None, suffix: str | None = None
) -> DataFrame:
    """Rows whose key matches ``prefix*mid*suffix``."""
    # The plain prefix test is what a Parquet scan can use to skip row groups.
    rows = table.where(F.col("hash_key").startswith(prefix)) if prefix else table
    return rows.where(F.col("hash_key").rlike(wildcard_regex(prefix, mid, suffix)))


def matching_keys(table: DataFrame, **pattern: str) -> DataFrame:
    return matching_rows(table, **pattern).select("hash_key").distinct()


def export_lookup(table: DataFrame, fields: list[str] | None = None, **pattern: str) -> DataFrame:
    """One row per matching key, one column per field in name order.

    Without ``fields`` the distinct field names are read first, as any pivot
    does; a table of very many fields, such as one record for a whole table,
    has no use as columns: see :func:`export_records`.
    """
    wide = matching_rows(table, **pattern).groupBy("hash_key")
    pivot = wide.pivot("field", sorted(fields)) if fields else wide.pivot("field")
    return pivot.agg(F.first("value", ignorenulls=True))


def export_records(table: DataFrame, **pattern: str) -> DataFrame:
    """The fields and values of all matching keys as rows in the order of key and field, however many there are."""
    return matching_rows(table, **pattern).select("hash_key", "field", "value").orderBy("hash_key", "field")


def record_fields(table: DataFrame, hash_key: str) -> DataFrame:
    """All fields of one record in name order."""
    return table.where(F.col("hash_key") == hash_key).select("field", "value").orderBy("field")

"""Maintaining keyed lookup tables ``(hash_key, field, value)``.

A record of the store is the set of rows with one ``hash_key``. Every change is
a pure function from the table before to the table after; "last write wins" is
decided by an explicit ``seq`` column.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconflow.functions.cells import hex_code
from beaconflow.functions.text import strict_int
from beaconflow.operators.aggregates import merge_distinct
from beaconflow.operators.skew import fits_broadcast

KEY = ["hash_key", "field"]


@dataclass(frozen=True)
class MappedValue:
    """A value column written as ``target`` when it holds one of ``where``, else left out."""

    column: str
    where: tuple[str, ...] = ("1", "true")
    target: str = "1"

    def expression(self) -> Column:
        return F.when(F.col(self.column).cast("string").isin(*self.where), F.lit(self.target))


ValueColumn = str | MappedValue


def key_of(columns: list[str], sep: str = ":", prefix: str = "", hex_columns: Iterable[str] = ()) -> Column:
    """The key of a row: prefix plus the trimmed key columns, chosen ones converted to hex."""
    hexed = set(hex_columns)
    parts = [
        hex_code(strict_int(F.trim(F.col(c).cast("string")))) if c in hexed else F.trim(F.col(c).cast("string"))
        for c in columns
    ]
    whole = F.concat_ws(sep, *parts)
    complete = F.coalesce(*[F.when(p.isNull(), False) for p in parts], F.lit(True))
    return F.when(complete, F.concat(F.lit(prefix), whole))


def _value(columns: ValueColumn | list[ValueColumn], sep: str) -> Column:
    """One or more value columns as one text, missing ones skipped."""
    if not isinstance(columns, list):
        columns = [columns]
    parts = [
        c.expression() if isinstance(c, MappedValue) else F.trim(F.col(c).cast("string")) for c in columns
    ]
    return F.concat_ws(sep, *parts) if len(parts) > 1 else parts[0]


def multihash_rows(
    rows: DataFrame,
    key: Column,
    fields: dict[str, ValueColumn | list[ValueColumn]],
    seq: str = "seq",
    value_sep: str = ",",
    skip_empty: bool = False,
) -> DataFrame:
    """Wide rows to (hash_key, field, value, seq); rows without a key are skipped."""
    pairs = [F.struct(F.lit(f).alias("field"), _value(v, value_sep).alias("value")) for f, v in fields.items()]
    long = rows.select(key.alias("hash_key"), F.col(seq).alias("seq"), F.inline(F.array(*pairs)))
    keep = F.col("hash_key").isNotNull() & F.col("value").isNotNull()
    return long.where(keep & (F.col("value") != "") if skip_empty else keep).select(*KEY, "value", "seq")


def merge_rows(
    existing: DataFrame | None,
    incoming: DataFrame,
    overwrite: bool = True,
    append_sep: str = ",",
    small: bool | None = None,
) -> DataFrame:
    """The table after writing (hash_key, field, value, seq) rows.

    Rows of the table whose key is written are replaced or appended to, each on
    its own; all others stay as they are, also repeated ones and those with a
    null key. When the written keys are few (measured unless ``small`` says so)
    the table is only filtered against them and not shuffled; otherwise old and
    new rows meet by shuffle. The result is the same.
    """
    incoming = incoming.select(*KEY, "value", F.col("seq").cast("long").alias("seq"))
    if existing is None:
        return _latest(incoming) if overwrite else merge_distinct(incoming, None, append_sep)
    keys = incoming.select(*KEY).distinct()
    if small is None:
        small = fits_broadcast(keys)
    if small:
        untouched = existing.join(F.broadcast(keys), KEY, "left_anti").select(*KEY, "value")
        if overwrite:
            return untouched.unionByName(_latest(incoming))
        touched = existing.join(F.broadcast(keys), KEY, "left_semi")
        return untouched.unionByName(merge_distinct(incoming, touched, append_sep))
    if not overwrite:
        return merge_distinct(incoming, existing, append_sep)
    return existing.join(keys, KEY, "left_anti").select(*KEY, "value").unionByName(_latest(incoming))


def _latest(rows: DataFrame) -> DataFrame:
    """The value with the greatest ``seq`` per key; rows without one, the old values, come last."""
    at = F.struct(F.col("seq").isNotNull().alias("new"), F.col("seq"))
    return rows.groupBy(*KEY).agg(F.max_by("value", at).alias("value"))


def _without(existing: DataFrame, targets: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not among ``targets``; the table is shuffled only if those are many."""
    targets = targets.select(*on).distinct()
    if fits_broadcast(targets):
        targets = F.broadcast(targets)
    return existing.join(targets, on, "left_anti").select(*KEY, "value")


def upsert_multihash(
    existing: DataFrame | None,
    rows: DataFrame,
    key_columns: list[str],
    fields: dict[str, ValueColumn | list[ValueColumn]],
    prefix: str = "",
    key_sep: str = ":",
    overwrite: bool = True,
    append_sep: str = ",",
    seq: str = "seq",
) -> DataFrame:
    """One record per key; each value column is a named field."""
    long = multihash_rows(rows, key_of(key_columns, key_sep, prefix), fields, seq)
    return merge_rows(existing, long, overwrite, append_sep)


def upsert_onehash(
    existing: DataFrame | None,
    rows: DataFrame,
    table_name: str,
    key_columns: list[str],
    values: ValueColumn | list[ValueColumn],
    key_sep: str = ":",
    value_sep: str = ",",
    overwrite: bool = True,
    append_sep: str = ",",
    seq: str = "seq",
    hex_columns: Iterable[str] = (),
    skip_empty: bool = False,
) -> DataFrame:
    """One record for the whole table: field = key columns, value = value columns."""
    long = rows.select(
        F.lit(table_name).alias("hash_key"),
        key_of(key_columns, key_sep, "", hex_columns).alias("field"),
        _value(values, value_sep).alias("value"),
        F.col(seq).alias("seq"),
    ).where("field is not null and value is not null")
    if skip_empty:
        long = long.where("value <> ''")
    return merge_rows(existing, long, overwrite, append_sep)


def upsert_area_map(
    existing: DataFrame | None,
    rows: DataFrame,
    key_columns: list[str],
    fields: dict[str, ValueColumn | list[ValueColumn]],
    prefix: str = "",
    key_sep: str = ":",
    hex_columns: Iterable[str] = (),
    value_sep: str = ",",
    overwrite: bool = True,
    append_sep: str = ",",
    seq: str = "seq",
) -> DataFrame:
    """Like :func:`upsert_multihash` with hex keys, mapped values and several columns per field.

    Values that come out empty are not written. For the one-record form use
    :func:`upsert_onehash` with ``hex_columns`` and ``skip_empty=True``.
    """
    key = key_of(key_columns, key_sep, prefix, hex_columns)
    long = multihash_rows(rows, key, fields, seq, value_sep, skip_empty=True)
    return merge_rows(existing, long, overwrite, append_sep)


def delete_keys(existing: DataFrame, keys: DataFrame, column: str = "hash_key") -> DataFrame:
    """Remove whole records; ``keys`` may name a record more than once."""
    return _without(existing, keys.select(F.col(column).alias("hash_key")), ["hash_key"])


def delete_fields(existing: DataFrame, targets: DataFrame) -> DataFrame:
    """Remove (hash_key, field) pairs; a record without fields is gone."""
    return _without(existing, targets, KEY)


@dataclass(frozen=True)
class ChangeFlags:
    """Flag texts of a change feed; ``None`` switches that kind of change off."""

    insert: str | None = "1"
    update: str | None = "0"
    delete: str | None = "-1"

    def upserts(self) -> list[str]:
        return [f for f in (self.insert, self.update) if f is not None]


def unknown_changes(feed: DataFrame, flag: str, flags: ChangeFlags) -> DataFrame:
    """One row: how many rows carry an unknown or switched-off flag."""
    known = [f for f in (*flags.upserts(), flags.delete) if f is not None]
    is_known = F.coalesce(F.col(flag).cast("string").isin(*known), F.lit(False))
    return feed.agg(F.count_if(~is_known).alias("num_unknown"))


def apply_changes(
    existing: DataFrame,
    feed: DataFrame,
    key: Column,
    fields: dict[str, ValueColumn | list[ValueColumn]],
    flag: str,
    flags: ChangeFlags = ChangeFlags(),
    increment: bool = True,
    delete_mode: str = "key",
    onehash: str | None = None,
    seq: str = "seq",
    value_sep: str = ",",
    overwrite: bool = True,
    append_sep: str = ",",
    skip_empty: bool = False,
) -> DataFrame:
    """The table after a change feed: all deletes first, then inserts and updates by ``seq``.

    ``key`` serves deletes and upserts alike. ``delete_mode="fields"`` removes
    only the named fields. With ``onehash`` the key is the field of that one
    record. ``increment=False`` ignores the flags and loads every row.
    """
    if delete_mode not in ("key", "fields"):
        raise ValueError(f"unknown delete mode {delete_mode!r}")
    upserts = feed
    table = existing
    if increment:
        kind = F.col(flag).cast("string")
        upserts = feed.where(kind.isin(*flags.upserts())) if flags.upserts() else feed.limit(0)
        if flags.delete is not None:
            gone = feed.where(kind == flags.delete).select(key.alias("k")).where("k is not null").distinct()
            if onehash is not None:
                table = delete_fields(existing, gone.select(F.lit(onehash).alias("hash_key"), F.col("k").alias("field")))
            elif delete_mode == "key":
                table = delete_keys(existing, gone, "k")
            else:
                names = F.array(*[F.lit(f) for f in fields])
                table = delete_fields(existing, gone.select(F.col("k").alias("hash_key"), F.explode(names).alias("field")))
    if onehash is None:
        long = multihash_rows(upserts, key, fields, seq, value_sep, skip_empty)
    else:
        (values,) = fields.values()
        long = upserts.select(
            F.lit(onehash).alias("hash_key"),
            key.alias("field"),
            _value(values, value_sep).alias("value"),
            F.col(seq).alias("seq"),
        ).where("field is not null and value is not null" + (" and value <> ''" if skip_empty else ""))
    return merge_rows(table, long, overwrite, append_sep)

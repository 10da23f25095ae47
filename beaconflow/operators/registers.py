"""Ordered keyed tables: last-writer-wins registers with tombstones.

A state is a table ``(hash_key, field, value, seq, gone)``. It keeps the ``seq``
of every value and of every delete, so that merging states is associative,
commutative and idempotent: change feeds may be applied in any order, in any
cut, and twice. ``gone`` rows are tombstones; one with a null ``field`` deletes
the whole record. What a reader sees is :func:`current`.

At equal ``seq`` a write wins over a delete, and of two writes the greater
value. A null ``seq`` is older than any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconflow.operators.keyed_table import KEY, ChangeFlags, ValueColumn, multihash_rows
from beaconflow.operators.skew import fits_broadcast

STATE = "hash_key string, field string, value string, seq long, gone boolean"
_COLUMNS = [*KEY, "value", "seq", "gone"]


def _state(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("hash_key").cast("string"),
        F.col("field").cast("string"),
        F.col("value").cast("string"),
        F.coalesce(F.col("seq").cast("long"), F.lit(-(1 << 63))).alias("seq"),
        "gone",
    )


def written(rows: DataFrame) -> DataFrame:
    """The state that writing (hash_key, field, value, seq) rows leaves, not merged yet; rows without a key or value are left out."""
    known = rows.where("hash_key is not null and field is not null and value is not null")
    return _state(known.withColumn("gone", F.lit(False)))


def deleted(targets: DataFrame) -> DataFrame:
    """The state that deleting (hash_key, field, seq) leaves; a null ``field`` deletes the record, a null ``hash_key`` nothing."""
    rows = targets.where("hash_key is not null")
    return _state(rows.withColumn("value", F.lit(None)).withColumn("gone", F.lit(True)))


def merge_registers(*states: DataFrame) -> DataFrame:
    """One state of several: of each (hash_key, field) the row of greatest ``seq``.

    Partial aggregation leaves at most one row a key and task before the
    shuffle, and the key holds the field, so neither a record with a third of
    all fields nor a key with a third of all writes gathers in a task.
    """
    every = reduce(DataFrame.unionByName, [s.select(*_COLUMNS) for s in states])
    order = F.struct(F.col("seq"), (~F.col("gone")).alias("kept"), F.col("value"))
    last = every.groupBy(*KEY).agg(F.max(order).alias("last"))
    return last.select(*KEY, "last.value", "last.seq", (~F.col("last.kept")).alias("gone"))


def _over(state: DataFrame) -> DataFrame:
    """The state's values and field tombstones with ``over``: the seq of their record's tombstone, or null."""
    records = state.where("gone and field is null").groupBy("hash_key").agg(F.max("seq").alias("over"))
    if fits_broadcast(records):
        records = F.broadcast(records)
    return state.where("field is not null").join(records, "hash_key", "left")


def current(state: DataFrame) -> DataFrame:
    """The table (hash_key, field, value) of a merged state: values that no tombstone is newer than."""
    return _over(state).where("not gone and (over is null or seq >= over)").select(*KEY, "value")


def compacted(state: DataFrame, before: int | None = None) -> DataFrame:
    """The same state without what can no longer be seen: fields older than their record's tombstone.

    With ``before``, tombstones of a smaller ``seq`` go as well: right once no
    change of a smaller ``seq`` can come any more.
    """
    fields = _over(state).where("over is null or seq > over or (seq = over and not gone)").select(*_COLUMNS)
    both = fields.unionByName(state.where("field is null").select(*_COLUMNS))
    return both if before is None else both.where(~F.col("gone") | (F.col("seq") >= before))


def change_state(
    feed: DataFrame,
    key: Column,
    fields: dict[str, ValueColumn | list[ValueColumn]],
    flag: str,
    flags: ChangeFlags = ChangeFlags(),
    delete_mode: str = "key",
    onehash: str | None = None,
    seq: str = "seq",
    value_sep: str = ",",
    skip_empty: bool = False,
) -> DataFrame:
    """A change feed as a state, to be merged with others.

    Unlike :func:`beaconflow.operators.keyed_table.apply_changes`, which deletes
    first whatever the order, every change counts at its own ``seq``: a delete
    removes what was written before it. The other arguments mean the same.
    Unknown flags, null keys and null values change nothing.
    """
    if delete_mode not in ("key", "fields"):
        raise ValueError(f"unknown delete mode {delete_mode!r}")
    kind = F.col(flag).cast("string")
    upserts = feed.where(kind.isin(*flags.upserts())) if flags.upserts() else feed.where(F.lit(False))
    long = multihash_rows(upserts, key, fields, seq, value_sep, skip_empty)
    if onehash is not None:
        long = long.select(F.lit(onehash).alias("hash_key"), F.col("hash_key").alias("field"), "value", "seq")
    out = written(long)
    if flags.delete is None:
        return out
    gone = feed.where(kind == flags.delete).select(key.alias("k"), F.col(seq).alias("seq")).where("k is not null")
    if onehash is not None:
        gone = gone.select(F.lit(onehash).alias("hash_key"), F.col("k").alias("field"), "seq")
    elif delete_mode == "key":
        gone = gone.select(F.col("k").alias("hash_key"), F.lit(None).cast("string").alias("field"), "seq")
    else:
        names = F.array(*[F.lit(f) for f in fields])
        gone = gone.select(F.col("k").alias("hash_key"), F.explode(names).alias("field"), "seq")
    return out.unionByName(deleted(gone))

"""Keeping one hot key from becoming one hot task.

Per-user operators need a user's rows in time order, so a user holding a third
of all rows cannot be hashed away. The hot users are found with a mergeable
frequent-items sketch (one narrow pass, no shuffle of the rows), their time line
is cut at its quantiles, and every (user, slice) is processed on its own. What
an operator must know from the earlier slices enters as one *carry row* per
slice. The result does not depend on which keys are found hot or where they are
cut, so the sketches only affect speed.

The detection runs when an operator is called, because its outcome decides the
plan: without hot keys, the usual case, nothing is added to it. An operator far
down a plan should be given the :class:`HotKeys` of the raw records, so that the
detection does not compute everything in between.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "__slice"
HOT = "__hot"
CARRY = "__carry"

#: Wide rows that a task sorts at once.
PART_ROWS = 50_000

_QUANTILES = 1000
_BLOCK = 32


@dataclass(frozen=True)
class Skew:
    """A key is hot above ``max(total / share, min_rows)`` rows; so at most ``share`` keys are.

    A hot key is cut into pieces of about ``max(total / (10 * share), min_rows)`` rows.
    """

    share: int = 1000
    min_rows: int = 1_000_000


DEFAULT_SKEW = Skew()


@dataclass(frozen=True)
class Cuts:
    """Where the hot keys are cut: key -> ascending order values.

    At most ``11 * share`` values over all keys whatever the size of the data,
    which is why they may be held by the driver and broadcast.
    """

    points: dict[object, list[int]]

    def __bool__(self) -> bool:
        return bool(self.points)

    def frame(self, spark: SparkSession, like: DataFrame, key: str) -> DataFrame:
        return _local(spark, like, key, "cuts", T.ArrayType(T.LongType()), self.points)


NO_CUTS = Cuts({})


def _local(spark: SparkSession, like: DataFrame, key: str, name: str, kind: T.DataType, values: dict) -> DataFrame:
    schema = T.StructType([T.StructField(key, like.schema[key].dataType), T.StructField(name, kind)])
    return spark.createDataFrame(list(values.items()), schema)


class HotKeys:
    """The hot keys of a frame, found once; ``skew`` arguments accept this in place of a :class:`Skew`."""

    def __init__(self, df: DataFrame, key: str, skew: Skew = DEFAULT_SKEW) -> None:
        self._df, self._key, self._skew = df, key, skew

    @cached_property
    def _counted(self) -> tuple[int, list]:
        """The number of rows, and the keys that may be hot with theirs: one narrow pass."""
        skew = self._skew
        row = self._df.agg(
            F.expr(f"approx_top_k(`{self._key}`, {skew.share}, {10 * skew.share})").alias("top"),
            F.count(F.lit(1)).alias("total"),
        ).first()
        return row["total"], row["top"] or []

    @cached_property
    def total(self) -> int:
        return self._counted[0]

    @cached_property
    def pieces(self) -> dict[object, int]:
        """Hot key -> number of pieces: at most ``skew.share`` entries."""
        skew, (total, top) = self._skew, self._counted
        threshold, piece = max(total / skew.share, skew.min_rows), max(total / (10 * skew.share), skew.min_rows)
        hot = [e for e in top if e["item"] is not None and e["count"] > threshold]
        return {e["item"]: min(_QUANTILES, math.ceil(e["count"] / piece)) for e in hot}

    def cuts(self, order: Column) -> Cuts:
        """The hot keys cut at quantiles of ``order``."""
        hot = {k: n for k, n in self.pieces.items() if n > 1}
        if not hot:
            return NO_CUTS
        key = self._key
        rows = self._df.select(F.col(key), order.cast("long").alias("__order"))
        pieces = F.broadcast(_local(self._df.sparkSession, rows, key, "pieces", T.IntegerType(), hot))
        grid = ",".join(f"{i / _QUANTILES}D" for i in range(1, _QUANTILES))
        found = (
            rows.join(pieces, key)
            .groupBy(key, "pieces")
            .agg(F.expr(f"percentile_approx(__order, array({grid}), {10 * _QUANTILES})").alias("q"))
            .select(
                key,
                F.expr(
                    f"array_distinct(transform(sequence(1, pieces - 1), "
                    f"i -> q[cast(i * {_QUANTILES} / pieces as int) - 1]))"
                ).alias("cuts"),
            )
        )
        return Cuts({r[0]: r[1] for r in found.collect()})


def detect_together(df: DataFrame, keys: list[str], skew: Skew = DEFAULT_SKEW) -> dict[str, HotKeys]:
    """The hot keys of several columns of ``df``, found in one pass over these columns."""
    slim = df.select(*keys)
    tops = [F.expr(f"approx_top_k(`{k}`, {skew.share}, {10 * skew.share})").alias(f"top{i}") for i, k in enumerate(keys)]
    row = slim.agg(F.count(F.lit(1)).alias("total"), *tops).first()
    threshold, piece = max(row["total"] / skew.share, skew.min_rows), max(row["total"] / (10 * skew.share), skew.min_rows)
    found = {}
    for i, key in enumerate(keys):
        hot = [e for e in row[f"top{i}"] or [] if e["item"] is not None and e["count"] > threshold]
        found[key] = HotKeys(df, key, skew)
        found[key].__dict__["pieces"] = {e["item"]: min(_QUANTILES, math.ceil(e["count"] / piece)) for e in hot}
    return found


def in_parts(df: DataFrame, key: str, skew: HotKeys) -> DataFrame:
    """Deal ``df`` by ``key`` in parts of about ``PART_ROWS`` rows, for windows by ``key`` over wide rows.

    Spark joins shuffled partitions by their compressed bytes, from which wide
    rows with repeated texts swell twentyfold, so that their sorts spill. A
    number of parts from the rows counted anyway holds a task's memory where it
    is at any size. Few rows, and those of hot keys, which are cut, stay as they are.
    """
    parts = -(-skew.total // PART_ROWS)
    if parts < 2 or any(n > 1 for n in skew.pieces.values()):
        return df
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), key)


def find_cuts(df: DataFrame, key: str, order: Column, skew: Skew | HotKeys | None = DEFAULT_SKEW) -> Cuts:
    """Cuts of the hot keys of ``df``, or of those already known; ``None`` leaves every key whole."""
    if skew is None or df.isStreaming:
        return NO_CUTS
    return (skew if isinstance(skew, HotKeys) else HotKeys(df, key, skew)).cuts(order)


def with_slices(df: DataFrame, key: str, order: Column, cuts: Cuts) -> DataFrame:
    """Add the slice number (0 for ordinary keys) and the hot flag."""
    if not cuts:
        return df.withColumns({SLICE: F.lit(0), HOT: F.lit(False)})
    # Two short scans (block ends, then one block) instead of one over all cuts.
    # A row without an order value belongs before all others, into slice 0.
    ends = F.filter(F.col("cuts"), lambda _, i: i % _BLOCK == _BLOCK - 1)
    side = cuts.frame(df.sparkSession, df, key).select(key, F.col("cuts").alias("__cuts"), ends.alias("__ends"))
    full = F.size(F.filter("__ends", lambda c: c <= order))
    rest = F.size(F.filter(F.slice("__cuts", full * _BLOCK + 1, F.lit(_BLOCK)), lambda c: c <= order))
    hot = F.col("__cuts").isNotNull()
    return (
        df.join(F.broadcast(side), key, "left")
        .withColumns({SLICE: F.when(hot, full * _BLOCK + rest).otherwise(0), HOT: hot})
        .drop("__cuts", "__ends")
    )


def carry_last_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """For each slice of a hot key a copy of the row just before it, marked as carry row."""
    last = (
        df.where(HOT)
        .groupBy(key, SLICE)
        .agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("row"))
        .withColumn("__into", F.lead(SLICE).over(Window.partitionBy(key).orderBy(SLICE)))
        .where("__into is not null")
    )
    return last.select(
        *[(F.col("__into") if c == SLICE else F.col(f"row.{c}")).alias(c) for c in df.columns],
        F.lit(True).alias(CARRY),
    )


def fits_broadcast(df: DataFrame, max_rows: int = 500_000, max_bytes: int = 128 << 20) -> bool:
    """Measure a lookup side: whole if small, never more than ``max_rows`` rows of it otherwise."""
    size = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        text = F.col(f"`{name}`").cast("string") if kind != "binary" else F.col(f"`{name}`")
        size = size + F.coalesce(F.octet_length(text), F.lit(0)) + 8
    row = df.select(size.alias("b")).limit(max_rows + 1).agg(F.count("b").alias("n"), F.sum("b").alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "left",
    *,
    small: bool | None = None,
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
    fanout: int = 64,
) -> DataFrame:
    """Equi lookup join (``left``, ``inner``, ``left_semi`` or ``left_anti``) that survives hot keys.

    A right side measured to be small is broadcast. A larger one is joined by
    shuffle on (key, salt): rows of a hot left key are spread over ``fanout``
    salts and the matching right rows copied to each; null keys, which match
    nothing, are spread as well. A streaming left side, whose micro-batches are
    bounded, is joined unsalted.
    """
    if small is None:
        small = fits_broadcast(right)
    if small:
        return left.join(F.broadcast(right), on, how)
    if left.isStreaming or skew is None:
        return left.join(right, on, how)
    hashable = [c for c, kind in left.dtypes if "map<" not in kind and kind != "variant"]
    spread = F.pmod(F.xxhash64(*hashable), F.lit(fanout)).cast("int")
    found = (skew if isinstance(skew, HotKeys) else HotKeys(left, on, skew)).pieces
    if not found:
        salted = left.withColumn("__salt", F.when(F.col(on).isNull(), spread).otherwise(0))
        return salted.join(right.withColumn("__salt", F.lit(0)), [on, "__salt"], how).drop("__salt")
    hot = F.broadcast(
        _local(left.sparkSession, left, on, "__h", T.BooleanType(), dict.fromkeys(found, True))
    )
    salted_left = left.join(hot, on, "left").withColumn(
        "__salt", F.when(F.col("__h") | F.col(on).isNull(), spread).otherwise(0)
    )
    salts = F.when(F.col("__h"), F.sequence(F.lit(0), F.lit(fanout - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.join(hot, on, "left").withColumn("__salt", F.explode(salts)).drop("__h")
    return salted_left.join(salted_right, [on, "__salt"], how).drop("__salt", "__h")

"""Stays of records in the order of arrival, late ones included, as a batch.

The stream takes a user's records one after the other. What each finds can be
said without walking: a chain of running maxima and minima, each of which is
associative, so they are windows here, and a hot user's records are cut into
slices that get what came before as one row per slice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconflow.operators.skew import DEFAULT_SKEW, HOT, SLICE, Cuts, HotKeys, Skew, find_cuts, with_slices
from beaconflow.operators.stay import StayConfig, crossing_label
from beaconflow.session import shared_table


def _running(rows: DataFrame, name: str, keys: list[str], value: Column, least: bool, own: bool, cuts: Cuts) -> DataFrame:
    """Add the least or greatest ``value`` of the records up to this one (``own``) or before it, within ``keys``.

    Rows of one ``__seq`` are one record. Slices of hot keys take in what the
    slices before them came to.
    """
    pick: Callable = F.min if least else F.max
    along = Window.partitionBy(*keys, SLICE).orderBy("__seq").rangeBetween(Window.unboundedPreceding, 0 if own else -1)
    out = rows.withColumn(name, pick(value).over(along))
    if not cuts:
        return out
    parts = rows.where(HOT).groupBy(*keys, SLICE).agg(pick(value).alias("__part"))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(*keys, SLICE, pick("__part").over(before).alias("__before")).where("__before is not null")
    both = F.least if least else F.greatest
    return shared_table(out.join(carry, [*keys, SLICE], "left").withColumn(name, both(name, "__before")).drop("__before"), "late")


def dwell_by_arrival(
    visits: DataFrame,
    config: StayConfig,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
) -> DataFrame:
    """Add the label ``stay`` to rows (user, area, time, seq) whose records come in the order of ``seq``.

    The rules of the stream (``beaconflow.streaming.labels.stay_step``): a
    record later than all before it by more than the timeout starts afresh, one
    older by more than that is ignored, one in between may move a stay's
    beginning back. As maxima and minima:

    * the newest time so far tells both of these cases; the last record that
      started afresh names the epoch;
    * within (user, epoch, area), the newest time so far is the end of the
      current stay, and the last record beyond it by more than the timeout
      began that stay;
    * within that stay, the earliest time so far is its beginning.

    Rows with an equal ``seq`` (a number) are one record. A null time is
    labelled 0 and changes nothing. All windows share one shuffle by user.
    """
    time, limit = F.col(ts).cast("long"), config.timeout_ms
    cuts = find_cuts(visits, user, F.col(seq), skew)
    rows = with_slices(visits.withColumn("__seq", F.col(seq).cast("long")), user, F.col("__seq"), cuts)

    rows = _running(rows, "__newest", [user], time, False, False, cuts)
    afresh = F.coalesce(time - F.col("__newest") > limit, F.col("__newest").isNull())
    rows = rows.withColumn("__afresh", afresh & time.isNotNull())
    rows = rows.withColumn("__counts", time.isNotNull() & ~F.coalesce(F.col("__newest") - time > limit, F.lit(False)))
    rows = _running(rows, "__epoch", [user], F.when(F.col("__afresh"), F.col("__seq")), False, True, cuts)

    counted, stay = F.when(F.col("__counts"), time), [user, "__epoch", "area"]
    rows = _running(rows, "__last", stay, counted, False, False, cuts)
    begins = F.col("__counts") & F.coalesce(time - F.col("__last") > limit, F.lit(True))
    rows = rows.withColumn("__begins", begins)
    rows = _running(rows, "__stay", stay, F.when(F.col("__begins"), F.col("__seq")), False, True, cuts)
    rows = _running(rows, "__first", [*stay, "__stay"], counted, True, False, cuts)

    old = F.col("__last") - F.col("__first")
    label = (
        F.when(~F.col("__counts") | F.col("__begins"), F.lit(0).cast("long"))
        .when(time < F.col("__first"), crossing_label(old, F.col("__last") - time, config))
        .when(time > F.col("__last"), crossing_label(old, time - F.col("__first"), config))
        .otherwise(F.lit(0).cast("long"))
    )
    made = ("__seq", "__newest", "__afresh", "__counts", "__epoch", "__last", "__begins", "__stay", "__first")
    return rows.withColumn("stay", label).drop(SLICE, HOT, *made)

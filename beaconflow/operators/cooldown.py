"""Suppressing repeats: a user's event fires, then rests for an interval.

The rest is counted from the last *fired* row, so the choice is greedy and no
fixed window expresses it. Spark hashes and sorts the rows by (user, time); a
small Arrow scan then walks each sorted partition, holding one lock per open
user, and returns the rows that fire.

A hot user is cut differently: by time *modulo the interval*. Within interval
number ``s`` at most one row fires, and its position within the interval (the
offset) never falls from one interval to the next until the chain breaks. Cut
the offsets into columns: a chain that enters a column in some interval does so
at the column's first row there, whatever came before. So

1. each column, on its own, follows the chain from the first row of every
   interval as long as it stays in the column;
2. a walk over these (interval, column) summaries finds the entries that
   really happen. A summary leads to the first one after the point where its
   chain leaves, so blocks of intervals are maps from the state a walk enters
   with to the one it leaves with: the blocks are summed up side by side, one
   short walk goes over the few states that lead out of them, and each block
   then follows its own part;
3. the main scan runs per (user, column) and fires only between an entry and
   the point where that chain leaves.

This is exact, and no task sees more than one column, or one block of
summaries, of a hot user.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconflow.constants import COOLDOWN_MS
from beaconflow.operators.skew import CARRY, DEFAULT_SKEW, HOT, SLICE, Cuts, HotKeys, Skew, find_cuts, with_slices
from beaconflow.session import shared_table

_UNTIL = "__until"
_FREE = "__free"
_NEVER = np.iinfo(np.int64).min
_ALWAYS = np.iinfo(np.int64).max
_SPREAD = 64
#: More than there can be columns, so (interval, column) is one number.
_COLUMNS = 1 << 16


def cooldown(
    rows: DataFrame,
    interval_ms: int = COOLDOWN_MS,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    free: str | None = None,
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
    clustered: bool = False,
) -> DataFrame:
    """The rows that fire. A row exactly ``interval`` after the last fired one fires again.

    Rows flagged in the column ``free``, which must come first in a user's
    time, fire without starting a rest. So do rows without a time or a user, as
    no rest can be counted for them. ``clustered`` says that ``rows`` come
    straight from a window by user, so that they need no further shuffle unless
    a user is cut.
    """
    if interval_ms <= 0:
        return rows
    offset = F.pmod(F.col(ts), F.lit(interval_ms))
    cuts = find_cuts(rows, user, offset, skew)
    sliced = with_slices(rows, user, offset, cuts)
    unplaced = F.col(user).isNull() | F.col(ts).isNull()
    full = sliced.withColumns(
        {
            CARRY: F.lit(False),
            _UNTIL: F.lit(None).cast("long"),
            _FREE: unplaced | F.coalesce(F.col(free), F.lit(False)) if free else unplaced,
        }
    )
    # Rows without a user belong to nobody: any task may have them.
    anywhere = F.pmod(F.xxhash64(ts, seq), F.lit(_SPREAD)).cast("int")
    full = full.withColumn(SLICE, F.when(F.col(user).isNull(), anywhere).otherwise(F.col(SLICE)))
    if cuts:
        hot = full.where(HOT).where(~F.col(_FREE)).select(user, SLICE, F.col(ts).cast("long").alias("entry"))
        full = full.unionByName(
            _entries(hot, interval_ms, user, skew).select(
                user,
                SLICE,
                F.lit(True).alias(HOT),
                F.col("entry").cast(rows.schema[ts].dataType).alias(ts),
                F.lit(True).alias(CARRY),
                F.col("last").alias(_UNTIL),
                F.lit(False).alias(_FREE),
            ),
            allowMissingColumns=True,
        )
    if cuts or not clustered:
        full = full.repartition(F.col(user), F.col(SLICE))
    placed = full.sortWithinPartitions(
        user, SLICE, F.col(_FREE).desc(), ts, F.col(CARRY).desc(), seq
    )
    return placed.mapInArrow(_firing_scan(rows.columns, user, ts, interval_ms), rows.schema)


def _changed(column: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """Where a sorted column differs from the row above; ``before`` is the row above the batch."""
    out = np.ones(len(column), dtype=bool)
    if before is not None:
        out[0] = column[0] != before
    if len(column) > 1:
        differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
        out[1:] = pc.fill_null(differs, True).to_numpy(zero_copy_only=False)
    return out


def _firing_scan(columns: list[str], user: str, ts: str, interval: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: dict[str, pa.Scalar | None] = {user: None, SLICE: None, _FREE: None}
        threshold, until = _NEVER, _ALWAYS  # of the segment left open by the batch before
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            t = pc.fill_null(batch.column(ts).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
            mark = batch.column(CARRY).to_numpy(zero_copy_only=False)
            free = batch.column(_FREE).to_numpy(zero_copy_only=False)
            hot = batch.column(HOT).to_numpy(zero_copy_only=False)
            limit = pc.fill_null(batch.column(_UNTIL), 0).to_numpy(zero_copy_only=False)
            begins = mark.copy()
            for name, value in before.items():
                column = batch.column(name)
                begins |= _changed(column, value)
                before[name] = column[n - 1]
            # Segments: the rows of a user (and column), of one entry, or free rows.
            seg = np.cumsum(begins)
            if begins[0]:
                seg -= 1
                starts = np.flatnonzero(begins)
                thresholds = np.full(len(starts), _NEVER)
                untils = np.where(mark, limit, np.where(hot, _NEVER, _ALWAYS))[starts]
            else:
                starts = np.concatenate(([0], np.flatnonzero(begins)))
                thresholds = np.full(len(starts), _NEVER)
                untils = np.where(mark, limit, np.where(hot, _NEVER, _ALWAYS))[starts]
                thresholds[0], untils[0] = threshold, until
            ends = np.append(starts[1:], n)
            fired = free.copy()
            # (segment, rank of the time) ascends over the batch, so the next row
            # of a segment at or after any time is one binary search away.
            times, rank = np.unique(t, return_inverse=True)
            place = seg * (len(times) + 1) + rank
            first = starts + mark[starts]
            open_ = np.flatnonzero(~free[starts])
            while len(open_):
                want = open_ * (len(times) + 1) + np.searchsorted(times, thresholds[open_])
                pos = np.maximum(np.searchsorted(place, want), first[open_])
                ok = pos < ends[open_]
                open_, pos = open_[ok], pos[ok]
                ok = t[pos] <= untils[open_]
                open_, pos = open_[ok], pos[ok]
                fired[pos] = True
                thresholds[open_] = t[pos] + interval
            threshold, until = thresholds[-1], untils[-1]
            if fired.any():
                yield batch.select(columns).filter(pa.array(fired))

    return scan


def _entries(hot: DataFrame, interval: int, user: str, skew: Skew | HotKeys) -> DataFrame:
    """Where chains of hot users enter a column: (user, slice, entry time, last fired time inside)."""
    schema = T.StructType(
        [
            hot.schema[user],
            T.StructField(SLICE, T.IntegerType()),
            T.StructField("entry", T.LongType()),
            T.StructField("last", T.LongType()),
        ]
    )
    cells = (
        hot.repartition(F.col(user), F.col(SLICE))
        .sortWithinPartitions(user, SLICE, "entry")
        .mapInArrow(_chain_scan(user, interval), schema)
    )
    cells = shared_table(cells.withColumn("__slot", F.floor(F.col("entry") / interval)), "cells")
    blocks = HotKeys(cells, user, skew._skew if isinstance(skew, HotKeys) else skew).cuts(F.col("__slot"))
    if blocks:
        return _walk_blocks(cells, interval, user, blocks).select(*schema.names)
    return (
        cells.repartition(F.col(user))
        .sortWithinPartitions(user, "__slot", SLICE)
        .select(*schema.names)
        .mapInArrow(_walk_scan(user, interval), schema)
    )


class _Block:
    """Summaries of a block of intervals in order; a state is the place (interval, column) that a walk has reached."""

    def __init__(self, table: pa.Table, interval: int):
        get = lambda name: table.column(name).to_numpy()
        column, entry, last = get("__column").astype(np.int64), get("entry"), get("last")
        place = (entry // interval) * _COLUMNS + column
        order = np.argsort(place)
        self.column, self.entry, self.last, self.place = column[order], entry[order], last[order], place[order]
        self.leaves = (self.last // interval + 1) * _COLUMNS + self.column
        self.next = np.searchsorted(self.place, self.leaves, side="right")

    def exits(self) -> np.ndarray:
        """The state in which a walk that takes a summary leaves the block."""
        n = len(self.place)
        final = np.where(self.next < n, self.next, np.arange(n))
        while True:
            further = final[final]
            if (further == final).all():
                return self.leaves[final]
            final = further

    def first(self, states: np.ndarray) -> np.ndarray:
        """The summary that a walk takes first; as many as there are, if none."""
        return np.searchsorted(self.place, states, side="right")

    def path(self, state: int) -> list[int]:
        out, i = [], int(self.first(np.array([state]))[0])
        while i < len(self.place):
            out.append(i)
            i = int(self.next[i])
        return out


def _walk_blocks(cells: DataFrame, interval: int, user: str, cuts: Cuts) -> DataFrame:
    """The entries that the real chains make, block by block of intervals."""
    rows = with_slices(cells.withColumnRenamed(SLICE, "__column"), user, F.col("__slot"), cuts).drop(HOT)
    who = rows.schema[user]
    rows = rows.select(user, SLICE, "__column", "entry", "last")

    def schema(*longs: str) -> T.StructType:
        return T.StructType([who, T.StructField(SLICE, T.IntegerType()), *[T.StructField(c, T.LongType()) for c in longs]])

    def made(table: pa.Table, **columns: np.ndarray) -> pa.Table:
        n = len(next(iter(columns.values())))
        key = {c: pa.array([table.column(c)[0].as_py()] * n, table.schema.field(c).type) for c in (user, SLICE)}
        return pa.table({**key, **{c: pa.array(x, pa.int64()) for c, x in columns.items()}})

    def leave(table: pa.Table) -> pa.Table:
        block = _Block(table, interval)
        states = np.unique(block.exits())
        return made(table, state=states, end=np.full(len(states), block.place[-1]))

    def cross(table: pa.Table, states: pa.Table) -> pa.Table:
        block, into = _Block(table, interval), states.column("state").to_numpy()
        return made(table, state=into, out=block.exits()[block.first(into)])

    def walk(table: pa.Table) -> pa.Table:
        leads = {s: (o, b) for s, o, b in zip(*(table.column(c).to_pylist() for c in ("state", "out", SLICE)))}
        state, states, places = _NEVER, [], []
        while state in leads:
            states.append(state)
            state, place = leads[state]
            places.append(place)
        key = pa.array([table.column(user)[0].as_py()] * len(states), table.schema.field(user).type)
        return pa.table({user: key, SLICE: pa.array(places, pa.int32()), "state": pa.array(states, pa.int64())})

    def follow(table: pa.Table, states: pa.Table) -> pa.Table:
        block = _Block(table, interval)
        taken = block.path(states.column("state")[0].as_py()) if states.num_rows else []
        found = made(table, entry=block.entry[taken], last=block.last[taken])
        return found.set_column(1, SLICE, pa.array(block.column[taken], pa.int32()))

    by_block = rows.groupBy(user, SLICE)
    left = shared_table(by_block.applyInArrow(leave, schema("state", "end")), "exits")
    ends = left.groupBy(user, SLICE).agg(F.max("end").alias("end"))
    # Every state that leads out of a block leads into the first block with a summary after it.
    states = left.select(user, "state").distinct()
    into = states.join(F.broadcast(ends), user).where("end > state").groupBy(user, "state").agg(F.min(SLICE).alias(SLICE))
    start = ends.groupBy(user).agg(F.lit(_NEVER).alias("state"), F.min(SLICE).alias(SLICE))
    into = into.unionByName(start).select(user, SLICE, "state")
    # Python sees both sides of a block only where there is something to cross or follow.
    some = into.select(user, SLICE).distinct()
    crossed = rows.join(some, [user, SLICE], "left_semi").groupBy(user, SLICE).cogroup(into.groupBy(user, SLICE)).applyInArrow(
        cross, schema("state", "out")
    )
    path = shared_table(crossed.groupBy(user).applyInArrow(walk, schema("state")), "walk")
    visited = rows.join(path.select(user, SLICE), [user, SLICE], "left_semi")
    return visited.groupBy(user, SLICE).cogroup(path.groupBy(user, SLICE)).applyInArrow(follow, schema("entry", "last"))


def _batch(template: pa.RecordBatch, user: str, users: list, slices: list, entries: list, lasts: list):
    return pa.RecordBatch.from_arrays(
        [
            pa.array(users, template.schema.field(user).type),
            pa.array(slices, pa.int32()),
            pa.array(entries, pa.int64()),
            pa.array(lasts, pa.int64()),
        ],
        names=[user, SLICE, "entry", "last"],
    )


def _chain_scan(user: str, interval: int):
    """Per (user, column): for the first row of every interval, where its chain last fires inside."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: dict[str, pa.Scalar | None] = {user: None, SLICE: None}
        owner, slot = None, None
        # Chains by the time they last fired -> entries that lead there. ``waiting``
        # fired in the interval before this one, ``done`` in this one.
        waiting: dict[int, list[int]] = {}
        done: dict[int, list[int]] = {}
        out: tuple[list, list, list, list] = ([], [], [], [])

        def leave(chains: dict[int, list[int]]) -> None:
            for last, entries in chains.items():
                out[0].extend([owner[0]] * len(entries))
                out[1].extend([owner[1]] * len(entries))
                out[2].extend(entries)
                out[3].extend([last] * len(entries))

        template = None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            template = batch
            t = batch.column("entry").to_numpy(zero_copy_only=False)
            begins = np.zeros(n, dtype=bool)
            for name, value in before.items():
                begins |= _changed(batch.column(name), value)
                before[name] = batch.column(name)[n - 1]
            slots = t // interval
            edges = begins.copy()
            edges[1:] |= slots[1:] != slots[:-1]
            edges[0] = True
            bounds = np.append(np.flatnonzero(edges), n)
            for a, b in zip(bounds[:-1], bounds[1:]):
                times, here = t[a:b], int(slots[a])
                if begins[a] or here != slot:
                    leave(waiting)
                    if begins[a] or here != slot + 1:
                        leave(done)
                        done = {}
                    if begins[a]:
                        owner = (batch.column(user)[a].as_py(), batch.column(SLICE)[a].as_py())
                    waiting, done, slot = done, {int(times[0]): [int(times[0])]}, here
                if waiting:
                    lasts = np.fromiter(waiting, dtype=np.int64, count=len(waiting))
                    found = np.searchsorted(times, lasts + interval)
                    rest = {}
                    for last, i in zip(lasts.tolist(), found.tolist()):
                        if i < len(times):
                            done.setdefault(int(times[i]), []).extend(waiting[last])
                        else:
                            rest[last] = waiting[last]
                    waiting = rest
            if len(out[0]) >= 10_000:
                yield _batch(template, user, *out)
                out = ([], [], [], [])
        leave(waiting)
        leave(done)
        if template is not None and out[0]:
            yield _batch(template, user, *out)

    return scan


def _walk_scan(user: str, interval: int):
    """Per user, over (interval, column) in order: the entries the real chain makes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, reached = None, None
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for who, column, entry, last in zip(*columns):
                if who != owner:
                    owner, reached = who, None
                if reached is None or (entry // interval, column) > reached:
                    reached = (last // interval + 1, column)
                    for values, value in zip(out, (who, column, entry, last)):
                        values.append(value)
            if out[0]:
                yield _batch(batch, user, *out)

    return scan

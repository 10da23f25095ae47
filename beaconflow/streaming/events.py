"""Business-event state in a stream: cooldown and correlation of sources."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from beaconflow.constants import COOLDOWN_MS, CORRELATION_DELAY_MS
from beaconflow.streaming.buckets import BUCKET, ROCKSDB, BucketProcessor, runs_of, stateful_by_bucket

STATE = T.StructType(
    [
        T.StructField("lock", T.LongType()),
        T.StructField("sources", T.ArrayType(T.StringType())),
        T.StructField("seen", T.ArrayType(T.LongType())),
    ]
)


class EventLock:
    """One user's business event: when it last fired and when each source was active."""

    def __init__(self, lock: int | None = None, seen: dict[str, int] | None = None) -> None:
        self.lock, self.seen = lock, seen or {}

    def fires(self, t: int, source: str, sources: list[str], interval: int, delay: int, require_all: bool) -> bool:
        self.seen[source] = max(t, self.seen.get(source, t))
        if self.lock is not None:
            if self.lock + interval > t:
                return False
            self.lock = t
            return True
        newest = max(self.seen.values())
        self.seen = {s: x for s, x in self.seen.items() if x + delay >= newest}
        complete = all(s in self.seen for s in sources)
        if complete:
            self.lock = t
        return complete or not require_all


def fired_alone(lock: EventLock, times: np.ndarray, source: str, interval: int) -> np.ndarray:
    """Which of one source's sorted times fire; each step is a search for the next allowed time, as between two firings nothing changes."""
    fired = np.zeros(len(times), bool)
    if len(times):
        lock.seen[source] = max(int(times[-1]), lock.seen.get(source, int(times[-1])))
    at = 0 if lock.lock is None else int(np.searchsorted(times, lock.lock + interval))
    while at < len(times):
        fired[at] = True
        lock.lock = int(times[at])
        at = max(at + 1, int(np.searchsorted(times, lock.lock + interval)))
    return fired


def fired_rows(lock: EventLock, rows: pd.DataFrame, term: EventTerms, ts: str, source: str | None) -> np.ndarray:
    """Which of a user's rows, sorted by time, fire. Rows without a time fire and start no rest."""
    timed = rows[ts].notna().to_numpy()
    fired = ~timed
    times = rows[ts].to_numpy()[timed].astype(np.int64)
    if len(term.sources) == 1:
        fired[timed] = fired_alone(lock, times, term.sources[0], term.interval_ms)
    else:
        tags, known = rows[source].to_numpy()[timed].tolist(), list(term.sources)
        fired[timed] = [
            lock.fires(t, s, known, term.interval_ms, term.delay_ms, term.require_all) for t, s in zip(times.tolist(), tags, strict=True)
        ]
    return fired


@dataclass(frozen=True)
class EventTerms:
    """When a business event fires: its sources, rest and correlation delay."""

    sources: tuple[str, ...]
    interval_ms: int = COOLDOWN_MS
    delay_ms: int = CORRELATION_DELAY_MS
    require_all: bool = False


def _locked(saved: tuple | None) -> EventLock:
    lock, sources, seen = saved or (None, [], [])
    return EventLock(None if pd.isna(lock) else int(lock), dict(zip(sources, map(int, seen))))


def _saved(lock: EventLock) -> tuple:
    return lock.lock, list(lock.seen), list(lock.seen.values())


class _BucketEvents(BucketProcessor):
    """Which rows of a bucket of keys fire, with a lock for each. A key begins with the event, if there are several."""

    def __init__(self, terms: dict[str, EventTerms] | EventTerms, keys: list[T.StructField], ts: str, seq: str, source: str | None) -> None:
        self._terms, self._keys, self._ts, self._seq, self._source = terms, keys, ts, seq, source

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._locks = handle.getMapState("locks", T.StructType(self._keys), STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        run, bounds, keys = runs_of(self.frames(rows), [k.name for k in self._keys], [self._ts, self._seq])
        fired = np.zeros(len(run), bool)
        for name, begin, end in zip(keys, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            before = self._locks.getValue(name)
            lock = _locked(before)
            term = self._terms if isinstance(self._terms, EventTerms) else self._terms[name[0]]
            fired[begin:end] = fired_rows(lock, run.iloc[begin:end], term, self._ts, self._source)
            after = _saved(lock)
            if before is None or tuple(before) != after:
                self._locks.updateValue(name, after)
        yield run[fired].drop(columns=BUCKET)


def _expiring(term: EventTerms, ts: str, seq: str, source: str | None) -> Callable:
    """The same for one user, whose lock a timer frees."""
    rest = max(term.interval_ms, term.delay_ms)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        lock = _locked(state.get if state.exists else None)
        rows = pd.concat(list(frames)).sort_values([ts, seq], kind="stable")
        fired = fired_rows(lock, rows, term, ts, source)
        state.update(_saved(lock))
        # Past this time the state can no longer suppress or complete anything.
        end = max([*lock.seen.values(), lock.lock or 0]) + rest
        state.setTimeoutTimestamp(max(end, state.getCurrentWatermarkMs() + 1))
        yield rows[fired]

    return update


def _stateful(rows: DataFrame, term: EventTerms, user: str, ts: str, seq: str, source: str | None, expire: bool) -> DataFrame:
    if expire:
        update = _expiring(term, ts, seq, source)
        return rows.groupBy(user).applyInPandasWithState(update, rows.schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return stateful_by_bucket(rows, [user], _BucketEvents(term, [rows.schema[user]], ts, seq, source), rows.schema, [ts, seq])


def cooldown_stream(
    rows: DataFrame,
    interval_ms: int = COOLDOWN_MS,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    expire: bool = False,
) -> DataFrame:
    """Streaming :func:`beaconflow.operators.cooldown.cooldown`, in event time within a batch.

    ``expire`` frees a user's state once the watermark, which the frame must
    then carry, has passed the end of the rest.
    """
    term = EventTerms(("-",), interval_ms, 0)
    return _stateful(rows, term, user, ts, seq, None, expire)


def correlate_stream(
    rows: DataFrame,
    sources: list[str],
    interval_ms: int = COOLDOWN_MS,
    delay_ms: int = CORRELATION_DELAY_MS,
    require_all: bool = False,
    user: str = "imsi",
    ts: str = "ts_ms",
    seq: str = "seq",
    source: str = "source",
    expire: bool = False,
) -> DataFrame:
    """Streaming :func:`beaconflow.operators.correlate.correlate_sources`.

    A user's state is kept, as one whose sources were complete once fires again
    after each rest. ``expire`` frees it once the watermark, which the frame
    must then carry, has passed the end of the rest and of the delay of all
    activities: the user is new after that, and must be complete anew.
    """
    term = EventTerms(tuple(sources), interval_ms, delay_ms, require_all)
    return _stateful(rows, term, user, ts, seq, source, expire)


class _EventProcessor(StatefulProcessor):
    """State of one (event, user), which a timer frees; unlike the functions above it may follow other stateful steps."""

    def __init__(self, terms: dict[str, EventTerms], ts: str, seq: str, source: str) -> None:
        self._terms, self._ts, self._seq, self._source = terms, ts, seq, source

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._lock = handle.getValueState("lock", "lock long")
        self._seen = handle.getMapState("seen", "source string", "ts long")
        self._handle = handle
        self._until = handle.getValueState("until", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        term = self._terms[key[0]]
        saved = self._lock.get() if self._lock.exists() else None
        before = {k[0]: int(v[0]) for k, v in self._seen.iterator()}
        lock = EventLock(None if saved is None else int(saved[0]), dict(before))
        batch = pd.concat(list(rows)).sort_values([self._ts, self._seq], kind="stable")
        fired = fired_rows(lock, batch, term, self._ts, self._source)
        if lock.lock is not None:
            self._lock.update((lock.lock,))
        for name, t in lock.seen.items():
            if before.get(name) != t:
                self._seen.updateValue((name,), (t,))
        for name in before.keys() - lock.seen.keys():
            self._seen.removeKey((name,))
        end = max([*lock.seen.values(), lock.lock or 0]) + max(term.interval_ms, term.delay_ms)
        at = max(end, timerValues.getCurrentWatermarkInMs() + 1)
        old = self._until.get()[0] if self._until.exists() else None
        if old != at:
            if old is not None:
                self._handle.deleteTimer(old)
            self._handle.registerTimer(at)
            self._until.update((at,))
        yield batch[fired]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._lock.clear()
        self._seen.clear()
        self._until.clear()
        yield from ()

    def close(self) -> None:
        pass


def business_events_stream(
    rows: DataFrame,
    terms: dict[str, EventTerms],
    event: str = "event",
    user: str = "user",
    ts: str = "ts_ms",
    seq: str = "seq",
    source: str = "source",
    expire: bool = False,
) -> DataFrame:
    """The firing rows of many business events at once: one state per (event, user).

    ``expire`` frees a state by a timer at the end of its rest and delays, see
    :func:`correlate_stream`; the stream must carry a watermark then.
    """
    if not expire:
        keys = [rows.schema[event], rows.schema[user]]
        return stateful_by_bucket(rows, [event, user], _BucketEvents(dict(terms), keys, ts, seq, source), rows.schema, [ts, seq])
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    processor = _EventProcessor(dict(terms), ts, seq, source)
    return rows.groupBy(event, user).transformWithStateInPandas(processor, rows.schema, "Append", "EventTime")


def last_active_stream(
    rows: DataFrame, event: str = "event", user: str = "imsi", source: str = "source", ts: str = "ts_ms"
) -> DataFrame:
    """Update-mode aggregate: the latest activity never moves backwards."""
    return rows.groupBy(event, user, source).agg(F.max(ts).alias("last_active_ms"))


def _running_update(drop_idle: bool, key_name: str) -> Callable:
    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first, n = state.get if state.exists else (None, 0)
        rows = pd.concat(list(frames)).sort_values("__seq", kind="stable")
        if not state.exists:
            first = rows["__value"].iloc[0]
        n += len(rows)
        state.update((first, n))
        if drop_idle:
            state.setTimeoutDuration(1)
        yield pd.DataFrame({key_name: [key[0]], "first_value": [first], "n": [n]})

    return update


def running_count_stream(rows: DataFrame, key: str, value: str, seq: str, drop_idle: bool = False) -> DataFrame:
    """First value and occurrences per key so far, in update mode.

    By default an idle key keeps its count (a plain aggregate). ``drop_idle``
    forgets keys absent from a batch, as the state of a key without new rows
    times out at the next one; it needs a continuously triggered query.
    """
    if not drop_idle:
        return rows.groupBy(key).agg(F.min_by(value, seq).alias("first_value"), F.count(F.lit(1)).alias("n"))
    slim = rows.select(key, F.col(value).cast("string").alias("__value"), F.col(seq).alias("__seq"))
    state = T.StructType([T.StructField("first", T.StringType()), T.StructField("n", T.LongType())])
    output = T.StructType(
        [rows.schema[key], T.StructField("first_value", T.StringType()), T.StructField("n", T.LongType())]
    )
    return slim.groupBy(key).applyInPandasWithState(
        _running_update(True, key), output, state, "update", GroupStateTimeout.ProcessingTimeTimeout
    )

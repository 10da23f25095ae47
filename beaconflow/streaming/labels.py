"""Per-user label state in a stream: stay, last device, movement.

Records arrive in any order and are taken in arrival order (``seq``) within a
micro-batch, as the state must see them one after the other. One stateful
operator holds everything the label rules remember of a user; a call of Python
does a bucket of users.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from beaconflow.constants import AREA_ONSITE, AREA_ONSITE_STAY
from beaconflow.functions.geo import haversine_km
from beaconflow.operators.stay import StayConfig
from beaconflow.streaming.buckets import BucketProcessor, runs_of, stateful_by_bucket

Stays = dict[str, tuple[int, int]]


def crossing(old: int, new: int, config: StayConfig) -> int:
    """The label of a stay growing from ``old`` to ``new``; 0 when no limit lies between."""
    crossed = [x for x in config.ordered_limits if old <= x <= new]
    if not crossed:
        return 0
    if not config.output_threshold:
        return new
    return crossed[-1] if config.match_max else crossed[0]


def stay_step(stays: Stays, t: int, areas: list[str], config: StayConfig) -> dict[str, int]:
    """Labels of one record; ``stays`` (area -> first, last) is changed in place.

    A record later than all activity by more than the timeout starts afresh, one
    older by more than that is ignored, one in between may also move a stay's
    beginning back.
    """
    if not areas:
        return {}
    newest = max((last for _, last in stays.values()), default=0)
    if t - newest > config.timeout_ms:
        stays.clear()
        stays.update({a: (t, t) for a in areas})
        return dict.fromkeys(areas, 0)
    if newest - t > config.timeout_ms:
        return dict.fromkeys(areas, 0)
    labels = {}
    for area in areas:
        first, last = stays.get(area, (t, t))
        label = 0
        if area not in stays or t - last > config.timeout_ms:
            stays[area] = (t, t)
        elif t < first:
            stays[area] = (t, last)
            label = crossing(last - first, last - t, config)
        elif t > last:
            stays[area] = (first, t)
            label = crossing(last - first, t - first, config)
        labels[area] = label
    return labels


STATE = T.StructType(
    [
        T.StructField("areas", T.ArrayType(T.StringType())),
        T.StructField("firsts", T.ArrayType(T.LongType())),
        T.StructField("lasts", T.ArrayType(T.LongType())),
        T.StructField("imei", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("cell", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)


@dataclass(frozen=True)
class UserLabels:
    """Which stateful labels to keep for each user."""

    stay: StayConfig | None = None
    device: bool = False
    movement: bool = False

    def inputs(self) -> list[str]:
        out = ["areas"] if self.stay else []
        out += ["imei"] if self.device else []
        return out + (["geo_latitude", "geo_longitude", "lac_ci"] if self.movement else [])

    def outputs(self) -> T.StructType:
        out = T.StructType()
        if self.stay:
            out.add("stays", T.ArrayType(T.LongType()))
        if self.device:
            out.add("last_imei", T.StringType())
        if self.movement:
            out.add("prev_lat", T.DoubleType()).add("prev_lng", T.DoubleType())
            out.add("last_lac_ci", T.StringType()).add("prev_ts", T.LongType())
        return out


def _shifted(values: pd.Series, starts: np.ndarray, first: list) -> pd.Series:
    """Each record's value before it; of each user's first record the one in ``first``."""
    out = values.shift()
    out.iloc[starts] = first
    return out


def _last(value):
    return None if pd.isna(value) else value


_NEW = ([], [], [], "", None, None, None, None)


def label_runs(
    rows: pd.DataFrame, bounds: np.ndarray, saved: list[tuple], config: UserLabels, ts: str, passed: list[str]
) -> tuple[pd.DataFrame, list[tuple]]:
    """Labels of the records of several users, and what is remembered of each afterwards.

    The records of user ``i``, in their order, lie from ``bounds[i]`` to
    ``bounds[i + 1]``; ``saved[i]`` is what was remembered before.
    """
    starts, ends = bounds[:-1], bounds[1:] - 1
    result = rows[passed].copy()
    before = [list(column) for column in zip(*saved)]
    stays = [{a: (int(f), int(x)) for a, f, x in zip(*entry[:3])} for entry in saved]
    if config.stay:
        labels = []
        times, areas = rows[ts].astype("int64").tolist(), rows["areas"].tolist()
        for own, begin, end in zip(stays, starts.tolist(), bounds[1:].tolist(), strict=True):
            for t, names in zip(times[begin:end], areas[begin:end], strict=True):
                names = list(names)
                found = stay_step(own, t, names, config.stay)
                labels.append([found[a] for a in names])
        result["stays"] = pd.Series(labels, dtype="object")
    after = before[3:]
    if config.device:
        result["last_imei"] = _shifted(rows["imei"].astype("object"), starts, before[3])
        after[0] = [_last(x) for x in rows["imei"].iloc[ends]]
    if config.movement:
        number = lambda x: None if pd.isna(x) else float(x)
        result["prev_lat"] = _shifted(rows["geo_latitude"].astype("float64"), starts, before[4])
        result["prev_lng"] = _shifted(rows["geo_longitude"].astype("float64"), starts, before[5])
        result["last_lac_ci"] = _shifted(rows["lac_ci"].astype("object"), starts, before[6])
        result["prev_ts"] = _shifted(rows[ts].astype("Int64"), starts, [pd.NA if x is None else int(x) for x in before[7]])
        after[1:] = [
            [number(x) for x in rows["geo_latitude"].iloc[ends]],
            [number(x) for x in rows["geo_longitude"].iloc[ends]],
            [_last(x) for x in rows["lac_ci"].iloc[ends]],
            [int(x) for x in rows[ts].iloc[ends]],
        ]
    remembered = [
        (list(own), [f for f, _ in own.values()], [x for _, x in own.values()], *rest) for own, *rest in zip(stays, *after)
    ]
    return result, remembered


class _LabelProcessor(BucketProcessor):
    """Labels of a bucket of users, with a state for each."""

    def __init__(self, config: UserLabels, user: T.StructField, ts: str, seq: str, passed: list[str]) -> None:
        self._config, self._user, self._ts, self._seq, self._passed = config, user, ts, seq, passed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._known = handle.getMapState("users", T.StructType([self._user]), STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # The users' rows of one micro-batch; the trigger limits bound them.
        run, bounds, users = runs_of(self.frames(rows), [self._user.name], [self._seq])
        saved = [self._known.getValue(u) or _NEW for u in users]
        result, remembered = label_runs(run, bounds, saved, self._config, self._ts, self._passed)
        for u, old, value in zip(users, saved, remembered, strict=True):
            if old is _NEW or tuple(old) != value:
                self._known.updateValue(u, value)
        yield result


def _forgetting(config: UserLabels, ts: str, seq: str, passed: list[str], forget_ms: int) -> Callable:
    """The same for one user, whose state a timer frees."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values(seq, kind="stable").reset_index(drop=True)
        saved = state.get if state.exists else _NEW
        result, (remembered,) = label_runs(rows, np.array([0, len(rows)]), [saved], config, ts, passed)
        state.update(remembered)
        newest = max([int(rows[ts].max()), *remembered[2]])
        state.setTimeoutTimestamp(max(newest + forget_ms, state.getCurrentWatermarkMs() + 1))
        yield result

    return update


def label_users(
    stream: DataFrame, config: UserLabels, user: str = "imsi", ts: str = "ts_ms", seq: str = "seq", forget_ms: int | None = None
) -> DataFrame:
    """Add the configured stateful labels to a streaming frame.

    ``forget_ms`` frees a user's state once the watermark, which the stream
    must then carry, is so far past the user's newest record. Stays are the
    same with it, as after their timeout (which it must not be shorter than) a
    record starts afresh anyway; device and movement know no last record then.

    The areas come from the ``area_onsite`` map; filter the stream before this
    step where possible, since all of a user's rows of a batch meet here.
    """
    if forget_ms is not None and config.stay and forget_ms < config.stay.timeout_ms:
        raise ValueError("a state must not be forgotten before its stays end")
    frame = stream
    if config.stay:
        frame = frame.withColumn("areas", F.map_keys(AREA_ONSITE))
    if config.movement:
        frame = frame.withColumns({c: F.col(c).cast("double") for c in ("geo_latitude", "geo_longitude")})
    # Maps do not travel to Python; they pass as JSON and come back unchanged.
    maps = {f.name: f.dataType for f in frame.schema if isinstance(f.dataType, T.MapType)}
    frame = frame.withColumns({c: F.to_json(c) for c in maps})
    passed = frame.columns
    schema = T.StructType([*frame.schema.fields, *config.outputs().fields])
    if forget_ms is None:
        processor = _LabelProcessor(config, frame.schema[user], ts, seq, passed)
        out = stateful_by_bucket(frame, [user], processor, schema, [ts, seq])
    else:
        out = frame.groupBy(user).applyInPandasWithState(
            _forgetting(config, ts, seq, passed, forget_ms), schema, STATE, "append", GroupStateTimeout.EventTimeTimeout
        )
    out = out.withColumns({c: F.from_json(c, kind) for c, kind in maps.items()})
    if config.stay:
        entries = F.arrays_zip("areas", "stays")
        stay_map = F.map_from_entries(
            F.transform(entries, lambda e: F.struct(e["areas"], e["stays"].cast("string")))
        )
        out = out.withColumn(AREA_ONSITE_STAY, stay_map).drop("areas", "stays")
    if config.movement:
        elapsed = F.col(ts) - F.col("prev_ts")
        distance = haversine_km(*[F.col(c) for c in ("prev_lat", "prev_lng", "geo_latitude", "geo_longitude")])
        out = (
            out.withColumns({"distance_km": distance, "elapsed_ms": elapsed})
            .withColumn("speed_kmh", F.try_divide(F.col("distance_km") * 3_600_000, F.col("elapsed_ms")))
            .drop("prev_lat", "prev_lng", "prev_ts")
        )
    return out

"""Keys processed once over the life of a stream: the set of those done is the stream's state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from beaconflow.streaming.buckets import BUCKET, BucketProcessor, plain, stateful_by_bucket

#: The name of the state, by which it is read back.
DONE = "done"


class _Once(BucketProcessor):
    """Gives out the first row of every key of a bucket that has no state, and makes one."""

    def __init__(self, key: T.StructField, seq: str) -> None:
        self._key, self._seq = key, seq

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._done = handle.getMapState(DONE, T.StructType([self._key]), "done boolean")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for value in initialState.set_axis(self.known_columns, axis=1)[self._key.name]:
            self._done.updateValue((plain(value),), (True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in self.frames(rows):  # one row of a key is kept, however many there are
            frame = frame if first is None else pd.concat([first, frame])
            first = frame.sort_values(self._seq, kind="stable").drop_duplicates(self._key.name)
        keys = [(plain(value),) for value in first[self._key.name]]
        fresh = np.array([not self._done.containsKey(k) for k in keys], bool)
        for k, new in zip(keys, fresh, strict=True):
            if new:
                self._done.updateValue(k, (True,))
        yield first[fresh].drop(columns=BUCKET)


def once_per_key(rows: DataFrame, processed: DataFrame, key: str, seq: str) -> DataFrame:
    """Streaming :func:`beaconflow.operators.lookups.not_yet_processed`: the first row of every key not done before.

    ``processed`` (its column ``key``) is loaded once, as the state that the
    stream begins with; a micro-batch then reads and writes the states of its
    own keys only, however many keys are done. Null keys are one key.
    """
    known = processed.select(F.col(key).cast(rows.schema[key].dataType).alias(key)).distinct()
    return stateful_by_bucket(rows, [key], _Once(rows.schema[key], seq), rows.schema, [seq], known)


def processed_keys(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """The keys done so far, read back from the state of a stream that has stopped (or of its last batch)."""
    state = spark.read.format("statestore").option("stateVarName", DONE).load(checkpoint)
    return state.select(F.col(f"user_map_key.{key}").alias(key))

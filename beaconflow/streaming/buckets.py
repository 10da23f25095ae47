"""Per-key state of a stream, with many keys in one call of Python.

A call of Python costs some ten milliseconds, whatever its rows, which a call
for every key would pay for every key of a micro-batch. Here the keys are dealt
into buckets, the buckets are the groups, and the state of a bucket is a map
from key to state: a micro-batch still reads and writes the states of its own
keys only. Buckets are far more than tasks, so a task holds the rows of one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

# Fixed value: the state store that stateful processors need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BUCKET = "__bucket"
#: Part of a stream's checkpoint: a key must stay in its bucket.
BUCKETS = 512


class BucketProcessor(StatefulProcessor):
    """Spark's calls give Python columns of its own naming where a name is no identifier; ``frames`` have the names of the rows."""

    columns: list[str]
    known_columns: list[str]

    def frames(self, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return (frame.set_axis(self.columns, axis=1) for frame in rows)

    def close(self) -> None:
        pass


def with_bucket(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def stateful_by_bucket(
    rows: DataFrame,
    keys: list[str],
    processor: BucketProcessor,
    schema: T.StructType,
    numbers: list[str],
    initial: DataFrame | None = None,
) -> DataFrame:
    """``processor`` over the buckets of ``keys``; it gives out rows of ``schema``, which begins with the columns of ``rows``.

    ``numbers`` are the columns it computes with. Other whole numbers travel as
    text: pandas would make floats of them where another key's are null.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    whole = [f.name for f in rows.schema if isinstance(f.dataType, T.LongType) and f.name not in (*numbers, *keys)]
    sent = rows.withColumns({c: F.col(c).cast("string") for c in whole})
    kinds = T.StructType([T.StructField(f.name, T.StringType()) if f.name in whole else f for f in schema])
    processor.columns = [*rows.columns, BUCKET]
    processor.known_columns = [] if initial is None else [*initial.columns, BUCKET]
    known = None if initial is None else with_bucket(initial, keys).groupBy(BUCKET)
    out = with_bucket(sent, keys).groupBy(BUCKET).transformWithStateInPandas(processor, kinds, "Append", "None", initialState=known)
    return out.withColumns({c: F.col(c).cast("long") for c in whole})


def plain(value):
    """A key's value as Python has it; null is ``None``."""
    if pd.isna(value):
        return None
    value = value.item() if isinstance(value, np.generic) else value
    return int(value) if isinstance(value, float) and value.is_integer() else value


def runs_of(frames: Iterator[pd.DataFrame], keys: list[str], order: list[str]) -> tuple[pd.DataFrame, np.ndarray, list[tuple]]:
    """A bucket's rows, each key's together in their ``order``; where each begins (and the end of all), and the keys."""
    rows = pd.concat(list(frames)).sort_values(order, kind="stable")
    number = rows.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    at = np.argsort(number, kind="stable")
    rows, number = rows.iloc[at].reset_index(drop=True), number[at]
    starts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    named = [tuple(map(plain, key)) for key in rows[keys].iloc[starts].itertuples(index=False)]
    return rows, np.append(starts, len(rows)), named

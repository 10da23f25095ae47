"""Session helpers shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_lock = threading.Lock()
#: By session: how many are within arrow_batches, and the setting to return to.
_within: dict[int, tuple[int, str | None]] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "beaconflow") -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local folder would be lost with its executor, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return os.path.join(os.getcwd(), "spark-warehouse", "shared")


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`shared_dir`; never reused, so retries cannot mix."""
    return f"{shared_dir(spark)}/beaconflow/{name}-{uuid.uuid4().hex}"


def drop_shared(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`new_shared_path` named, once nobody reads it any more."""
    if "/beaconflow/" not in path:
        raise ValueError(f"{path} is not a folder of this library")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def shared_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back, for several consumers.

    Unlike a cached frame it survives the loss of any executor. Give it to
    :func:`drop_table` when its last reader is done.
    """
    path = new_shared_path(df.sparkSession, name)
    writer = df.write if compression is None else df.write.option("compression", compression)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def drop_table(*tables: DataFrame) -> None:
    """Delete tables that :func:`shared_table` wrote, once nothing that is still to be computed reads them."""
    for table in tables:
        drop_shared(table.sparkSession, table.shared_path)


@contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Actions in here give Python tasks batches of about ``most`` bytes, one row at least.

    A task holds a batch up to four times outside the heap (vectors and their
    copy for the worker, both grown by doubling) and once or twice in Python.
    A smaller setting of the session stays; threads may be in here together.
    """
    key = spark._jsparkSession.hashCode()
    with _lock:
        now = spark.conf.get(_ARROW_BYTES, None)
        inside, old = _within.get(key) or (0, now)
        _within[key] = inside + 1, old
        if now is None or not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) <= most:
            spark.conf.set(_ARROW_BYTES, f"{most}b")
    try:
        yield
    finally:
        with _lock:
            inside, old = _within.pop(key)
            if inside > 1:
                _within[key] = inside - 1, old
            elif old is None:
                spark.conf.unset(_ARROW_BYTES)
            else:
                spark.conf.set(_ARROW_BYTES, old)

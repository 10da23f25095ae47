"""Running streams: triggers, gates, delivery to several consumers, progress."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from beaconflow.session import new_shared_path
from beaconflow.sources import shared_files as S

BatchHandler = Callable[[DataFrame, int], None]


def with_trigger(writer: DataStreamWriter, interval_seconds: float | None) -> DataStreamWriter:
    """A fixed micro-batch interval, or everything available now and stop."""
    if interval_seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{interval_seconds} seconds")


def gated(handler: BatchHandler, start: str, end: str, now: Callable[[], datetime] | None = None) -> BatchHandler:
    """Run ``handler`` only while the wall clock (HH:mm:ss) is strictly between two settings."""
    clock = now or (lambda: datetime.now(timezone.utc))

    def handle(batch: DataFrame, batch_id: int) -> None:
        if start < clock().strftime("%H:%M:%S") < end:
            handler(batch, batch_id)

    return handle


class DeliveryError(RuntimeError):
    """Some consumers did not take a batch; the others did, and will not get it again."""


class Ledger:
    """Which consumer has taken which batch: an empty file for each (batch, consumer) below ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path.rstrip("/")

    def _entry(self, batch_id: int, consumer: str) -> str:
        return f"{self._path}/batch={batch_id}/{quote(consumer, safe='')}"

    def has(self, batch_id: int, consumer: str) -> bool:
        files, path = S.hadoop_path(self._spark, self._entry(batch_id, consumer))
        return files.exists(path)

    def commit(self, batch_id: int, consumer: str) -> None:
        S.put_text(self._spark, self._entry(batch_id, consumer), "")

    def forget(self, batch_id: int) -> None:
        """Drop the entries of a batch that cannot come again."""
        S.delete(self._spark, f"{self._path}/batch={batch_id}")


def delivering(
    prepare: Callable[[DataFrame], DataFrame],
    consumers: dict[str, Callable[[DataFrame, int], None]],
    ledger: Ledger | None = None,
) -> BatchHandler:
    """Compute a batch once, keep it while each consumer takes it, then let it go.

    With a ``ledger`` a batch that comes again, after a failure or a restart,
    goes only to consumers that have not taken it. One that fails does not keep
    it from the others; the batch fails after all were tried. Between taking a
    batch and the ledger's entry a consumer may be interrupted, and gets it
    again: that consumer alone must accept a batch twice.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        waiting = {name: c for name, c in consumers.items() if not (ledger and ledger.has(batch_id, name))}
        if not waiting:
            return
        prepared, failed = prepare(batch).persist(), {}
        try:
            for name, consume in waiting.items():
                try:
                    consume(prepared, batch_id)
                except Exception as problem:
                    if ledger is None:
                        raise
                    failed[name] = problem
                    continue
                if ledger is not None:
                    ledger.commit(batch_id, name)
        finally:
            prepared.unpersist()
        if failed:
            raise DeliveryError(f"batch {batch_id} was not taken by {sorted(failed)}") from next(iter(failed.values()))
        if ledger is not None and batch_id > 1:
            ledger.forget(batch_id - 2)  # a batch comes again only before the next one's end

    return handle


def write_batches_to(path: str) -> BatchHandler:
    """Each micro-batch as one Parquet folder; a retried batch replaces its own folder."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return handle


def start_batches(
    stream: DataFrame,
    handler: BatchHandler,
    checkpoint: str,
    mode: str = "append",
    interval_seconds: float | None = None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handler).outputMode(mode).option("checkpointLocation", checkpoint)
    return with_trigger(writer, interval_seconds).start()


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Drive a stream over everything available and read its output back, with the ``batch`` number."""
    spark = stream.sparkSession
    path = new_shared_path(spark, name)
    query = start_batches(stream, write_batches_to(f"{path}/out"), f"{path}/checkpoint", mode)
    query.awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(f"{path}/out")


def latest_per_key(updates: DataFrame, key: list[str]) -> DataFrame:
    """What an update-mode stream has last said about each key."""
    others = [c for c in updates.columns if c not in (*key, "batch")]
    last = updates.groupBy(*key).agg(F.max_by(F.struct(*others), "batch").alias("row"))
    return last.select(*key, "row.*")


def counting(handler: BatchHandler, path: str) -> BatchHandler:
    """Run ``handler`` and write the number of records of each micro-batch below ``path``; a retried batch replaces its own.

    Progress reports are kept for the last batches only, files for all.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            kept.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            handler(kept, batch_id)
        finally:
            kept.unpersist()

    return handle


def batch_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Records received per micro-batch, as :func:`counting` wrote them below ``path``."""
    return spark.read.schema("n long, batch long").parquet(path).select("batch", "n")


class BatchLog(StreamingQueryListener):
    """Writes the number of records, times and trigger of every micro-batch of one query, as one small file each.

    Listens to the progress that Spark reports anyway, so batches are neither
    counted nor kept. A batch that is run again replaces its own file, also
    after a restart from the checkpoint. Triggers without data leave no file.
    """

    SCHEMA = "batch long, n long, started string, duration_ms long"

    def __init__(self, spark: SparkSession, path: str, name: str) -> None:
        self._spark, self._path, self._name = spark, path.rstrip("/"), name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self._name or progress.numInputRows == 0:
            return
        row = {
            "batch": progress.batchId,
            "n": progress.numInputRows,
            "started": progress.timestamp,
            "duration_ms": progress.durationMs.get("triggerExecution"),
        }
        S.put_text(self._spark, f"{self._path}/{progress.batchId}.json", json.dumps(row))

    def read(self) -> DataFrame:
        """All batches reported so far; waits for reports that are on their way."""
        self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return self._spark.read.schema(self.SCHEMA).json(self._path)

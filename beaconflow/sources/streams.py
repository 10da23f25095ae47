"""Opening a stream of text lines."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_options(kind: str, conf: dict[str, str]) -> tuple[str, dict[str, str]]:
    """The Spark source and its options for a configured source type."""
    if kind in ("kafka", "kafka_direct"):
        options = {"kafka.bootstrap.servers": conf["brokers"], "subscribe": conf["topic"].replace(" ", "")}
        if kind == "kafka":
            options["kafka.group.id"] = conf["group"]
            options["minPartitions"] = str(conf.get("receivernum", "1"))
        for name in ("startingOffsets", "maxOffsetsPerTrigger", "failOnDataLoss"):
            if name in conf:
                options[name] = str(conf[name])
        return "kafka", options
    if kind == "hdfs":
        options = {"path": conf["path"]}
        if "maxFilesPerTrigger" in conf:
            options["maxFilesPerTrigger"] = str(conf["maxFilesPerTrigger"])
        return "text", options
    raise ValueError(f"unsupported source type {kind!r}")


def open_stream(spark: SparkSession, kind: str, conf: dict[str, str]) -> DataFrame:
    """``value`` and ``seq`` of each record, whatever the source type.

    ``seq`` is text that sorts in the order of arrival, without any id in the
    record: time, partition and offset of a topic; of a file its time, path,
    block and the line's place in it.
    """
    source, options = stream_options(kind, conf)
    stream = spark.readStream.format(source).options(**options).load()
    if source == "kafka":
        return stream.select(F.col("value").cast("string").alias("value"), topic_order().alias("seq"))
    return with_file_order(stream)


def _digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 20, "0")


def topic_order() -> Column:
    return F.concat_ws("/", _digits(F.unix_millis("timestamp")), _digits(F.col("partition")), _digits(F.col("offset")))


def with_file_order(lines: DataFrame) -> DataFrame:
    """``value`` and ``seq`` of lines read from files; a task reads a block's lines in their order."""
    block = F.concat_ws(
        "/", _digits(F.unix_millis("_metadata.file_modification_time")), "_metadata.file_path", _digits(F.col("_metadata.file_block_start"))
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = 0
        for batch in batches:
            place = pc.utf8_lpad(pa.array(range(begin, begin + batch.num_rows), pa.int64()).cast(pa.string()), 20, "0")
            begin += batch.num_rows
            seq = pc.binary_join_element_wise(batch.column("block"), place, "/")
            yield pa.RecordBatch.from_arrays([batch.column("value"), seq], ["value", "seq"])

    return lines.select("value", block.alias("block")).mapInArrow(number, "value string, seq string")

"""Messages, event sinks and archives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from beaconflow.functions.text import joined_message
from beaconflow.functions.times import ARCHIVE_TIME, SIGNAL_TIME


def event_messages(
    df: DataFrame, columns: list[str], key: str, delim: str = ",", sent_at: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """``key`` and ``value`` of each event, and the columns ``keep`` (such as topic); the send time follows after a comma."""
    moment = F.date_format(F.current_timestamp() if sent_at is None else sent_at, SIGNAL_TIME)
    body = joined_message([F.col(c) for c in columns], delim)
    return df.select(F.col(key).cast("string").alias("key"), F.concat(body, F.lit(","), moment).alias("value"), *keep)


def check_output_type(output_type: str) -> None:
    if output_type != "kafka":
        raise ValueError(f"unsupported output type {output_type!r}")


def publish_options(messages: DataFrame, topic: str | None, brokers: str) -> dict[str, str]:
    """Options of the sink. The option ``topic`` would override the column, so it is left out where there is one."""
    options = {"kafka.bootstrap.servers": brokers}
    if "topic" not in messages.columns:
        if not topic:
            raise ValueError("messages without a column topic need a topic")
        options["topic"] = topic
    return options


def publish_events(messages: DataFrame, output_type: str, topic: str | None, brokers: str) -> DataStreamWriter | None:
    """Send messages: a batch frame is written at once, a stream's unstarted writer is returned.

    ``topic`` is for messages without a column of that name; with one, each
    message goes to its own.
    """
    check_output_type(output_type)
    options = publish_options(messages, topic, brokers)
    if messages.isStreaming:
        return messages.writeStream.format("kafka").options(**options)
    messages.write.format("kafka").options(**options).save()
    return None


def publish_to_files(messages: DataFrame, path: str, topic: str | None = None, checkpoint: str | None = None) -> DataStreamWriter | None:
    """Messages as Parquet, one folder for each topic: for consumers that read files, and to test what would be sent.

    A batch frame is appended at once; a stream's unstarted writer, which needs
    a ``checkpoint``, writes every message once. ``topic`` is for messages
    without a topic of their own; one that has none at all is an error, as with
    the broker. Tasks write their own files, so no topic is gathered in one.
    """
    own = F.col("topic") if "topic" in messages.columns else F.lit(None)
    rows = messages.select("key", "value", F.coalesce(own.cast("string"), F.lit(topic)).alias("topic"))
    rows = rows.withColumn("topic", F.coalesce("topic", F.raise_error(F.lit("message without a topic")).cast("string")))
    if rows.isStreaming:
        if not checkpoint:
            raise ValueError("a stream needs a checkpoint")
        return rows.writeStream.format("parquet").partitionBy("topic").option("path", path).option("checkpointLocation", checkpoint)
    rows.write.mode("append").partitionBy("topic").parquet(path)
    return None


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """key, value and topic of the messages below ``path``; topics stay texts."""
    return spark.read.schema("key string, value string, topic string").parquet(path)


def archive_name(prefix: str, suffix: str, moment: Column) -> Column:
    return F.concat(F.lit(prefix), F.date_format(moment, ARCHIVE_TIME), F.lit(suffix))


def archive_stream(lines: DataFrame, path: str, checkpoint: str, prefix: str = "", suffix: str = "") -> DataStreamWriter:
    """Unstarted writer of raw lines, one ``archive=<prefix><batch time><suffix>`` folder per micro-batch.

    The batch time is part of the offset log, so a retried batch lands in the
    same folder. Age and size bounds are the trigger interval and the source's
    ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``.
    """
    named = lines.select("value", archive_name(prefix, suffix, F.current_timestamp()).alias("archive"))
    return (
        named.writeStream.format("text")
        .partitionBy("archive")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def archive_batch(
    lines: DataFrame, path: str, moment: Column, prefix: str = "", suffix: str = "", files: int | None = None
) -> None:
    """Batch form: ``moment`` is the batch time of each line.

    By default each task writes its own file per archive. ``files`` gathers an
    archive's lines into about that many files, which costs a shuffle.
    """
    named = lines.select("value", archive_name(prefix, suffix, moment).alias("archive"))
    if files is not None:
        named = named.repartition(F.col("archive"), F.pmod(F.xxhash64("value"), F.lit(files)))
    named.write.mode("append").partitionBy("archive").text(path)


def matching_lines(lines: DataFrame, text: str, name: str = "matching") -> tuple[DataFrame, Observation | None]:
    """Lines containing ``text`` and an observation counting them once they are written.

    A stream reports the count per micro-batch under ``name`` in its progress
    (``observedMetrics``) instead.
    """
    kept = lines.where(F.col("value").contains(text))
    matched = F.count(F.lit(1)).alias("matched")
    if lines.isStreaming:
        return kept.observe(name, matched), None
    count = Observation(name)
    return kept.observe(count, matched), count

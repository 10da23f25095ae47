"""Time patterns and conversions. Times are epoch milliseconds inside the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The time formats of the records, messages and archives.
SIGNAL_TIME = "yyyyMMdd HH:mm:ss.SSS"
RECEIVE_TIME = "yyyy-MM-dd HH:mm:ss:SSS"
CLOCK_TIME = "HH:mm:ss"
ARCHIVE_TIME = "yyyyMMddHHmmss"


def parse_signal_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(SIGNAL_TIME))


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def format_millis(ms: Column, pattern: str) -> Column:
    return F.date_format(F.timestamp_millis(ms), pattern)

"""Bulk reads of lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconflow.functions.text import split_fields

# The encodings Spark reads without further permission.
_PLAIN_ENCODINGS = ("US-ASCII", "ISO-8859-1", "UTF-8", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32")


def read_file(
    spark: SparkSession, path: str, columns: dict[str, int], delim: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """Chosen positions of a delimited file as trimmed strings; see :func:`rejected_lines` for the lines left out."""
    return pick_columns(read_lines(spark, path, encoding), columns, delim)


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Whole lines of a text file in any encoding, as a column ``value``."""
    if encoding.upper() in ("UTF-8", "US-ASCII"):
        return spark.read.text(path)
    if encoding.upper() not in _PLAIN_ENCODINGS:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    # The text source knows UTF-8 only. The CSV source decodes others; its
    # separator here is two noncharacters, which no text contains.
    # Line ends of several bytes must be named.
    ends = {"lineSep": "\n"} if encoding.upper().startswith(("UTF-16", "UTF-32")) else {}
    return spark.read.schema("value string").csv(path, sep="\ufffe\uffff", quote="", escape="", encoding=encoding, **ends)


def _fields(lines: DataFrame, delim: str) -> DataFrame:
    return lines.select("value", split_fields(F.col("value"), delim).alias("f"))


def pick_columns(lines: DataFrame, columns: dict[str, int], delim: str = ",") -> DataFrame:
    """Named positions of the delimited text lines that have them all."""
    enough = F.size("f") > max(columns.values())
    return _fields(lines, delim).where(enough).select(*[F.trim(F.get("f", F.lit(i))).alias(name) for name, i in columns.items()])


def rejected_lines(lines: DataFrame, columns: dict[str, int], delim: str = ",") -> DataFrame:
    """The lines that :func:`pick_columns` leaves out as too short."""
    enough = F.size("f") > max(columns.values())
    return _fields(lines, delim).where(~F.coalesce(enough, F.lit(False))).select("value")


def jdbc_options(
    url: str,
    table: str,
    fetchsize: int = 10_000,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    **extra: str,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetchsize), **extra}
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its partition column")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_table(spark: SparkSession, columns: list[str], **options) -> DataFrame:
    """Chosen columns of a database table as strings; see :func:`jdbc_options`."""
    table = spark.read.format("jdbc").options(**jdbc_options(**options)).load()
    return table.select(*[F.col(c).cast("string").alias(c) for c in columns])


def read_dimension(spark: SparkSession, kind: str, **options) -> DataFrame:
    """A lookup table from a ``db`` table or a ``file``."""
    if kind == "db":
        return read_table(spark, **options)
    if kind == "file":
        return read_file(spark, **options)
    raise ValueError(f"unsupported dimension source {kind!r}")

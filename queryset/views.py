"""The given tables seen as signal records, cells and profiles, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconflow.session import new_shared_path

HOUR = 3_600_000
DAY = 24 * HOUR

_ID = "concat('46000', lpad(cast({} as string), 10, '0'))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_signals(events: DataFrame) -> DataFrame:
    """Events as signal records; works on batch and streaming frames."""
    base = events.selectExpr(
        "event_id as seq",
        "user_id",
        "cast(ts as timestamp) as ts",
        "unix_millis(cast(ts as timestamp)) as ts_ms",
        "event_type",
        "value",
        "cast(round(value * 100) as bigint) as cents",
        "case event_type when 'click' then 1 when 'signup' then 2 when 'view' then 3 when 'purchase' then 8 "
        "else 26 end as eventID",
        "cast(event_id % 4 as int) as issmsalone",
        "cast(regexp_extract(props, '([0-9]+)', 1) as int) as cell",
        f"{_ID.format('user_id')} as own",
        f"case when event_id % 10 = 0 then '000000000000000' else {_ID.format('(user_id * 7 + event_id) % 1500')} "
        "end as other",
    )
    called = "(eventID = 3 or (eventID in (8, 26) and issmsalone <> 1))"
    return base.selectExpr(
        "*",
        "own as imsi",
        "concat(user_id, '-', cell % 3) as imei",
        f"case when {called} then other else own end as callingimsi",
        f"case when {called} then own else other end as calledimsi",
        "20000 + cell * 37 as lac_code",
        "1000 + cell * 911 as ci_code",
        "lpad(hex(20000 + cell * 37), 4, '0') as lac",
        "case when cell < 71 then lpad(hex(1000 + cell * 911), 4, '0') else hex(1000 + cell * 911) end as ci",
    ).drop("own", "other")


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_signals(table(spark, sf_dir, "events"))


#: Rows of a file that a stream's input is written in.
FILE_ROWS = 2_000_000


def arriving(rows: DataFrame, by: str, batches: int) -> Iterator[tuple[DataFrame, int]]:
    """``rows`` cut into about equal ranges of ``by``, and the number of files of each.

    The cuts are approximate quantiles, a summary of bounded size. Rows without
    a value come first. Scans of a table in the order of ``by`` read their own
    row groups only. An empty table is one empty range.
    """
    cuts = rows.approxQuantile(by, [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    bounds = [None, *sorted(set(cuts)), None]
    files = max(1, -(-rows.count() // (batches * FILE_ROWS)))
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        own = F.lit(True)
        if low is not None:
            own &= F.col(by) >= low
        if high is not None:
            own &= (F.col(by) < high) | (F.col(by).isNull() if low is None else F.lit(False))
        yield rows.where(own), files


def signal_stream(spark: SparkSession, sf_dir: str, batches: int = 4) -> DataFrame:
    """The whole event table as a stream of about so many micro-batches, in the order of arrival."""
    return as_signals(arrivals(table(spark, sf_dir, "events"), batches))


def arrivals(events: DataFrame, batches: int) -> DataFrame:
    """A table with ``event_id`` as a stream: files written range after range, as many of a range as one micro-batch takes."""
    path = new_shared_path(events.sparkSession, "events")
    files = 1
    for rows, files in arriving(events, "event_id", batches):
        rows.repartition(files).write.mode("append").parquet(path)
    return events.sparkSession.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(path)


def signal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as delimited lines of 17 fields, some of them spoilt in various ways."""
    return as_lines(signals(spark, sf_dir))


def as_lines(records: DataFrame) -> DataFrame:
    return records.selectExpr("seq", f"{_LINE_SPARK} as value")


def _line(time: str, device: str) -> str:
    def spoilt(n: int, bad: str, good: str) -> str:
        return f"case when seq % {n} = 5 then {bad} else {good} end"

    fields = [
        "cast(eventID as string)",
        spoilt(109, "'20241301 00:00:00.000'", time),
        spoilt(113, "'-5'", "cast(lac_code as string)"),
        "cast(ci_code as string)",
        "''",
        device,
        spoilt(97, "'000000000000000'", "callingimsi"),
        spoilt(97, "'000000000000000'", "calledimsi"),
        "''",
        "''",
        spoilt(103, "'x'", "cast(seq % 2 as string)"),
        spoilt(107, "' 7'", "cast(seq % 3 as string)"),
        "'1'",
        "'0'",
        "cast(seq % 5 as string)",
        "'0'",
    ]
    last = spoilt(101, "''", "cast(issmsalone as string)")
    return "concat(" + ", ',', ".join([*fields, last]) + ")"


_DEVICE = "concat('86', lpad(cast(user_id as string), 8, '0'), cast(cell % 3 as string), '00000')"
_LINE_SPARK = _line("date_format(ts, 'yyyyMMdd HH:mm:ss.SSS')", _DEVICE)
_LINE_SQL = _line("strftime(ts, '%Y%m%d %H:%M:%S.%g')", _DEVICE)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per cell: codes, areas, nation, coordinates."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    wide = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).withColumn(
        "cell", F.explode(F.sequence(F.col("n_nationkey"), F.col("n_nationkey") + 75, F.lit(25)))
    )
    return wide.selectExpr(
        "cell",
        "lpad(hex(20000 + cell * 37), 4, '0') as lac",
        "case when cell < 71 then lpad(hex(1000 + cell * 911), 4, '0') else hex(1000 + cell * 911) end as ci",
        "concat(r_name, ' , Z', cell % 2, ',') as areas",
        "n_name as nation",
        "n_nationkey as nation_id",
        "cast(cast(20 + cell * 0.37 as decimal(8,2)) as string) as geo_latitude",
        "cast(cast(100 + cell * 0.53 as decimal(8,2)) as string) as geo_longitude",
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir).select("lac", "ci", "areas", "nation")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        f"{_ID.format('c_custkey')} as imsi", "c_name", "c_mktsegment", "c_nationkey"
    )


_SQL_ID = "'46000' || lpad(CAST({} AS VARCHAR), 10, '0')"

SQL_VIEWS = f"""
WITH RECURSIVE base AS (
  SELECT event_id AS seq, user_id, ts, epoch_us(ts) // 1000 AS ts_ms, event_type, value,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CASE event_type WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'view' THEN 3 WHEN 'purchase' THEN 8
              ELSE 26 END AS eventID,
         CAST(event_id % 4 AS INTEGER) AS issmsalone,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS cell,
         {_SQL_ID.format('user_id')} AS own,
         CASE WHEN event_id % 10 = 0 THEN '000000000000000'
              ELSE {_SQL_ID.format('(user_id * 7 + event_id) % 1500')} END AS other
  FROM events),
s AS (
  SELECT *, own AS imsi, CAST(user_id AS VARCHAR) || '-' || CAST(cell % 3 AS VARCHAR) AS imei,
         CASE WHEN eventID = 3 OR (eventID IN (8, 26) AND issmsalone <> 1) THEN other ELSE own END AS callingimsi,
         CASE WHEN eventID = 3 OR (eventID IN (8, 26) AND issmsalone <> 1) THEN own ELSE other END AS calledimsi,
         20000 + cell * 37 AS lac_code, 1000 + cell * 911 AS ci_code,
         printf('%04X', 20000 + cell * 37) AS lac, printf('%04X', 1000 + cell * 911) AS ci
  FROM base),
lines AS (SELECT seq, {_LINE_SQL} AS value FROM s),
cells AS (
  SELECT n_nationkey + 25 * j AS cell, r_name AS region, 'Z' || CAST((n_nationkey + 25 * j) % 2 AS VARCHAR) AS zone,
         n_name AS nation, n_nationkey AS nation_id,
         CAST(CAST(20 + (n_nationkey + 25 * j) * 0.37 AS DECIMAL(8,2)) AS VARCHAR) AS geo_latitude,
         CAST(CAST(100 + (n_nationkey + 25 * j) * 0.53 AS DECIMAL(8,2)) AS VARCHAR) AS geo_longitude
  FROM nation JOIN region ON n_regionkey = r_regionkey CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS j)),
visits AS (
  SELECT seq, imsi, ts_ms, region AS area FROM s JOIN cells USING (cell)
  UNION ALL SELECT seq, imsi, ts_ms, zone FROM s JOIN cells USING (cell)),
profiles AS (SELECT {_SQL_ID.format('c_custkey')} AS imsi, c_name, c_mktsegment, c_nationkey FROM customer)
"""

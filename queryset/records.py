"""Ingestion, filters and the front door."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconflow.operators.rules import time_of_day_gate
from beaconflow.sources import signals as S
from queryset import query
from queryset.views import signal_lines, signals

VALIDITY = 15 * 24 * 3_600_000


def _now():
    return F.to_timestamp(F.lit("2024-01-20 00:00:00"))


_PARSED = """
, split AS (SELECT seq, value, string_split(regexp_replace(value, ',+$', ''), ',') AS f FROM lines),
num AS (
  SELECT seq, value, f, len(f) AS n,
         CASE WHEN regexp_full_match(f[1], '[+-]?[0-9]+') THEN TRY_CAST(f[1] AS INTEGER) END AS eventID,
         try_strptime(f[2], '%Y%m%d %H:%M:%S.%g') AS ts,
         CASE WHEN regexp_full_match(f[3], '[+-]?[0-9]+') THEN TRY_CAST(f[3] AS INTEGER) END AS lac_n,
         CASE WHEN regexp_full_match(f[4], '[+-]?[0-9]+') THEN TRY_CAST(f[4] AS INTEGER) END AS ci_n,
         list_transform(f[11:17], lambda x: CASE WHEN regexp_full_match(x, '[+-]?[0-9]+')
                                          THEN TRY_CAST(x AS INTEGER) END) AS st
  FROM split),
parsed AS (
  SELECT *, CASE WHEN eventID IN (3, 5, 7) THEN f[8]
                 WHEN eventID IN (8, 9, 10, 26) THEN CASE st[7] WHEN 1 THEN f[7] WHEN 2 THEN f[8] END
                 ELSE f[7] END AS imsi,
         CASE WHEN eventID IN (3, 5, 7) THEN f[6]
              WHEN eventID IN (8, 9, 10, 26) THEN CASE st[7] WHEN 1 THEN f[5] WHEN 2 THEN f[6] END
              ELSE f[5] END AS device
  FROM num),
judged AS (
  SELECT *, CASE WHEN n <> 17 THEN 'field_count'
                 WHEN f[7] = '000000000000000' AND f[8] = '000000000000000' THEN 'anonymous'
                 WHEN eventID IS NULL THEN 'bad_number'
                 WHEN ts IS NULL THEN 'bad_time'
                 WHEN epoch_us(ts) // 1000 + 1296000000 < epoch_ms(TIMESTAMP '2024-01-20 00:00:00') THEN 'expired'
                 WHEN lac_n IS NULL OR lac_n < 0 OR ci_n IS NULL OR ci_n < 0 THEN 'bad_cell'
                 WHEN list_count(st) < 7 THEN 'bad_number'
                 WHEN imsi IS NULL THEN 'no_subject' END AS reject_reason
  FROM parsed)
"""


@query("ingest_signals", _PARSED + """
SELECT seq, eventID, epoch_us(ts) // 1000 AS ts_ms, printf('%04X', lac_n) AS lac, printf('%04X', ci_n) AS ci,
       f[7] AS callingimsi, f[8] AS calledimsi, st[1] AS eventresult, st[7] AS issmsalone, imsi,
       substring(device, 1, 14) AS imei
FROM judged WHERE reject_reason IS NULL""")
def ingest_signals(spark, sf_dir):
    good, _ = S.ingest_signals(signal_lines(spark, sf_dir), validity_ms=VALIDITY, now=_now())
    return good.select(
        "seq", "eventID", F.unix_millis("ts").alias("ts_ms"), "lac", "ci", "callingimsi", "calledimsi",
        "eventresult", "issmsalone", "imsi", "imei",
    )


@query("ingest_rejects", _PARSED + "SELECT seq, value, reject_reason FROM judged WHERE reject_reason IS NOT NULL")
def ingest_rejects(spark, sf_dir):
    _, rejects = S.ingest_signals(signal_lines(spark, sf_dir), validity_ms=VALIDITY, now=_now())
    return rejects


@query("drop_anonymous", """
, split AS (SELECT seq, string_split(value, ',') AS f FROM lines)
SELECT seq, f[7] AS callingimsi, f[8] AS calledimsi FROM split
WHERE NOT (f[7] = '000000000000000' AND f[8] = '000000000000000')""")
def drop_anonymous(spark, sf_dir):
    f = F.split("value", ",")
    ids = signal_lines(spark, sf_dir).select("seq", f[6].alias("callingimsi"), f[7].alias("calledimsi"))
    return S.drop_anonymous(ids)


@query("within_validity", """
SELECT seq, ts_ms FROM s WHERE ts_ms + 1296000000 >= epoch_ms(TIMESTAMP '2024-01-20 00:00:00')""")
def within_validity(spark, sf_dir):
    return S.within_validity(signals(spark, sf_dir), VALIDITY, _now()).select("seq", "ts_ms")


@query("resolve_subject", """
, subjects AS (
  SELECT seq, eventID, CASE WHEN eventID IN (3, 5, 7) THEN calledimsi
              WHEN eventID IN (8, 9, 10, 26) THEN CASE issmsalone WHEN 1 THEN callingimsi WHEN 2 THEN calledimsi END
              ELSE callingimsi END AS imsi
  FROM s)
SELECT seq, eventID, imsi FROM subjects WHERE imsi IS NOT NULL""")
def resolve_subject(spark, sf_dir):
    s = signals(spark, sf_dir).withColumns({"callingimei": F.lit(""), "calledimei": F.col("imei")})
    return S.resolve_subject(s).select("seq", "eventID", "imsi")


@query("normalise_cell", """
SELECT seq, printf('%04X', lac_code - 19990) AS lac, printf('%04X', ci_code) AS ci,
       substring(repeat(imei, 9), 1, 14) AS calledimei FROM s""")
def normalise_cell(spark, sf_dir):
    s = signals(spark, sf_dir).selectExpr(
        "seq", "lac_code - 19990 as lac", "ci_code as ci", "repeat(imei, 9) as calledimei"
    )
    return S.normalise_cell(s)


@query("time_of_day_gate", """
SELECT seq, ts_ms FROM s
WHERE strftime(ts, '%H:%M:%S') > '08:00:00' AND strftime(ts, '%H:%M:%S') < '20:00:00'""")
def gate(spark, sf_dir):
    return time_of_day_gate(signals(spark, sf_dir), "08:00:00", "20:00:00").select("seq", "ts_ms")


@query("route_feed", """
, received AS (SELECT seq, value || ',2024-02-01 00:00:00:000' AS value FROM lines),
split AS (SELECT seq, value, list_transform(string_split(regexp_replace(value, ',+$', ''), ','), lambda x: trim(x)) AS f
          FROM received)
SELECT seq, value, CASE WHEN f[1] IN ('3', '5', '7') OR (f[15] = '2' AND f[1] IN ('8', '9', '10', '26'))
                        THEN f[8] ELSE f[7] END AS key
FROM split
WHERE len(f) >= 15 AND NOT (f[7] = '000000000000000' AND f[8] = '000000000000000')
  AND NOT (f[7] = '' AND f[8] = '')""")
def route_feed(spark, sf_dir):
    return S.route_feed(signal_lines(spark, sf_dir), received_at=F.lit("2024-02-01 00:00:00:000"))

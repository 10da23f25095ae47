"""Event rules, cooldown, correlation, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconflow.operators import aggregates as A
from beaconflow.operators import correlate as W
from beaconflow.operators import rules as P
from beaconflow.operators.cooldown import cooldown
from beaconflow.operators.lookups import label_site
from beaconflow.operators.skew import HotKeys
from beaconflow.operators.stay import dwell
from beaconflow.plans.labelling import with_labels
from beaconflow.sources.sinks import event_messages
from queryset import query
from queryset.labels import STAY, _stay_sql
from queryset.views import DAY, HOUR, signals, sites, table

#: All kinds of events are sources; each must have been active within this time.
CORRELATED = ["click", "error", "purchase", "signup", "view"]
ACTIVE = 20 * DAY


def labelled(spark, sf_dir):
    return with_labels(label_site(signals(spark, sf_dir), sites(spark, sf_dir)))


@query("event_rule", """
SELECT seq, imsi, cents FROM s JOIN cells USING (cell) WHERE region = 'ASIA' AND value > 20""")
def event_rule(spark, sf_dir):
    rule = "labels['area_onsite']['ASIA'] = 'true' and value > 20"
    return P.event_rule(labelled(spark, sf_dir), rule).select("seq", "imsi", "cents")


RULES = [
    P.EventRule("10", "labels['area_onsite']['ASIA'] = 'true'", "2"),
    P.EventRule("2", "value > 20", "-1"),
    P.EventRule("3", "event_type = 'view' or issmsalone = 1", "10"),
    P.EventRule("4", "labels['area_onsite']['Z1'] = 'true'"),
]


@query("event_rule_tree", """
, r AS (SELECT seq, value > 20 AS r2, region = 'ASIA' AS ra, event_type = 'view' OR issmsalone = 1 AS rv, zone = 'Z1' AS r4
        FROM s JOIN cells USING (cell))
SELECT seq, r2 AS rule_2, r2 AND ra AS rule_10, r2 AND ra AND rv AS rule_3, r4 AS rule_4 FROM r""")
def event_rule_flags(spark, sf_dir):
    out = P.event_rule_flags(labelled(spark, sf_dir), RULES)
    return out.select("seq", "rule_2", "rule_10", "rule_3", "rule_4")


@query("event_rule_frames", """
, r AS (SELECT seq, value > 20 AS r2, region = 'ASIA' AS ra, event_type = 'view' OR issmsalone = 1 AS rv, zone = 'Z1' AS r4
        FROM s JOIN cells USING (cell))
SELECT '2' AS rule, seq FROM r WHERE r2 UNION ALL SELECT '10', seq FROM r WHERE r2 AND ra
UNION ALL SELECT '3', seq FROM r WHERE r2 AND ra AND rv UNION ALL SELECT '4', seq FROM r WHERE r4""")
def event_rule_frames(spark, sf_dir):
    frames = P.event_rule_tree(labelled(spark, sf_dir), RULES)
    tagged = [df.select(F.lit(rule).alias("rule"), "seq") for rule, df in frames.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


@query("business_projection", """
SELECT imsi, strftime(ts, '%Y%m%d %H:%M:%S.%g') AS time, 'true' AS asia, coalesce(event_type, 'none') || '#' AS kind
FROM s JOIN cells USING (cell) WHERE region = 'ASIA'""")
def business_projection(spark, sf_dir):
    rows = P.event_rule(labelled(spark, sf_dir), "labels['area_onsite']['ASIA'] = 'true'")
    return P.business_projection(
        rows,
        "imsi, date_format(ts, 'yyyyMMdd HH:mm:ss.SSS') as time, labels['area_onsite']['ASIA'] as asia, "
        "concat(coalesce(event_type, 'none'), '#') as kind",
    )


def _greedy_sql(rows: str, interval: int) -> str:
    """Greedy rests over the CTE ``rows`` (imsi, ts_ms, seq): the fired rows as CTE ``fired``."""
    return f"""
, numbered AS (SELECT imsi, ts_ms, seq, row_number() OVER (PARTITION BY imsi ORDER BY ts_ms, seq) AS rn FROM {rows}),
fired AS (
  SELECT imsi, ts_ms, seq, rn FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.imsi, n.ts_ms, n.seq, n.rn
  FROM (SELECT a.imsi, min(b.rn) AS rn FROM fired a JOIN numbered b ON a.imsi = b.imsi AND b.ts_ms >= a.ts_ms + {interval}
        GROUP BY a.imsi) m
  JOIN numbered n ON n.imsi = m.imsi AND n.rn = m.rn)
"""


@query("cooldown", _greedy_sql("s", 3 * DAY) + "SELECT imsi, ts_ms, seq FROM fired")
def cooldown_query(spark, sf_dir):
    return cooldown(signals(spark, sf_dir).select("imsi", "ts_ms", "seq"), 3 * DAY)


_SEEN = ", ".join(f"max(CASE WHEN event_type = '{e}' THEN ts_ms END) OVER w AS last_{e}" for e in CORRELATED)
_ALIVE = " AND ".join(f"coalesce(last_{e} + {ACTIVE} >= ts_ms, FALSE)" for e in CORRELATED)
_CORRELATED_SQL = f"""
, seen AS (SELECT imsi, ts_ms, seq, {_SEEN}
         FROM s WINDOW w AS (PARTITION BY imsi ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING)),
complete AS (SELECT imsi, ts_ms, seq, {_ALIVE} AS now FROM seen),
opened AS (SELECT *, max(CASE WHEN now THEN 1 ELSE 0 END) OVER (PARTITION BY imsi ORDER BY ts_ms, seq
                  ROWS UNBOUNDED PRECEDING) AS open FROM complete),
locked AS (SELECT imsi, ts_ms, seq FROM opened WHERE open = 1)
""" + _greedy_sql("locked", 3 * DAY)


def _tagged(spark, sf_dir):
    s = signals(spark, sf_dir).select("imsi", "ts_ms", "seq", "event_type")
    return W.tag_sources({e: s.where(F.col("event_type") == e).drop("event_type") for e in CORRELATED})


@query("correlate_sources", _CORRELATED_SQL + """
SELECT f.imsi AS imsi, f.ts_ms AS ts_ms, f.seq AS seq FROM fired f
UNION ALL SELECT imsi, ts_ms, seq FROM opened WHERE open = 0""")
def correlate(spark, sf_dir):
    out = W.correlate_sources(_tagged(spark, sf_dir), CORRELATED, 3 * DAY, ACTIVE)
    return out.select("imsi", "ts_ms", "seq")


@query("correlate_require_all", _CORRELATED_SQL + "SELECT imsi, ts_ms, seq FROM fired")
def correlate_require_all(spark, sf_dir):
    out = W.correlate_sources(_tagged(spark, sf_dir), CORRELATED, 3 * DAY, ACTIVE, require_all=True)
    return out.select("imsi", "ts_ms", "seq")


@query("union_sources", "SELECT seq, event_type AS source FROM s")
def union_sources(spark, sf_dir):
    return _tagged(spark, sf_dir).select("seq", "source")


@query("last_active", """
SELECT issmsalone AS event, imsi, event_type AS source, max(ts_ms) AS last_active_ms FROM s GROUP BY ALL""")
def last_active(spark, sf_dir):
    s = signals(spark, sf_dir).selectExpr("issmsalone as event", "imsi", "event_type as source", "ts_ms")
    return W.last_active(s)


@query("duplicate_keys_in_batch", f"""
SELECT ts_ms // {DAY} AS batch, imsi, count(*) AS n FROM s GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    s = signals(spark, sf_dir).selectExpr(f"ts_ms div {DAY} as batch", "imsi")
    return W.duplicate_keys_in_batch(s, "batch", "imsi")


@query("co_locate_by_user", "SELECT seq, imsi FROM s")
def co_locate(spark, sf_dir):
    return W.co_locate_by_user(signals(spark, sf_dir).select("seq", "imsi"))


@query("throughput", f"""
SELECT ts_ms - ts_ms % {HOUR} AS interval_start_ms, count(*) AS n, round(count(*) * 1000.0 / {HOUR}, 6)::DOUBLE AS per_second
FROM s GROUP BY ALL""")
def throughput(spark, sf_dir):
    return A.throughput(signals(spark, sf_dir), HOUR)


@query("batch_counts", f"SELECT ts_ms // {HOUR} AS batch, count(*) AS n FROM s GROUP BY ALL")
def batch_counts(spark, sf_dir):
    return A.batch_counts(signals(spark, sf_dir).selectExpr(f"ts_ms div {HOUR} as batch"), "batch")


@query("running_count_by_key", """
SELECT imsi, arg_min(event_type, seq) AS first_value, count(*) AS n FROM s GROUP BY imsi""")
def running_count(spark, sf_dir):
    return A.running_count_by_key(signals(spark, sf_dir), "imsi", "event_type", "seq")


@query("accumulate_to_table", """
, stored AS (SELECT imsi, CAST(c_nationkey AS BIGINT) AS cents FROM profiles),
added AS (SELECT seq, imsi, sum(cents) OVER (PARTITION BY imsi ORDER BY seq ROWS UNBOUNDED PRECEDING) AS t FROM s)
SELECT seq, imsi, CAST(t + coalesce(stored.cents, 0) AS BIGINT) AS total_cents
FROM added LEFT JOIN stored USING (imsi)""")
def accumulate(spark, sf_dir):
    from queryset.views import profiles

    stored = profiles(spark, sf_dir).selectExpr("imsi", "cast(c_nationkey as bigint) as cents")
    rows = signals(spark, sf_dir).select("seq", "imsi", "cents")
    return A.accumulate_to_table(rows, "imsi", "seq", ["cents"], stored).select("seq", "imsi", "total_cents")


@query("stored_totals", """
SELECT imsi, CAST(sum(cents) AS BIGINT) AS cents FROM
(SELECT imsi, cents FROM s UNION ALL SELECT imsi, CAST(c_nationkey AS BIGINT) FROM profiles) GROUP BY imsi""")
def stored_totals(spark, sf_dir):
    from queryset.views import profiles

    stored = profiles(spark, sf_dir).selectExpr("imsi", "cast(c_nationkey as bigint) as cents")
    return A.stored_totals(signals(spark, sf_dir), "imsi", ["cents"], stored)


@query("load_audit", """
SELECT count(*) AS num_total, count(*) AS num_scanned, count(*) FILTER (o_orderstatus IN ('F', 'O')) AS num_processed,
       count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS num_unknown,
       CAST(ceil(count(*) FILTER (o_orderstatus IN ('F', 'O')) / 30) AS BIGINT) AS num_batches,
       round(count(*) FILTER (o_orderstatus IN ('F', 'O')) * 100.0::DOUBLE / count(*), 4) AS percent_processed,
       CAST(60000 AS BIGINT) AS elapsed_ms,
       round(count(*) FILTER (o_orderstatus IN ('F', 'O')) * 1000.0::DOUBLE / 60000, 4) AS rows_per_second
FROM orders""")
def load_audit(spark, sf_dir):
    return A.load_audit(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"], 30, 60_000)


@query("publish_events", """
SELECT imsi AS key, imsi || '|' || strftime(ts, '%Y%m%d %H:%M:%S.%g') || '|' ||
       CASE WHEN event_type = 'error' THEN '' ELSE event_type END || ',20240201 00:00:00.000' AS value FROM s""")
def publish(spark, sf_dir):
    rows = signals(spark, sf_dir).selectExpr(
        "imsi", "date_format(ts, 'yyyyMMdd HH:mm:ss.SSS') as time", "nullif(event_type, 'error') as kind"
    )
    sent = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    return event_messages(rows, ["imsi", "time", "kind"], "imsi", "|", sent)


def stay_event_messages(spark, sf_dir):
    """Records -> areas -> stay in ASIA -> projection -> one per user and three days -> messages."""
    slim = signals(spark, sf_dir).select("seq", "imsi", "ts", "ts_ms", "lac", "ci")
    hot = HotKeys(slim, "imsi")
    flagged = label_site(slim, sites(spark, sf_dir))
    # The rule only looks at one area, so only its visits need a stay.
    asia = flagged.where("area_onsite['ASIA'] = 'true'").withColumn("area", F.lit("ASIA"))
    staying = P.event_rule(dwell(asia, STAY, skew=hot), "stay > 0")
    projected = P.business_projection(
        staying, ["imsi", "date_format(ts, 'yyyyMMdd HH:mm:ss.SSS') as time", "stay", "ts_ms", "seq"]
    )
    fired = cooldown(projected, 3 * DAY, skew=hot)
    return event_messages(fired, ["imsi", "time", "stay"], "imsi", ",", F.to_timestamp(F.lit("2024-02-01 00:00:00")))


query(
    "stay_event_messages",
    _stay_sql("list_max(m)")
    + ", hits AS (SELECT s.imsi AS imsi, s.ts_ms AS ts_ms, s.seq AS seq, s.ts AS ts, stay FROM stays "
    "JOIN s ON s.seq = stays.seq WHERE area = 'ASIA' AND stay > 0)"
    + _greedy_sql("hits", 3 * DAY)
    + """SELECT h.imsi AS key, h.imsi || ',' || strftime(h.ts, '%Y%m%d %H:%M:%S.%g') || ',' || CAST(h.stay AS VARCHAR)
       || ',20240201 00:00:00.000' AS value FROM fired f JOIN hits h ON h.seq = f.seq""",
)(stay_event_messages)

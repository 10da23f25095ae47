"""Lookup labels, stays, devices and movement."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconflow.operators import lookups as J
from beaconflow.operators.skew import HotKeys, lookup_join
from beaconflow.operators.stay import StayConfig, dwell, last_activity
from beaconflow.operators.track import last_device, movement
from queryset import query
from queryset.views import HOUR, cells, profiles, signals, sites, table

STAY = StayConfig((12 * HOUR, 24 * HOUR, 48 * HOUR), timeout_ms=48 * HOUR)


@query("label_site", """
SELECT seq, lac || ci AS lac_ci, nation, region || ',' || zone AS areas FROM s JOIN cells USING (cell)""")
def label_site(spark, sf_dir):
    out = J.label_site(signals(spark, sf_dir), sites(spark, sf_dir))
    return out.select(
        "seq",
        F.col("area_info")["lac_ci"].alias("lac_ci"),
        F.col("area_info")["nation"].alias("nation"),
        F.array_join(F.array_sort(F.map_keys("area_onsite")), ",").alias("areas"),
    )


@query("label_profile", """
, ids AS (SELECT *, callingimsi <> '000000000000000' AND calledimsi <> '000000000000000' AND callingimsi <> calledimsi
                 AS two FROM s),
o AS (SELECT *, CASE WHEN two THEN CASE WHEN imsi = callingimsi THEN calledimsi ELSE callingimsi END END AS party FROM ids)
SELECT seq, p.c_name AS c_name, p.c_mktsegment AS c_mktsegment,
       CASE WHEN o.party = calledimsi THEN q.c_name END AS called_c_name,
       CASE WHEN o.party = callingimsi THEN q.c_name END AS calling_c_name,
       CASE WHEN o.party = calledimsi THEN q.c_mktsegment END AS called_c_mktsegment
FROM o LEFT JOIN profiles p ON p.imsi = o.imsi LEFT JOIN profiles q ON q.imsi = o.party""")
def label_profile(spark, sf_dir):
    out = J.label_profile(signals(spark, sf_dir), profiles(spark, sf_dir), ["c_name", "c_mktsegment"])
    names = ["c_name", "c_mktsegment", "called_c_name", "calling_c_name", "called_c_mktsegment"]
    return out.select("seq", *[F.col("user_info")[n].alias(n) for n in names])


def _with_unknown_cells(records):
    return records.withColumn("lac", F.expr("if(seq % 11 = 0, 'FFFF', lac)"))


@query("label_geo", """
SELECT seq, coalesce(geo_latitude, '0') AS geo_latitude, coalesce(geo_longitude, '0') AS geo_longitude
FROM s LEFT JOIN cells ON cells.cell = s.cell AND seq % 11 <> 0""")
def label_geo(spark, sf_dir):
    """The whole lookup; some records come from cells that it does not have."""
    return J.label_geo(_with_unknown_cells(signals(spark, sf_dir)), cells(spark, sf_dir)).select("seq", "geo_latitude", "geo_longitude")


@query("large_lookup", """
SELECT seq, c_name FROM s LEFT JOIN profiles ON profiles.imsi =
  CASE WHEN calledimsi <> '000000000000000' THEN calledimsi END""")
def large_lookup(spark, sf_dir):
    """The shuffled, salted form of the lookup join, as used for sides too large to broadcast."""
    s = signals(spark, sf_dir).selectExpr("seq", "nullif(calledimsi, '000000000000000') as imsi")
    return lookup_join(s, profiles(spark, sf_dir).select("imsi", "c_name"), "imsi", small=False).drop("imsi")


@query("needed_keys", """
SELECT imsi, c_name FROM profiles
WHERE imsi IN (SELECT callingimsi FROM s UNION SELECT calledimsi FROM s)""")
def needed_keys(spark, sf_dir):
    s = signals(spark, sf_dir)
    return J.needed_keys(
        s, [F.col("callingimsi"), F.col("calledimsi")], profiles(spark, sf_dir).select("imsi", "c_name"), "imsi"
    )


@query("enrich_and_filter", """
SELECT seq, s.imsi AS imsi, nation AS cell__nation, c_mktsegment AS who__c_mktsegment
FROM s JOIN cells USING (cell) JOIN profiles p ON p.imsi = s.imsi
WHERE seq % 11 <> 0 AND c_nationkey <> nation_id AND (c_mktsegment = 'BUILDING' OR c_mktsegment = 'FURNITURE')""")
def enrich_and_filter(spark, sf_dir):
    steps = [
        J.LookupStep(
            "cell", cells(spark, sf_dir), {"lac": "lac", "ci": "ci"}, ["nation", "nation_id"], "cell__nation is not null",
            ["seq", "imsi", "cell__nation", "cell__nation_id"],
        ),
        J.LookupStep(
            "who", profiles(spark, sf_dir), {"imsi": "imsi"}, ["c_mktsegment", "c_nationkey"],
            "who__c_nationkey <> cell__nation_id"
            " and (who__c_mktsegment = 'BUILDING' or who__c_mktsegment = 'FURNITURE')",
            ["seq", "imsi", "cell__nation", "who__c_mktsegment"],
        ),
    ]
    return J.enrich_and_filter(_with_unknown_cells(signals(spark, sf_dir)), steps)


@query("not_yet_processed", """
, seen AS (SELECT DISTINCT own AS imsi FROM base WHERE event_type = 'signup' AND value > 150),
fresh AS (SELECT *, row_number() OVER (PARTITION BY imsi ORDER BY seq) AS rn FROM s
          WHERE imsi NOT IN (SELECT imsi FROM seen))
SELECT seq, imsi FROM fresh WHERE rn = 1""")
def not_yet_processed(spark, sf_dir):
    s = signals(spark, sf_dir).select("seq", "imsi", "event_type", "value")
    processed = s.where("event_type = 'signup' and value > 150").select("imsi")
    fresh, _ = J.not_yet_processed(s.select("seq", "imsi"), processed, "imsi", "seq")
    return fresh


@query("processed_users", """
SELECT DISTINCT imsi FROM s""")
def processed_users(spark, sf_dir):
    s = signals(spark, sf_dir).select("seq", "imsi", "event_type", "value")
    processed = s.where("event_type = 'signup' and value > 150").select("imsi").distinct()
    return J.not_yet_processed(s.select("seq", "imsi"), processed, "imsi", "seq")[1]


@query("data_driven_filter", """
SELECT seq, event_type, cents FROM s WHERE value > 10 * length(event_type)""")
def data_driven_filter(spark, sf_dir):
    s = signals(spark, sf_dir).select("seq", "event_type", "cents", "value")
    rules = s.select("event_type").distinct().selectExpr(
        "event_type", "concat('value > ', 10 * length(event_type)) as condition"
    )
    return J.data_driven_filter(s, rules, "event_type", "condition").drop("value")


@query("data_driven_filter_by_user", """
, own AS (SELECT imsi, CAST(floor(avg(cents)) AS BIGINT) AS middle, max(event_type) AS last_type FROM s GROUP BY imsi)
SELECT s.seq, s.imsi, s.cents FROM s JOIN own ON s.imsi = own.imsi
WHERE (s.cents BETWEEN own.middle AND own.middle + 5000 AND s.event_type <> own.last_type) OR s.event_type IN ('signup', own.last_type)""")
def data_driven_filter_by_user(spark, sf_dir):
    s = signals(spark, sf_dir).select("seq", "imsi", "event_type", "cents")
    own = s.groupBy("imsi").agg(F.floor(F.avg("cents")).alias("middle"), F.max("event_type").alias("last"))
    text = "format_string('cents between %d and %d and event_type <> ''%s'' or event_type in (''signup'', ''%s'')', middle, middle + 5000, last, last)"
    return J.data_driven_filter(s, own.selectExpr("imsi", f"{text} as condition"), "imsi", "condition").drop("event_type")


def visits(spark, sf_dir):
    labelled = J.label_site(
        signals(spark, sf_dir).select("seq", "imsi", "ts_ms", "lac", "ci"), sites(spark, sf_dir)
    )
    return labelled.select("seq", "imsi", "ts_ms", F.explode(F.map_keys("area_onsite")).alias("area"))


def _stay_sql(label: str, extra: str = "") -> str:
    h = HOUR
    return f"""
, lagged AS (SELECT *, lag(ts_ms) OVER (PARTITION BY imsi, area ORDER BY ts_ms, seq) AS prev FROM visits),
marked AS (SELECT *, prev IS NULL OR ts_ms - prev > {48 * h} AS brk FROM lagged),
started AS (SELECT *, max(CASE WHEN brk THEN ts_ms END) OVER (PARTITION BY imsi, area ORDER BY ts_ms, seq) AS st
            FROM marked),
crossed AS (SELECT *, ts_ms - st AS new_stay,
                   list_filter([{12 * h}, {24 * h}, {48 * h}], lambda x: x >= prev - st AND x <= ts_ms - st) AS m
            FROM started),
stays AS (SELECT seq, imsi, area, st, new_stay, CASE WHEN brk OR prev = ts_ms OR len(m) = 0 THEN 0 ELSE {label} END AS stay
          FROM crossed){extra}
"""


def _dwell(config):
    def run(spark, sf_dir):
        out = dwell(visits(spark, sf_dir), config, skew=HotKeys(signals(spark, sf_dir), "imsi"))
        return out.select("seq", "imsi", "area", "stay")

    return run


query("dwell", _stay_sql("list_max(m)") + "SELECT seq, imsi, area, CAST(stay AS BIGINT) AS stay FROM stays")(_dwell(STAY))
query(
    "dwell_min_threshold",
    _stay_sql("list_min(m)") + "SELECT seq, imsi, area, CAST(stay AS BIGINT) AS stay FROM stays",
)(_dwell(StayConfig(STAY.limits, match_max=False, timeout_ms=STAY.timeout_ms)))
query(
    "dwell_actual",
    _stay_sql("new_stay") + "SELECT seq, imsi, area, CAST(stay AS BIGINT) AS stay FROM stays",
)(_dwell(StayConfig(STAY.limits, output_threshold=False, timeout_ms=STAY.timeout_ms)))


@query(
    "dwell_session_starts",
    _stay_sql("list_max(m)") + "SELECT seq, area, st AS stay_start, new_stay AS stay_ms FROM stays",
)
def dwell_session_starts(spark, sf_dir):
    return dwell(visits(spark, sf_dir), STAY, skew=HotKeys(signals(spark, sf_dir), "imsi")).select("seq", "area", "stay_start", "stay_ms")


@query("last_activity", "SELECT imsi, max(ts_ms) AS last_activity_ms FROM visits GROUP BY imsi")
def last_activity_query(spark, sf_dir):
    return last_activity(visits(spark, sf_dir))


@query("last_device", """
SELECT seq, imsi, coalesce(lag(imei) OVER (PARTITION BY imsi ORDER BY ts_ms, seq), '') AS last_imei FROM s""")
def last_device_query(spark, sf_dir):
    s = signals(spark, sf_dir).select("seq", "imsi", "ts_ms", "imei")
    return last_device(s).select("seq", "imsi", "last_imei")


MOVEMENT_SQL = """
, p AS (
  SELECT seq, imsi, ts_ms, lac || ci AS cell_id, CAST(geo_latitude AS DOUBLE) AS lat, CAST(geo_longitude AS DOUBLE) AS lng
  FROM s JOIN cells USING (cell)),
q AS (SELECT *, lag(lat) OVER w AS lat0, lag(lng) OVER w AS lng0, lag(ts_ms) OVER w AS ts0, lag(cell_id) OVER w AS last_lac_ci
      FROM p WINDOW w AS (PARTITION BY imsi ORDER BY ts_ms, seq)),
d AS (SELECT *, CASE WHEN lat0 IS NOT NULL THEN round(asin(sqrt(least(power(sin((radians(lat0) - radians(lat)) / 2), 2)
                + cos(radians(lat0)) * cos(radians(lat)) * power(sin((radians(lng0) - radians(lng)) / 2), 2), 1.0)))
                * 2 * 6378.137, 4) END AS distance_km, ts_ms - ts0 AS elapsed_ms FROM q)
SELECT seq, imsi, distance_km, elapsed_ms, last_lac_ci,
       round(distance_km * 3600000 / nullif(elapsed_ms, 0), 3) AS speed_kmh
FROM d"""


@query("movement", MOVEMENT_SQL)
def movement_query(spark, sf_dir):
    s = signals(spark, sf_dir).select("seq", "imsi", "ts_ms", "lac", "ci")
    placed = J.label_geo(s, cells(spark, sf_dir)).withColumn("lac_ci", F.concat("lac", "ci"))
    return movement(placed, skew=HotKeys(s, "imsi")).select(
        "seq", "imsi", "distance_km", "elapsed_ms", "last_lac_ci", F.round("speed_kmh", 3).alias("speed_kmh")
    )

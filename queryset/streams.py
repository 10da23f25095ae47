"""Streaming forms over the event table, archives and sources read as streams."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from beaconflow.operators.bucketed import BucketedTable
from beaconflow.operators.correlate import tag_sources
from beaconflow.operators.late import dwell_by_arrival
from beaconflow.operators.lookups import label_geo, label_site
from beaconflow.operators.registers import current
from beaconflow.operators.rules import EventRule
from beaconflow.plans.application import Application, SourcePlan, build_application
from beaconflow.plans.catalogue import rule_catalogue
from beaconflow.plans.labelling import GeoLabels, LabelPlan, ProfileLabels, SiteLabels
from beaconflow.plans.plugins import BusinessEvent
from beaconflow.session import new_shared_path
from beaconflow.sources import sinks
from beaconflow.sources.rolling import RollingArchive
from beaconflow.sources.signals import ingest_signals
from beaconflow.sources.streams import open_stream
from beaconflow.streaming import events as E
from beaconflow.streaming import runner as R
from beaconflow.streaming.labels import UserLabels, label_users
from beaconflow.streaming.once import once_per_key, processed_keys
from beaconflow.streaming import tables as S
from beaconflow.streaming.refresh import RefreshingLookup
from queryset import ORACLES, query
from queryset.events import ACTIVE, CORRELATED, _greedy_sql
from queryset.labels import MOVEMENT_SQL, STAY, _stay_sql
from queryset.records import _PARSED, VALIDITY, _now
from queryset.tables import RUNS, order_changes, order_feed, store_state
from queryset.views import (
    DAY, FILE_ROWS, HOUR, SQL_VIEWS, arriving, as_lines, as_signals, cells, profiles, signal_lines, signal_stream, signals, sites, table,
)


def _body(name: str) -> str:
    return ORACLES[name].removeprefix(SQL_VIEWS)


@query("dwell_stream", _stay_sql("list_max(m)") + "SELECT seq, imsi, area, CAST(stay AS BIGINT) AS stay FROM stays")
def dwell_stream(spark, sf_dir):
    records = signal_stream(spark, sf_dir).select("seq", "imsi", "ts_ms", "lac", "ci")
    labelled = label_users(label_site(records, sites(spark, sf_dir)), UserLabels(stay=STAY))
    out = R.run_to_table(labelled.select("seq", "imsi", "area_onsite_stay"), "dwell")
    return out.select("seq", "imsi", F.explode("area_onsite_stay").alias("area", "stay")).withColumn(
        "stay", F.col("stay").cast("long")
    )


@query("last_device_stream", _body("last_device"))
def last_device_stream(spark, sf_dir):
    records = signal_stream(spark, sf_dir).select("seq", "imsi", "ts_ms", "imei")
    out = label_users(records, UserLabels(device=True)).select("seq", "imsi", "last_imei")
    return R.run_to_table(out, "last-device").drop("batch")


@query("movement_stream", MOVEMENT_SQL)
def movement_stream(spark, sf_dir):
    records = signal_stream(spark, sf_dir).select("seq", "imsi", "ts_ms", "lac", "ci")
    placed = label_geo(records, cells(spark, sf_dir)).withColumn("lac_ci", F.concat("lac", "ci"))
    out = label_users(placed, UserLabels(movement=True)).select(
        "seq", "imsi", "distance_km", "elapsed_ms", "last_lac_ci", F.round("speed_kmh", 3).alias("speed_kmh")
    )
    return R.run_to_table(out, "movement").drop("batch")


@query("cooldown_stream", _body("cooldown"))
def cooldown_stream(spark, sf_dir):
    """One large micro-batch, as after an interruption; the next query has several."""
    rows = signal_stream(spark, sf_dir, 1).select("imsi", "ts_ms", "seq")
    return R.run_to_table(E.cooldown_stream(rows, 3 * DAY), "cooldown").drop("batch")


@query("cooldown_stream_batches", _body("cooldown"))
def cooldown_stream_batches(spark, sf_dir):
    rows = signal_stream(spark, sf_dir).select("imsi", "ts_ms", "seq")
    return R.run_to_table(E.cooldown_stream(rows, 3 * DAY), "cooldown").drop("batch")


def _tagged_stream(spark, sf_dir):
    s = signal_stream(spark, sf_dir).select("imsi", "ts_ms", "seq", "event_type")
    return tag_sources({e: s.where(F.col("event_type") == e).drop("event_type") for e in CORRELATED})


@query("correlate_stream", _body("correlate_sources"))
def correlate_stream(spark, sf_dir):
    fired = E.correlate_stream(_tagged_stream(spark, sf_dir), CORRELATED, 3 * DAY, ACTIVE)
    return R.run_to_table(fired.select("imsi", "ts_ms", "seq"), "correlate").drop("batch")


@query("correlate_require_all_stream", _body("correlate_require_all"))
def correlate_require_all_stream(spark, sf_dir):
    fired = E.correlate_stream(_tagged_stream(spark, sf_dir), CORRELATED, 3 * DAY, ACTIVE, require_all=True)
    return R.run_to_table(fired.select("imsi", "ts_ms", "seq"), "correlate").drop("batch")


@query("last_active_stream", _body("last_active"))
def last_active_stream(spark, sf_dir):
    s = signal_stream(spark, sf_dir).selectExpr("issmsalone as event", "imsi", "event_type as source", "ts_ms")
    updates = R.run_to_table(E.last_active_stream(s), "last-active", "update")
    return R.latest_per_key(updates, ["event", "imsi", "source"])


@query("running_count_stream", _body("running_count_by_key"))
def running_count_stream(spark, sf_dir):
    s = signal_stream(spark, sf_dir)
    updates = R.run_to_table(E.running_count_stream(s, "imsi", "event_type", "seq"), "running-count", "update")
    return R.latest_per_key(updates, ["imsi"])


@query("throughput_stream", _body("throughput"))
def throughput_stream(spark, sf_dir):
    from beaconflow.operators.aggregates import throughput

    updates = R.run_to_table(throughput(signal_stream(spark, sf_dir), HOUR), "throughput", "update")
    return R.latest_per_key(updates, ["interval_start_ms"])


LABELS = LabelPlan(
    [SiteLabels(), ProfileLabels(("c_name", "c_mktsegment")), GeoLabels()], stay=STAY, device=True, movement=True
)


def _lookups(spark, sf_dir):
    named = cells(spark, sf_dir).select("lac", "ci", "areas", "nation", "geo_latitude", "geo_longitude")
    return {"sites": named, "profiles": profiles(spark, sf_dir)}


def _label_columns(records):
    picked = {
        "customer": F.col("labels")["user_info"]["c_name"],
        "called": F.col("labels")["user_info"]["called_c_name"],
        "nation": F.col("labels")["area_info"]["nation"],
        "asia": F.col("labels")["area_onsite"]["ASIA"],
        "asia_stay": F.col("labels")["area_onsite_stay"]["ASIA"],
        "z1_stay": F.col("labels")["area_onsite_stay"]["Z1"],
        "last_imei": F.col("labels")["ext_last_imei"]["imei"],
        "last_cell": F.col("labels")["ext_usertrack"]["last_lac_ci"],
    }
    return records.select("seq", "imsi", *[c.alias(n) for n, c in picked.items()])


_PIPELINE = _stay_sql("list_max(m)") + """
, w AS (SELECT seq, max(stay) FILTER (area = 'ASIA') AS asia_stay, max(stay) FILTER (area = 'Z1') AS z1_stay
        FROM stays GROUP BY seq),
r AS (SELECT s.*, region, nation, lag(imei) OVER v AS li, lag(lac || ci) OVER v AS lc,
             CASE WHEN callingimsi <> '000000000000000' AND calledimsi <> '000000000000000' AND callingimsi <> calledimsi
                       AND imsi = callingimsi THEN calledimsi END AS party
      FROM s JOIN cells USING (cell) WINDOW v AS (PARTITION BY imsi ORDER BY ts_ms, seq))
SELECT r.seq AS seq, r.imsi AS imsi, p.c_name AS customer, q.c_name AS called, nation,
       CASE WHEN region = 'ASIA' THEN 'true' END AS asia, CAST(asia_stay AS VARCHAR) AS asia_stay,
       CAST(z1_stay AS VARCHAR) AS z1_stay, coalesce(li, '') AS last_imei, lc AS last_cell
FROM r JOIN w USING (seq) LEFT JOIN profiles p ON p.imsi = r.imsi LEFT JOIN profiles q ON q.imsi = r.party"""


@query("label_pipeline", _PIPELINE)
def label_pipeline(spark, sf_dir):
    records = signals(spark, sf_dir).select("seq", "imsi", "imei", "ts_ms", "lac", "ci", "callingimsi", "calledimsi")
    return _label_columns(LABELS.label(records, _lookups(spark, sf_dir)))


@query("label_pipeline_stream", _PIPELINE)
def label_pipeline_stream(spark, sf_dir):
    records = signal_stream(spark, sf_dir).select(
        "seq", "imsi", "imei", "ts_ms", "lac", "ci", "callingimsi", "calledimsi"
    )
    labelled = LABELS.label_stream(records, _lookups(spark, sf_dir))
    return R.run_to_table(_label_columns(labelled), "labels").drop("batch")


@query("refreshing_lookup", """
SELECT seq, c_name || '#' || CAST(seq % 3 AS VARCHAR) AS c_name FROM s JOIN profiles USING (imsi)""")
def refreshing_lookup(spark, sf_dir):
    """The profiles change between the micro-batches, one for each ``seq % 3``; the name shows which copy was joined."""
    from beaconflow.operators.skew import lookup_join

    path = new_shared_path(spark, "refreshing")
    events = table(spark, sf_dir, "events")
    files = max(1, -(-events.count() // (3 * FILE_ROWS)))
    for i in range(3):
        events.where(F.pmod("event_id", F.lit(3)) == i).repartition(files).write.mode("append").parquet(f"{path}/in")
    arriving_ = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/in")

    def load():
        version = F.lit(f"#{lookup.versions}")
        return profiles(spark, sf_dir).select("imsi", F.concat("c_name", version).alias("c_name"))

    lookup = RefreshingLookup(load, ttl_seconds=0)

    def enrich(batch, batch_id):
        joined = lookup_join(batch, lookup.current(), "imsi", "inner").select("seq", "c_name")
        R.write_batches_to(f"{path}/out")(joined, batch_id)

    R.start_batches(as_signals(arriving_).select("seq", "imsi"), enrich, f"{path}/checkpoint").awaitTermination()
    lookup.close()
    return spark.read.parquet(f"{path}/out").drop("batch")


def _text_parts(spark, sf_dir, parts):
    """The feed as files written one part after the other, and how many files a micro-batch takes so that each part is one."""
    path = new_shared_path(spark, "feed")
    lines = signal_lines(spark, sf_dir)
    files = max(1, -(-table(spark, sf_dir, "events").count() // (parts * FILE_ROWS)))
    for i in range(parts):
        own = lines.where(F.pmod("seq", F.lit(parts)) == i).select("value")
        own.repartition(files).write.mode("append").text(path)
    return {"path": path, "maxFilesPerTrigger": str(files)}


def _text_times(spark, sf_dir, parts):
    """The feed as files in the order of time, one range after the other."""
    path = new_shared_path(spark, "feed")
    files = 1
    for rows, files in arriving(signals(spark, sf_dir), "ts_ms", parts):
        own = as_lines(rows.repartitionByRange(files, "ts_ms", "seq").sortWithinPartitions("ts_ms", "seq"))
        own.select("value").write.mode("append").text(path)
    return {"path": path, "maxFilesPerTrigger": str(files)}


def _text_files(spark, sf_dir):
    path = new_shared_path(spark, "feed")
    signal_lines(spark, sf_dir).select("value").write.text(path)
    return path


@query("stream_source", "SELECT value FROM lines")
def stream_source(spark, sf_dir):
    lines = open_stream(spark, "hdfs", {"path": _text_files(spark, sf_dir), "maxFilesPerTrigger": "4"})
    return R.run_to_table(lines.select("value"), "stream-source").drop("batch")


@query("ingest_stream", _PARSED + """
SELECT eventID, epoch_us(ts) // 1000 AS ts_ms, printf('%04X', lac_n) AS lac, imsi FROM judged WHERE reject_reason IS NULL""")
def ingest_stream(spark, sf_dir):
    lines = open_stream(spark, "hdfs", {"path": _text_files(spark, sf_dir)})
    good, _ = ingest_signals(lines, validity_ms=VALIDITY, now=_now())
    out = good.select("eventID", F.unix_millis("ts").alias("ts_ms"), "lac", "imsi")
    return R.run_to_table(out, "ingest").drop("batch")


@query("batch_counts_stream", "SELECT seq % 5 AS batch, count(*) AS n FROM lines GROUP BY ALL")
def batch_counts_stream(spark, sf_dir):
    lines = open_stream(spark, "hdfs", _text_parts(spark, sf_dir, 5))
    path = new_shared_path(spark, "batch-counts")
    run = R.start_batches(lines, R.counting(R.write_batches_to(f"{path}/out"), f"{path}/sizes"), f"{path}/checkpoint")
    run.awaitTermination()
    return R.batch_sizes(spark, f"{path}/sizes")


@query("archive_topic", """
SELECT 'feed-' || strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') || '.log' AS archive, lines.value AS value
FROM lines JOIN s USING (seq)""")
def archive_topic(spark, sf_dir):
    """Lines archived under the day they arrived on."""
    path = new_shared_path(spark, "archive")
    lines = signal_lines(spark, sf_dir).join(signals(spark, sf_dir).select("seq", "ts"), "seq")
    sinks.archive_batch(lines, path, F.date_trunc("day", "ts"), "feed-", ".log")
    return spark.read.schema("value string, archive string").text(path)


@query("archive_topic_stream", "SELECT value FROM lines")
def archive_topic_stream(spark, sf_dir):
    lines = open_stream(spark, "hdfs", {"path": _text_files(spark, sf_dir), "maxFilesPerTrigger": "4"})
    path = new_shared_path(spark, "archive-stream")
    writer = sinks.archive_stream(lines, f"{path}/out", f"{path}/checkpoint", "feed-", ".log")
    R.with_trigger(writer, None).start().awaitTermination()
    return spark.read.text(f"{path}/out").select("value")


@query("archive_matching", """
, kept AS (SELECT doc_id, text FROM documents WHERE contains(text, 'license'))
SELECT (SELECT count(*) FROM kept) AS matched, (SELECT count(*) FROM kept) AS archived,
       (SELECT CAST(sum(length(text)) AS BIGINT) FROM kept) AS chars""")
def archive_matching(spark, sf_dir):
    """Documents containing a word are archived; matches are counted on the way."""
    docs = table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    kept, count = sinks.matching_lines(docs, "license")
    path = new_shared_path(spark, "matching")
    kept.write.parquet(path)
    archived = spark.read.parquet(path)
    return archived.agg(
        F.lit(count.get["matched"]).cast("long").alias("matched"),
        F.count(F.lit(1)).alias("archived"),
        F.sum(F.length("value")).alias("chars"),
    )


def _application(conf=None):
    rules = [
        EventRule("1", "labels['area_onsite']['ASIA'] = 'true'"),
        EventRule("2", "cast(labels['area_onsite_stay']['ASIA'] as bigint) > 0", "1"),
    ]
    event = BusinessEvent(
        "stay", {"feed": "2"}, ["imsi", "time", "labels['area_onsite_stay']['ASIA'] as stay", "ts_ms", "seq"],
        interval_ms=3 * DAY, topic="out", message_columns=["imsi", "time", "stay"],
    )
    source = SourcePlan("feed", "hdfs", conf or {}, labels=LabelPlan([SiteLabels()], stay=STAY), rules=rules)
    return Application([source], [event])


_APPLICATION = (
    _PARSED
    + """
, records AS (SELECT j.seq AS seq, j.imsi AS imsi, epoch_us(j.ts) // 1000 AS ts_ms, f[2] AS time, region
              FROM judged j JOIN cells ON lac_n = 20000 + cell * 37
              WHERE reject_reason IS NULL OR reject_reason = 'expired'
                AND list_count(st) = 7 AND j.imsi IS NOT NULL AND lac_n >= 0),
gvisits AS (SELECT seq, imsi, ts_ms, region AS area FROM records)
"""
    + _stay_sql("list_max(m)").replace("FROM visits)", "FROM gvisits)")
    + """, hits AS (SELECT r.imsi AS imsi, r.ts_ms AS ts_ms, r.seq AS seq, time, stay FROM stays JOIN records r USING (seq)
                   WHERE area = 'ASIA' AND stay > 0)"""
    + _greedy_sql("hits", 3 * DAY)
    + """SELECT h.imsi AS key, h.imsi || ',' || time || ',' || CAST(stay AS VARCHAR) || ',20240201 00:00:00.000' AS value
       FROM fired f2 JOIN hits h ON h.seq = f2.seq"""
)


def _sent():
    return F.to_timestamp(F.lit("2024-02-01 00:00:00"))


@query("application", _APPLICATION)
def application(spark, sf_dir):
    """Lines -> records -> labels -> rules -> business event -> messages."""
    app = _application()
    fired = app.fired({"feed": signal_lines(spark, sf_dir)}, _lookups(spark, sf_dir))
    return app.business_events[0].messages(fired["stay"], _sent())


def _administration(spark):
    """The application above as rows of the administration tables; switched-off rows must not take part."""
    limits = ",".join(str(x) for x in STAY.ordered_limits)
    props = [
        ("selectExp", "imsi,time,labels['area_onsite_stay']['ASIA']"), ("delim", ","), ("outputtype", "kafka"), ("kafkakeycol", "0"),
        ("output_topic", "out"), ("interval", str(3 * DAY)), ("userKeyIdx", "0"),
    ]
    rows = {
        "EventSource": ([(1, "feed", "hdfs", ",", 17, "feed-parser", 1, -1), (2, "off", "hdfs", ",", 17, "feed-parser", 0, -1)],
                        "id int, name string, type string, delim string, formatlength int, classname string, enabled int, validWindowsTimeMs int"),
        "EventSourceProp": ([("path", "feed/", 1)], "name string, pvalue string, esourceid int"),
        "LabelRules": ([(2, 1, "stay-rule", 1), (1, 1, "site-rule", 1), (3, 1, "device-rule", 0)],
                       "id int, esourceid int, classname string, enabled int"),
        "LabelRulesProp": ([("stay.limits", limits, 2), ("stay.timeout", str(STAY.timeout_ms), 2)], "name string, pvalue string, lrid int"),
        "EventRules": ([(1, 1, "rule", 1, -1), (2, 1, "rule", 1, 1), (3, 1, "rule", 0, -1)],
                       "id int, esourceid int, classname string, enabled int, parentEventRuleId int"),
        "EventRulesProp": ([("filterExp", "labels['area_onsite']['ASIA'] = 'true'", 1),
                            ("filterExp", "cast(labels['area_onsite_stay']['ASIA'] as bigint) > 0", 2)],
                           "name string, pvalue string, erid int"),
        "BusenessEvents": ([(1, "stay", 1), (2, "off", 0)], "id int, name string, enabled int"),
        "BusenessEventsProp": ([(n, v, b) for b in (1, 2) for n, v in props], "name string, pvalue string, beid int"),
        "BusenessEventsMapEventRules": ([(1, 2), (2, 1)], "beid int, erid int"),
        "BusenessEventsMapEventSources": ([(1, 1), (1, 2), (2, 1)], "beid int, esid int"),
    }
    return {name: spark.createDataFrame(*table_) for name, table_ in rows.items()}


@query("application_catalogue", _APPLICATION)
def application_catalogue(spark, sf_dir):
    """The same application, built from the rule catalogue."""
    kinds = {"site-rule": "site", "stay-rule": "stay", "device-rule": "device"}
    app = build_application(rule_catalogue(_administration(spark)), kinds, {"feed-parser": "signals"})
    fired = app.fired({"1": signal_lines(spark, sf_dir)}, _lookups(spark, sf_dir))
    return app.business_events[0].messages(fired["1"], _sent())


@query("application_stream", _APPLICATION)
def application_stream(spark, sf_dir):
    lines = as_lines(signal_stream(spark, sf_dir))
    messages = _application().messages_stream({"feed": lines}, _lookups(spark, sf_dir), sent_at=_sent())
    return R.run_to_table(messages.select("key", "value"), "application").drop("batch")


@query("application_source", _APPLICATION)
def application_source(spark, sf_dir):
    """From text files to delivered messages, as one started application over several micro-batches."""
    app = _application(_text_times(spark, sf_dir, 5))
    path = new_shared_path(spark, "application-source")
    app.start(
        spark, _lookups(spark, sf_dir), f"{path}/checkpoint", deliver=R.write_batches_to(f"{path}/out"),
        gate=("00:00:00", "24:00:00"), sent_at=_sent(),
    ).awaitTermination()
    return spark.read.parquet(f"{path}/out").select("key", "value")


@query("not_yet_processed_stream", _body("not_yet_processed"))
def not_yet_processed_stream(spark, sf_dir):
    """Users are processed once over all micro-batches; those done before are the state that the stream begins with."""
    stream = signal_stream(spark, sf_dir).select("seq", "imsi", "event_type", "value")
    done = signals(spark, sf_dir).where("event_type = 'signup' and value > 150").select("imsi")
    return R.run_to_table(once_per_key(stream.select("seq", "imsi"), done, "imsi", "seq"), "once").drop("batch")


@query("processed_users_stream", "SELECT DISTINCT own AS imsi FROM base")
def processed_users_stream(spark, sf_dir):
    """The users done, read back from the state of the stream that processed them."""
    path = new_shared_path(spark, "once")
    done = signals(spark, sf_dir).where("event_type = 'signup' and value > 150").select("imsi")
    fresh = once_per_key(signal_stream(spark, sf_dir).select("seq", "imsi"), done, "imsi", "seq")
    R.start_batches(fresh, R.write_batches_to(f"{path}/out"), f"{path}/checkpoint").awaitTermination()
    return processed_keys(spark, f"{path}/checkpoint", "imsi")


@query("delivery_ledger", """
SELECT consumer, seq, event_type FROM s CROSS JOIN (SELECT unnest(['audit', 'billing', 'care']) AS consumer)""")
def delivery_ledger(spark, sf_dir):
    """Three consumers that append what they get; one fails once, the stream is started again, nobody gets a batch twice."""
    path = new_shared_path(spark, "delivery")
    stream = signal_stream(spark, sf_dir).select("seq", "event_type")
    failures = [1]

    def appending(name):
        def consume(batch, batch_id):
            if name == "billing" and batch_id == 1 and failures:
                raise ConnectionError(f"consumer is away, {failures.pop()} time")
            batch.withColumn("consumer", F.lit(name)).write.mode("append").parquet(f"{path}/out")

        return consume

    consumers = {name: appending(name) for name in ("audit", "billing", "care")}
    handler = R.delivering(lambda batch: batch, consumers, R.Ledger(spark, f"{path}/ledger"))
    for _ in range(2):
        try:
            R.start_batches(stream, handler, f"{path}/checkpoint").awaitTermination()
        except StreamingQueryException:
            continue
    return spark.read.parquet(f"{path}/out").select("consumer", "seq", "event_type")


@query("publish_events_files", _body("publish_events").replace(" AS value FROM s", " AS value, event_type AS topic FROM s"))
def publish_events_files(spark, sf_dir):
    """Messages of a stream, each sent to the topic of its kind, as a consumer of all topics reads them."""
    path = new_shared_path(spark, "published")
    rows = signal_stream(spark, sf_dir).selectExpr(
        "imsi", "date_format(ts, 'yyyyMMdd HH:mm:ss.SSS') as time", "nullif(event_type, 'error') as kind", "event_type as topic"
    )
    sent = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    messages = sinks.event_messages(rows, ["imsi", "time", "kind"], "imsi", "|", sent, keep=["topic"])
    writer = sinks.publish_to_files(messages, f"{path}/out", checkpoint=f"{path}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return sinks.read_published(spark, f"{path}/out")


@query("batch_counts_listener", _body("batch_counts_stream"))
def batch_counts_listener(spark, sf_dir):
    """Sizes of micro-batches as the running query reports them, under a timed trigger and over a stop and a restart."""
    path = new_shared_path(spark, "batch-log")
    lines = open_stream(spark, "hdfs", _text_parts(spark, sf_dir, 5))
    name = path.rsplit("/", 1)[1]
    log = R.BatchLog(spark, f"{path}/sizes", name)
    spark.streams.addListener(log)
    try:
        for stop_after in (2, None):
            writer = lines.writeStream.foreachBatch(R.write_batches_to(f"{path}/out")).option("checkpointLocation", f"{path}/checkpoint")
            run = R.with_trigger(writer.queryName(name), 0.1).start()
            if stop_after is None:
                run.processAllAvailable()
            while stop_after and sum(p.numInputRows > 0 for p in run.recentProgress) < stop_after and run.isActive:
                run.awaitTermination(0.2)
            run.stop()
        sizes = log.read().select("batch", "n")
    finally:
        spark.streams.removeListener(log)
    return sizes


@query("archive_rolling", "SELECT value FROM lines")
def archive_rolling(spark, sf_dir):
    """Small micro-batches packed into files of a bounded size; each line once."""
    path = new_shared_path(spark, "rolling")
    archive = RollingArchive(spark, path, max_bytes=1 << 20)
    lines = open_stream(spark, "hdfs", _text_parts(spark, sf_dir, 5)).select("value")
    R.start_batches(lines, archive.take, f"{path}/checkpoint").awaitTermination()
    archive.close()
    return archive.read()


@query("accumulate_stream", _body("accumulate_to_table"))
def accumulate_stream(spark, sf_dir):
    """Counters go from one micro-batch to the next through their bucketed table."""
    path = new_shared_path(spark, "accumulate")
    stored = profiles(spark, sf_dir).selectExpr("imsi", "cast(c_nationkey as bigint) as cents")
    totals = BucketedTable.create(stored, f"{path}/totals", ["imsi"])
    handler = S.accumulate("imsi", "seq", ["cents"], totals, f"{path}/out")
    stream = signal_stream(spark, sf_dir).select("seq", "imsi", "cents")
    R.start_batches(stream, handler, f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("seq", "imsi", "total_cents")


@query("apply_changes_stream", RUNS)
def apply_changes_stream(spark, sf_dir):
    """The orders as a stream of changes, merged bucket by bucket into the table of customers."""
    path = new_shared_path(spark, "changes")
    table_ = BucketedTable.create(store_state(spark, sf_dir), f"{path}/state", ["hash_key"])
    orders = table(spark, sf_dir, "orders")
    for rows, files in arriving(orders, "o_totalprice", 3):  # not the order of the changes
        rows.repartition(files).write.mode("append").parquet(f"{path}/feed")
    stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/feed")
    R.start_batches(stream, S.apply_feed(table_, lambda b: order_changes(order_feed(b))), f"{path}/checkpoint").awaitTermination()
    return current(table_.read())


def _crossing(old: str, new: str) -> str:
    whens = " ".join(f"WHEN {old} <= {x} AND {new} >= {x} THEN {x}" for x in reversed(STAY.ordered_limits))
    return f"CASE {whens} ELSE 0 END"


def _entry(i: int) -> str:
    """The stay in area i after a record, and its label, from the stay before (e1 or e2)."""
    e = f"e{i}"
    stay = (
        f"CASE WHEN {e} IS NULL OR t - {e}.l > {STAY.timeout_ms} THEN {{'a': a{i}, 'f': t, 'l': t}} "
        f"ELSE {{'a': a{i}, 'f': least({e}.f, t), 'l': greatest({e}.l, t)}} END"
    )
    label = (
        f"CASE WHEN afresh OR ignored OR {e} IS NULL OR t - {e}.l > {STAY.timeout_ms} THEN 0 "
        f"WHEN t < {e}.f THEN {_crossing(f'{e}.l - {e}.f', f'{e}.l - t')} "
        f"WHEN t > {e}.l THEN {_crossing(f'{e}.l - {e}.f', f't - {e}.f')} ELSE 0 END"
    )
    return f"{stay} AS n{i}, CAST({label} AS BIGINT) AS l{i}"


# Records come in the order of seq, with times up to five days older than those before them.
_LATE = f"ts_ms - (seq * 7919 % 5) * {30 * HOUR}"


_LATE_SQL = f"""
, arrivals AS (SELECT seq, imsi, {_LATE} AS t, region AS a1, zone AS a2, row_number() OVER (PARTITION BY imsi ORDER BY seq) AS rn
               FROM s JOIN cells USING (cell)),
steps AS (
  SELECT imsi, rn, seq, a1, a2, [{{'a': a1, 'f': t, 'l': t}}, {{'a': a2, 'f': t, 'l': t}}] AS stays, CAST(0 AS BIGINT) AS l1,
         CAST(0 AS BIGINT) AS l2 FROM arrivals WHERE rn = 1
  UNION ALL
  SELECT imsi, rn, seq, a1, a2,
         CASE WHEN afresh THEN [{{'a': a1, 'f': t, 'l': t}}, {{'a': a2, 'f': t, 'l': t}}] WHEN ignored THEN stays
              ELSE list_concat([x for x in stays if x.a <> a1 AND x.a <> a2], [n1, n2]) END, l1, l2
  FROM (SELECT *, {_entry(1)}, {_entry(2)}
        FROM (SELECT n.*, p.stays, t - list_max([x.l for x in p.stays]) > {STAY.timeout_ms} AS afresh,
                     list_max([x.l for x in p.stays]) - t > {STAY.timeout_ms} AS ignored,
                     [x for x in p.stays if x.a = n.a1][1] AS e1, [x for x in p.stays if x.a = n.a2][1] AS e2
              FROM steps p JOIN arrivals n ON n.imsi = p.imsi AND n.rn = p.rn + 1)))
SELECT seq, imsi, a1 AS area, l1 AS stay FROM steps UNION ALL SELECT seq, imsi, a2, l2 FROM steps"""


@query("late_policy", _LATE_SQL)
def late_policy(spark, sf_dir):
    """Stays of records that come late: some move a beginning back, some are too old to count."""
    records = signal_stream(spark, sf_dir).select("seq", "imsi", F.expr(_LATE).alias("ts_ms"), "lac", "ci")
    labelled = label_users(label_site(records, sites(spark, sf_dir)), UserLabels(stay=STAY))
    out = R.run_to_table(labelled.select("seq", "imsi", "area_onsite_stay"), "late")
    return out.select("seq", "imsi", F.explode("area_onsite_stay").alias("area", "stay")).withColumn(
        "stay", F.col("stay").cast("long")
    )


@query("late_policy_batch", _LATE_SQL)
def late_policy_batch(spark, sf_dir):
    """The same as a batch, by running maxima instead of a walk."""
    records = signals(spark, sf_dir).select("seq", "imsi", F.expr(_LATE).alias("ts_ms"), "lac", "ci")
    placed = label_site(records, sites(spark, sf_dir))
    visits = placed.select("seq", "imsi", "ts_ms", F.explode(F.map_keys("area_onsite")).alias("area"))
    return dwell_by_arrival(visits, STAY).select("seq", "imsi", "area", "stay")

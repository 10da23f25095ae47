from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from beaconflow.operators.skew import Skew
from beaconflow.plans.application import Application, build_application
from beaconflow.plans.catalogue import rule_catalogue
from beaconflow.session import new_shared_path
from beaconflow.sources.streams import topic_order
from beaconflow.streaming import runner as R

KINDS = {"profile-rule": "profile", "site-rule": "site", "stay-rule": "stay", "device-rule": "device", "movement-rule": "movement"}
PARSERS = {"feed-parser": "signals"}


def tables(spark, **changes):
    """A catalogue like the seed rows: one live source, one switched off."""
    raw = {
        "EventSource": ([(1, "MC", "kafka_direct", ",", 15, "feed-parser", 1, -1), (2, "OFF", "hdfs", ",", 15, "feed-parser", 0, -1)],
                        "id int, name string, type string, delim string, formatlength int, classname string, enabled int, validWindowsTimeMs int"),
        "EventSourceProp": ([("topic", "t1", 1), ("brokers", "b:1", 1)], "name string, pvalue string, esourceid int"),
        "LabelRules": ([(10, 1, "stay-rule", 1), (2, 1, "site-rule", 1), (1, 1, "profile-rule", 1), (3, 2, "site-rule", 1),
                        (4, 1, "device-rule", 0)], "id int, esourceid int, classname string, enabled int"),
        "LabelRulesProp": ([("user_info_cols", "product_no,city_id", 1), ("stay.limits", "600000, 300000, 180000", 10),
                            ("stay.timeout", "1800000", 10)], "name string, pvalue string, lrid int"),
        "EventRules": ([(1, 1, "rule", 1, -1), (2, 1, "rule", 1, 1), (3, 1, "rule", 0, -1)],
                       "id int, esourceid int, classname string, enabled int, parentEventRuleId int"),
        "EventRulesProp": ([("filterExp", "labels['area_onsite']['X']='true'", 1),
                            ("filterExp", "cast(labels['area_onsite_stay']['X'] as bigint) > 0", 2)], "name string, pvalue string, erid int"),
        "BusenessEvents": ([(1, "one", 1), (2, "off", 0)], "id int, name string, enabled int"),
        "BusenessEventsProp": ([("selectExp", "imsi,time,labels['user_info']['product_no'],labels['area_onsite_stay']['X']", 1),
                                ("delim", ",", 1), ("outputtype", "kafka", 1), ("kafkakeycol", "2", 1), ("output_topic", "out", 1),
                                ("interval", "1800000", 1), ("userKeyIdx", "0", 1), ("timeIdx", "1", 1)],
                               "name string, pvalue string, beid int"),
        "BusenessEventsMapEventRules": ([(1, 2), (2, 1)], "beid int, erid int"),
        "BusenessEventsMapEventSources": ([(1, 1), (1, 2)], "beid int, esid int"),
    }
    raw.update(changes)
    return {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in raw.items()}


def test_catalogue(spark):
    c = rule_catalogue(tables(spark))
    assert [(r.id, r.properties) for r in c.sources.collect()] == [(1, {"topic": "t1", "brokers": "b:1"})]
    assert [r.id for r in c.label_rules.collect()] == [1, 2, 10]  # numeric order, enabled only
    assert [(r.id, r.properties == {}) for r in c.label_rules.collect()][1] == (2, True)
    assert [tuple(r) for r in c.event_rule_links.collect()] == [(1, 2)]
    assert [tuple(r) for r in c.event_source_links.collect()] == [(1, 1)]


def test_application_from_lines_to_messages(spark):
    app = build_application(rule_catalogue(tables(spark)), KINDS, PARSERS)
    (source,), (event,) = app.sources, app.business_events
    assert (source.layout, source.kind, source.conf["topic"]) == (15, "kafka_direct", "t1")
    lookups = {
        "sites": spark.createDataFrame([("531E", "044E", "X"), ("0001", "0001", "Y")], "lac string, ci string, areas string"),
        "profiles": spark.createDataFrame([("A", "139", "c1")], "imsi string, product_no string, city_id string"),
    }

    def line(minute, lac="21278", ci="1102"):
        return f"1,20150401 08:{minute:02}:00.000,{lac},{ci},d,e,A,B,0,0,0,1,0,0,2"

    lines = [line(0), line(4), line(6), "junk", line(7, "1", "1"), line(12), line(43), line(46)]
    df = spark.createDataFrame(list(enumerate(lines)), "seq long, value string")
    for skew in (Skew(), Skew(4, 2), None):
        fired = app.fired({"1": df}, lookups, skew=skew)["1"]
        sent = F.to_timestamp(F.lit("2015-04-01 09:00:00"))
        got = [tuple(r) for r in event.messages(fired, sent).orderBy("value").collect()]
        assert got == [
            ("139", "A,20150401 08:04:00.000,139,180000,20150401 09:00:00.000"),
            ("139", "A,20150401 08:46:00.000,139,180000,20150401 09:00:00.000"),
        ]


def test_several_business_events_share_the_labels(spark):
    c = tables(
        spark,
        BusenessEvents=([(1, "one", 1), (2, "two", 1)], "id int, name string, enabled int"),
        BusenessEventsMapEventRules=([(1, 2), (2, 1)], "beid int, erid int"),
        BusenessEventsMapEventSources=([(1, 1), (2, 1)], "beid int, esid int"),
        BusenessEventsProp=(
            [(n, v, b) for b in (1, 2) for n, v in [("selectExp", "imsi,time"), ("delim", ","), ("outputtype", "kafka"),
             ("kafkakeycol", "0"), ("output_topic", f"t{b}"), ("interval", "600000"), ("userKeyIdx", "0")]],
            "name string, pvalue string, beid int",
        ),
    )
    app = build_application(rule_catalogue(c), KINDS, PARSERS)
    lookups = {
        "sites": spark.createDataFrame([("531E", "044E", "X")], "lac string, ci string, areas string"),
        "profiles": spark.createDataFrame([("A", "139", "c1")], "imsi string, product_no string, city_id string"),
    }
    lines = [f"1,20150401 08:{m:02}:00.000,21278,1102,d,e,A,B,0,0,0,1,0,0,2" for m in (0, 4, 11)]
    df = spark.createDataFrame(list(enumerate(lines)), "seq long, value string")
    fired = app.fired({"1": df}, lookups)
    assert sorted(r.c1[9:14] for r in fired["1"].collect()) == ["08:04"]
    assert sorted(r.c1[9:14] for r in fired["2"].collect()) == ["08:00", "08:11"]
    # The same as one stream over both events.
    path = new_shared_path(spark, "lines")
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    out = R.run_to_table(app.messages_stream({"1": stream}, lookups), "app")
    assert sorted((r.event, r.topic, r.value[11:16]) for r in out.collect()) == [
        ("1", "t1", "08:04"), ("2", "t2", "08:00"), ("2", "t2", "08:11")]


def test_two_rules_on_one_source_are_an_error(spark):
    changed = tables(spark, BusenessEventsMapEventRules=([(1, 1), (1, 2)], "beid int, erid int"))
    with pytest.raises(ValueError):
        build_application(rule_catalogue(changed), KINDS, PARSERS)


def test_an_application_starts_from_its_source(spark, tmp_path):
    """Two files, one micro-batch each; the gate; topics; an unknown sink."""
    raw = tables(spark, EventSource=([(1, "F", "hdfs", ",", 15, "feed-parser", 1, -1)],
                 "id int, name string, type string, delim string, formatlength int, classname string, enabled int, validWindowsTimeMs int"),
                 EventSourceProp=([("path", str(tmp_path / "in"), 1), ("maxFilesPerTrigger", "1", 1)], "name string, pvalue string, esourceid int"))
    app = build_application(rule_catalogue(raw), KINDS, PARSERS)
    lookups = {
        "sites": spark.createDataFrame([("531E", "044E", "X")], "lac string, ci string, areas string"),
        "profiles": spark.createDataFrame([("A", "139", "c1")], "imsi string, product_no string, city_id string"),
    }
    for minutes in ((0, 4), (6, 12)):
        lines = [f"1,20150401 08:{m:02}:00.000,21278,1102,d,e,A,B,0,0,0,1,0,0,2" for m in minutes]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "in"))
    seen = []
    deliver = lambda batch, i: seen.extend((i, *r) for r in batch.select("topic", "value").collect())
    app.start(spark, lookups, str(tmp_path / "c"), deliver=deliver).awaitTermination()
    assert [(i, topic, value[:27]) for i, topic, value in seen] == [(0, "out", "A,20150401 08:04:00.000,139")]
    seen.clear()
    app.start(spark, lookups, str(tmp_path / "shut"), deliver=deliver, gate=("23:59:59", "00:00:00")).awaitTermination()
    assert seen == []
    other = Application(app.sources, [replace(app.business_events[0], output_type="fax")])
    with pytest.raises(ValueError, match="fax"):
        other.start(spark, lookups, str(tmp_path / "x"), deliver=deliver)


def test_arrival_order_sorts_as_text(spark):
    rows = spark.createDataFrame([(5, 3, 9), (5, 3, 10), (5, 20, 1), (40, 1, 1)], "t long, partition int, offset long")
    got = rows.withColumn("timestamp", F.timestamp_millis("t")).select(topic_order().alias("s")).collect()
    assert [r.s for r in got] == sorted(r.s for r in got) and len({r.s for r in got}) == 4

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from beaconflow.constants import ANONYMOUS_ID
from beaconflow.operators.rules import time_of_day_gate
from beaconflow.sources.signals import ingest_signals, parse_signals, route_feed, within_validity

CALLING, CALLED = "460005301567381", "460005301567382"


def line15(event="1", time="20150401 08:00:00.000", lac="21278", ci="1102", calling=CALLING, called=CALLED,
           status="0", alone="2"):
    return f"{event},{time},{lac},{ci},,8629490242767878,{calling},{called},{status},0,0,1,0,0,{alone}"


def parse(spark, lines, layout=15, **options):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "seq int, value string")
    return parse_signals(df, layout=layout, **options).orderBy("seq").collect()


def test_sample_lines_of_the_older_layout(spark):
    called, calling, missed = parse(spark, [line15("3"), line15("1"), line15("1", status="1")])
    assert (called.imsi, calling.imsi, missed.imsi) == (CALLED, CALLING, CALLING)
    assert (called.lac, called.ci) == ("531E", "044E")
    assert called.calledimei == called.imei == "86294902427678"
    assert called.reject_reason is None and called.callingphone is None
    assert called.ts == datetime(2015, 4, 1, 8)


def test_newer_layout_has_phones(spark):
    fields = line15("1").split(",")
    line = ",".join(fields[:8] + ["139", "138"] + fields[8:])
    (row,) = parse(spark, [line], layout=17)
    assert (row.callingphone, row.calledphone, row.issmsalone) == ("139", "138", 2)


@pytest.mark.parametrize(
    "line, reason",
    [
        (line15() + ",1", "field_count"),
        ("a,b", "field_count"),
        ("", "field_count"),
        (line15(alone=""), "field_count"),  # trailing empty fields do not count
        (line15(calling=ANONYMOUS_ID, called=ANONYMOUS_ID), "anonymous"),
        (line15(status=" 7"), "bad_number"),
        (line15(status="x"), "bad_number"),
        (line15(event="99999999999"), "bad_number"),
        (line15(time="2015-04-01 08:00:00"), "bad_time"),
        (line15(lac="-5"), "bad_cell"),
        (line15(ci="zz"), "bad_cell"),
        (line15(event="8", alone="3"), "no_subject"),
        (line15(event="26", alone="0"), "no_subject"),
    ],
)
def test_rejects(spark, line, reason):
    assert parse(spark, [line])[0].reject_reason == reason


@pytest.mark.parametrize("event, alone, imsi", [("8", "1", CALLING), ("10", "2", CALLED), ("5", "1", CALLED), ("2", "2", CALLING)])
def test_subject(spark, event, alone, imsi):
    assert parse(spark, [line15(event, alone=alone)])[0].imsi == imsi


def test_signed_numbers_and_wide_cells(spark):
    (row,) = parse(spark, [line15(status="+3", lac="70000", ci="10")])
    assert (row.eventresult, row.lac, row.ci) == (3, "11170", "000A")


def test_validity_is_inclusive_and_can_be_off(spark):
    at = F.to_timestamp(F.lit("2015-04-01 09:00:00"))
    assert parse(spark, [line15()], validity_ms=3_600_000, now=at)[0].reject_reason is None
    assert parse(spark, [line15()], validity_ms=3_599_999, now=at)[0].reject_reason == "expired"
    assert parse(spark, [line15()], validity_ms=-1)[0].reject_reason is None
    with pytest.raises(ValueError):
        within_validity(spark.range(1).withColumn("ts", F.current_timestamp()), -2)


def test_good_and_rejects_partition_the_input(spark):
    df = spark.createDataFrame([(line15(),), ("junk",)], "value string")
    good, rejects = ingest_signals(df, layout=15)
    assert good.count() == 1 and "value" not in good.columns
    assert [tuple(r) for r in rejects.collect()] == [("junk", "field_count")]


def test_literal_delimiter(spark):
    df = spark.createDataFrame([(line15().replace(",", "|"),)], "value string")
    assert ingest_signals(df, layout=15, delim="|")[0].count() == 1


def test_route_feed(spark):
    lines = [
        line15("3"), line15("1"), line15("8", alone="2"), line15("8", alone="1"), "short,line", "   ",
        line15(calling=ANONYMOUS_ID, called=ANONYMOUS_ID), line15(calling="", called=" "),
        line15(calling="", called=CALLED),
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [r.key for r in route_feed(df).collect()] == [CALLED, CALLING, CALLED, CALLING, ""]
    timed = route_feed(df, received_at=F.lit("2015-04-01 08:00:00:000")).first()
    assert timed.value == lines[0] + ",2015-04-01 08:00:00:000"


def test_gate_excludes_both_ends(spark):
    df = spark.sql("select to_timestamp(x) ts from values ('2015-04-01 08:00:00'), ('2015-04-01 08:00:01'), "
                   "('2015-04-01 20:00:00') t(x)")
    assert time_of_day_gate(df, "08:00:00", "20:00:00").count() == 1

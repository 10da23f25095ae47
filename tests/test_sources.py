import os

import pytest
from pyspark.sql import functions as F

from beaconflow.functions.cells import hex_code
from beaconflow.functions.text import split_fields, wildcard_regex
from beaconflow.session import new_shared_path
from beaconflow.sources import sinks
from beaconflow.sources.dimensions import jdbc_options, read_dimension, read_lines, rejected_lines
from beaconflow.sources.lookup_text import read_lookup_text
from beaconflow.sources.streams import stream_options


def test_hex_codes(spark):
    got = spark.createDataFrame([(54017,), (1,), (70000,), (-1,), (None,)], "c int").select(hex_code(F.col("c"))).collect()
    assert [r[0] for r in got] == ["D301", "0001", "11170", None, None]


def test_split_drops_trailing_empties_and_is_literal(spark):
    got = spark.createDataFrame([("a||b||",), ("|a",), ("",)], "v string").select(F.size(split_fields(F.col("v"), "|"))).collect()
    assert [r[0] for r in got] == [3, 2, 1]
    assert spark.range(1).select(split_fields(F.lit("a.*b.*c"), ".*").alias("x")).first().x == ["a", "b", "c"]


def test_wildcards():
    assert wildcard_regex("a.", "b", "c") == r"(?s)^a\..*b.*c$" and wildcard_regex() == "(?s)^.*$"


def write(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_lookup_files(spark, tmp_path):
    lists = read_lookup_text(spark, write(tmp_path, "l", "key1:v1,v2\nbroken\n"), "list")
    assert [tuple(r) for r in lists.collect()] == [("key1", ["v1", "v2"])]
    maps = read_lookup_text(spark, write(tmp_path, "m", "KeyA:a,1:b,2:a,3\n"), "map")
    assert [tuple(r) for r in maps.collect()] == [("KeyA", {"b": "2", "a": "3"})]
    cells = read_lookup_text(spark, write(tmp_path, "v", "lacci2area:21670,13902:AAAA\n"), "value")
    assert [tuple(r) for r in cells.collect()] == [("lacci2area", "21670,13902", "AAAA")]
    with pytest.raises(ValueError):
        read_lookup_text(spark, str(tmp_path), "other")


def test_dimension_files(spark, tmp_path):
    path = write(tmp_path, "d", 'k1, "城市" ,x,\nk2,\nk3,b,c\n', "gb18030")
    got = read_dimension(spark, "file", path=path, columns={"k": 0, "city": 1}, encoding="GB18030")
    assert [tuple(r) for r in got.collect()] == [("k1", '"城市"'), ("k3", "b")]
    with pytest.raises(ValueError):
        read_dimension(spark, "cloud")


def test_jdbc_options():
    got = jdbc_options("jdbc:x", "t", partition_column="id", bounds=("1", "9"), partitions=4, user="u")
    assert got == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "user": "u", "partitionColumn": "id",
                   "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_stream_sources():
    assert stream_options("kafka_direct", {"brokers": "b:1", "topic": "t1, t2"}) == (
        "kafka", {"kafka.bootstrap.servers": "b:1", "subscribe": "t1,t2"})
    kind, options = stream_options("kafka", {"brokers": "b:1", "topic": "t", "group": "g", "receivernum": "2", "maxOffsetsPerTrigger": 5})
    assert options["kafka.group.id"] == "g" and options["minPartitions"] == "2" and options["maxOffsetsPerTrigger"] == "5"
    assert stream_options("hdfs", {"path": "/x"}) == ("text", {"path": "/x"})
    with pytest.raises(ValueError):
        stream_options("socket", {})


def test_messages(spark):
    df = spark.createDataFrame([("u1", None, 5, "skipped")], "imsi string, a string, b int, c string")
    sent = F.to_timestamp(F.lit("2015-04-01 08:00:00.120"))
    (row,) = sinks.event_messages(df, ["imsi", "a", "b"], "imsi", "||", sent).collect()
    assert (row.key, row.value) == ("u1", "u1||||5,20150401 08:00:00.120")
    for kind in ("hdfs", "file"):
        with pytest.raises(ValueError):
            sinks.publish_events(df, kind, "t", "b")


def test_archive_and_match(spark):
    lines = spark.createDataFrame([("good x",), ("bad",), ("x2",)], "value string")
    kept, count = sinks.matching_lines(lines, "x")
    path = new_shared_path(spark, "archive-test")
    sinks.archive_batch(kept, path, F.to_timestamp(F.lit("2015-04-01 08:00:05")), "p-", ".log")
    assert os.listdir(path.removeprefix("file:")).count("archive=p-20150401080005.log") == 1
    assert count.get["matched"] == 2
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["good x", "x2"]


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1", "UTF-16LE"])
def test_the_usual_separator_of_table_files(spark, tmp_path, encoding):
    path = write(tmp_path, "t", "a\u0001é\u0001c\nx\u0001y\nd\u0001\"e\u0001f\n", encoding)
    rows = read_dimension(spark, "file", path=path, columns={"k": 0, "v": 2}, delim="\u0001", encoding=encoding)
    assert sorted(map(tuple, rows.collect())) == [("a", "c"), ("d", "f")]
    short = rejected_lines(read_lines(spark, path, encoding), {"k": 0, "v": 2}, "\u0001")
    assert [r.value for r in short.collect()] == ["x\u0001y"]


def test_each_message_goes_to_its_own_topic(spark):
    messages = spark.createDataFrame([("k", "v", "t1")], "key string, value string, topic string")
    assert sinks.publish_options(messages, "other", "b:1") == {"kafka.bootstrap.servers": "b:1"}
    assert sinks.publish_options(messages.drop("topic"), "t", "b:1")["topic"] == "t"
    with pytest.raises(ValueError):
        sinks.publish_options(messages.drop("topic"), None, "b:1")


def test_the_last_of_many_values_of_a_field_counts(spark, tmp_path):
    line = "k:" + ":".join(f"f{i % 50},{i}" for i in range(5000))
    got = read_lookup_text(spark, write(tmp_path, "m", line + "\nl:a,1:a,2:bad:b,3\n"), "map").collect()
    assert {r.key: r.entries for r in got} == {"k": {f"f{i}": str(4950 + i) for i in range(50)}, "l": {"a": "2", "b": "3"}}


def test_messages_as_files_by_topic(spark, tmp_path):
    messages = spark.createDataFrame([("a", "1", "007"), ("b", "2", "x/y"), ("c", None, None)], "key string, value string, topic string")
    path = str(tmp_path / "out")
    sinks.publish_to_files(messages, path, "rest")
    sinks.publish_to_files(messages.drop("topic").limit(1), path, "rest")
    got = sorted(tuple(r) for r in sinks.read_published(spark, path).select("topic", "key", "value").collect())
    assert len(got) == 4 and {t for t, _, _ in got} == {"007", "x/y", "rest"} and ("rest", "c", None) in got
    with pytest.raises(Exception, match="message without a topic"):
        sinks.publish_to_files(messages, str(tmp_path / "other"))
    with pytest.raises(ValueError):
        sinks.publish_to_files(spark.readStream.schema(messages.schema).parquet(path), str(tmp_path / "third"), "t")

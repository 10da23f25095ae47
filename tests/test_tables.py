import pytest
from pyspark.sql import functions as F

from beaconflow.operators import aggregates as A
from beaconflow.operators import keyed_table as U
from beaconflow.operators.skew import Skew
from beaconflow.sources import keyed_export as X


def pairs(spark, columns, make):
    rows = [make(i, j) for i in range(10) for j in range(10)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).withColumn(
        "seq", F.monotonically_increasing_id()
    )


def values(spark, tag=""):
    return pairs(spark, ["i", "j", "v1", "v2"], lambda i, j: (str(i), f" {j}", f"value1-test{tag}-{i}", f"value2-test{tag}-{j}"))


def record(table, key):
    return {r.field: r.value for r in table.where(F.col("hash_key") == key).collect()}


FIELDS = {"field1": "v1", "field2": "v2"}


def load(spark, existing=None, tag="", **options):
    return U.upsert_multihash(existing, values(spark, tag), ["i", "j"], FIELDS, prefix="records:", **options)


def test_multihash_overwrite_and_append(spark):
    first = load(spark)
    assert record(first, "records:2:3") == {"field1": "value1-test-2", "field2": "value2-test-3"}
    both = load(spark, first, "2", overwrite=False)
    got = record(both, "records:2:3")
    assert got == {"field1": "value1-test-2,value1-test2-2", "field2": "value2-test-3,value2-test2-3"}
    # Loading the same again adds nothing, overwriting replaces.
    assert record(load(spark, both, "2", overwrite=False), "records:2:3") == got
    assert record(load(spark, both, "2"), "records:2:3")["field1"] == "value1-test2-2"


def test_onehash(spark):
    table = U.upsert_onehash(None, values(spark), "t", ["i", "j"], ["v1", "v2"], value_sep="#")
    got = record(table, "t")
    assert len(got) == 100 and got["2:3"] == "value1-test-2#value2-test-3"


@pytest.mark.parametrize("overwrite", [True, False])
def test_filtering_and_shuffling_merges_agree(spark, overwrite):
    existing = load(spark).where("hash_key <> 'records:5:5'")
    rows = U.multihash_rows(values(spark, "2").where("i < 6"), U.key_of(["i", "j"], prefix="records:"), FIELDS)
    filtered, shuffled = (
        sorted(map(tuple, U.merge_rows(existing, rows, overwrite, small=small).collect())) for small in (True, False)
    )
    assert filtered == shuffled and len(filtered) == 200


def areas(spark):
    return pairs(
        spark, ["lac", "ci", "area", "flag"],
        lambda i, j: (str(100 + i), str(100 + j), f"area-{(i + j) % 10}", str((i + j) % 2)),
    )


def test_area_map_with_value_map_in_two_fields(spark):
    rows = pairs(
        spark, ["lac", "ci", "flag", "cover"],
        lambda i, j: (str(100 + i), str(100 + j), str((i + j) % 2), "WLAN" if (j - i) % 2 == 1 else ""),
    )
    wlan = U.MappedValue("cover", ("WLAN", "wlan"), "1")
    table = U.upsert_area_map(None, rows, ["lac", "ci"], {"area1": "flag", "WLAN": wlan})
    assert record(table, "102:103") == {"area1": "1", "WLAN": "1"}
    assert record(table, "102:104") == {"area1": "0"}


def test_area_map_forms(spark):
    plain = U.upsert_area_map(None, areas(spark), ["lac", "ci"], {"area": "area"})
    assert record(plain, "102:103") == {"area": "area-5"}

    def onehash(value, existing=None, **options):
        return U.upsert_onehash(
            existing, areas(spark), "t", ["lac", "ci"], value, hex_columns=["lac", "ci"], skip_empty=True, **options
        )

    mapped = onehash(U.MappedValue("flag", ("1", "true"), "WLAN"))
    got = record(mapped, "t")
    assert got["0066:0067"] == got["006C:006D"] == "WLAN" and "0066:0068" not in got
    areas_only = record(onehash("area"), "t")
    assert (areas_only["0066:0067"], areas_only["006C:006D"]) == ("area-5", "area-7")
    more = onehash(U.MappedValue("flag", ("1", "true"), "WLAN2"), mapped, overwrite=False)
    assert record(more, "t")["0066:0067"] == "WLAN,WLAN2"


def test_last_write_wins_by_seq(spark):
    rows = spark.createDataFrame([("k", "late", 9), ("k", "early", 3), ("k", "mid", 5)], "k string, v string, seq long")
    table = U.upsert_multihash(None, rows, ["k"], {"f": "v"})
    assert record(table, "k") == {"f": "late"}


def test_delete_fields_and_keys(spark):
    table = load(spark)
    targets = spark.createDataFrame([("records:3:2", "field1"), ("records:3:2", "field2"), ("records:4:4", "field1")],
                                    "hash_key string, field string")
    left = U.delete_fields(table, targets)
    assert record(left, "records:3:2") == {} and len(record(left, "records:2:3")) == 2
    assert list(record(left, "records:4:4")) == ["field2"]
    keys = spark.createDataFrame([("records:3:2",), ("records:3:2",)], "hash_key string")
    assert U.delete_keys(table, keys).count() == 198


def changes(spark):
    rows = [(1, "1", "new1", 1), (2, "0", "upd2", 2), (3, "-1", "x", 3), (4, "-1", "x", 4), (4, "1", "back4", 5),
            (5, "7", "odd", 6), (6, None, "odd", 7)]
    return spark.createDataFrame(rows, "id int, flag string, v string, seq long")


def stored(spark, key="k{}", field="f"):
    return spark.createDataFrame(
        [(key.format(i), f, f"old{i}") for i in (2, 3, 4, 5) for f in (field, "g")], "hash_key string, field string, value string"
    )


def test_change_feed(spark):
    key = U.key_of(["id"], prefix="k")
    out = U.apply_changes(stored(spark), changes(spark), key, {"f": "v"}, "flag")
    got = {(r.hash_key, r.field): r.value for r in out.collect()}
    assert got == {("k1", "f"): "new1", ("k2", "f"): "upd2", ("k2", "g"): "old2", ("k4", "f"): "back4",
                   ("k5", "f"): "old5", ("k5", "g"): "old5"}
    by_field = U.apply_changes(stored(spark), changes(spark), key, {"f": "v"}, "flag", delete_mode="fields")
    assert record(by_field, "k3") == {"g": "old3"}
    every = U.apply_changes(stored(spark), changes(spark), key, {"f": "v"}, "flag", increment=False)
    assert record(every, "k3")["f"] == "x" and record(every, "k6")["f"] == "odd"
    assert U.unknown_changes(changes(spark), "flag", U.ChangeFlags()).first()[0] == 2
    assert U.unknown_changes(changes(spark), "flag", U.ChangeFlags(delete=None)).first()[0] == 4
    with pytest.raises(ValueError):
        U.apply_changes(stored(spark), changes(spark), key, {"f": "v"}, "flag", delete_mode="all")


def test_change_feed_uses_one_key_for_deletes_and_upserts(spark):
    feed = spark.createDataFrame([("258", "10", "-1", "x", 1), ("259", "10", "1", "AREA", 2)],
                                 "lac string, ci string, flag string, v string, seq long")
    table = spark.createDataFrame([("t", "0102:000A", "OLD"), ("t", "0200:0001", "KEPT")], "hash_key string, field string, value string")
    out = U.apply_changes(table, feed, U.key_of(["lac", "ci"], hex_columns=["lac", "ci"]), {"a": "v"}, "flag", onehash="t")
    assert record(out, "t") == {"0103:000A": "AREA", "0200:0001": "KEPT"}


def test_merge_distinct_keeps_arrival_order(spark):
    new = spark.createDataFrame([("k", "f", v, s) for s, v in enumerate("cabca")], "hash_key string, field string, value string, seq long")
    old = spark.createDataFrame([("k", "f", "z|b|z"), ("o", "f", "q")], "hash_key string, field string, value string")
    assert A.merge_distinct(new).first().value == "c,a,b"
    got = {r.hash_key: r.value for r in A.merge_distinct(new, old, "|").collect()}
    assert got == {"k": "z|b|z|c|a", "o": "q"}


def test_export(spark):
    table = spark.createDataFrame(
        [("user:12.3", "b", "2"), ("user:12.3", "a", "1"), ("user:1293", "a", "9"), ("user.12.3", "a", "0")],
        "hash_key string, field string, value string",
    )
    wide = X.export_lookup(table, prefix="user:", mid="2.")
    assert wide.columns == ["hash_key", "a", "b"] and [tuple(r) for r in wide.collect()] == [("user:12.3", "1", "2")]
    assert X.matching_keys(table, suffix=".3").count() == 2
    assert [tuple(r) for r in X.record_fields(table, "user:12.3").collect()] == [("a", "1"), ("b", "2")]


def test_accumulate_with_hot_key_equals_plain_window(spark):
    rows = spark.range(600).selectExpr("id as seq", "case when id % 3 > 0 then 'hot' else concat('u', id % 7) end as k", "id % 11 as m")
    table = spark.createDataFrame([("hot", 1000), ("u1", 5), ("unused", 7)], "k string, m long")

    def got(skew, stored):
        return sorted((r.seq, r.total_m) for r in A.accumulate_to_table(rows, "k", "seq", ["m"], stored, skew).collect())

    for stored in (None, table):
        assert got(Skew(8, 10), stored) == got(None, stored)
    totals = {}
    want = []
    for r in rows.orderBy("seq").collect():
        totals[r.k] = totals.get(r.k, {"hot": 1000, "u1": 5}.get(r.k, 0)) + r.m
        want.append((r.seq, totals[r.k]))
    assert got(Skew(8, 10), table) == want
    assert {r.k: r.m for r in A.stored_totals(rows, "k", ["m"], table).collect()} == {**totals, "unused": 7}


def test_load_audit_and_observation(spark):
    rows = spark.createDataFrame([("1",), ("0",), ("x",), (None,)], "flag string")
    audit = A.load_audit(rows, "flag", ["1", "0"], 30, 500).first()
    assert (audit.num_total, audit.num_processed, audit.num_unknown, audit.num_batches) == (4, 2, 2, 1)
    assert (audit.percent_processed, audit.rows_per_second) == (50.0, 4.0)
    watched, seen = A.observed_load(rows, "flag", ["1", "0"])
    watched.collect()
    assert seen.get == {"num_scanned": 4, "num_processed": 2, "num_unknown": 2}


def test_throughput_and_properties(spark):
    rows = spark.createDataFrame([(0,), (999,), (1000,)], "ts_ms long")
    assert [tuple(r) for r in A.throughput(rows, 1000).orderBy("interval_start_ms").collect()] == [(0, 2, 2.0), (1000, 1, 1.0)]
    eav = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, None, None)], "id int, name string, pvalue string")
    assert {r.id: r.properties for r in A.pivot_properties(eav, ["id"]).collect()} == {1: {"a": "x", "b": "y"}, 2: {}}


@pytest.mark.parametrize("overwrite", [True, False])
def test_a_merge_does_not_depend_on_how_many_keys_are_written(spark, overwrite):
    table = [("k", "f", "1"), ("k", "f", "2"), ("k", "g", "3"), ("k", "g", "4"), (None, "f", "5"), (None, "f", "5"), ("l", None, "6")]
    old = spark.createDataFrame(table, "hash_key string, field string, value string")
    new = spark.createDataFrame([("k", "f", "9", 1), ("m", "f", "7", 2), ("m", "f", "8", 3)], "hash_key string, field string, value string, seq long")
    few, many = (sorted(map(str, U.merge_rows(old, new, overwrite, small=s).collect())) for s in (True, False))
    assert few == many and len(few) == (7 if overwrite else 8)


def test_a_record_of_very_many_fields_is_exported_as_rows(spark):
    table = spark.range(12_000).selectExpr("if(id < 11000, 'one', 'two') as hash_key", "cast(id as string) as field", "cast(id as string) as value")
    assert X.export_records(table, prefix="one").count() == 11_000
    first = X.export_records(table).first()
    assert tuple(first) == ("one", "0", "0")

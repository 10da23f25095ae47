import pytest
from pyspark.sql import functions as F

from beaconflow.constants import ANONYMOUS_ID
from beaconflow.functions.maps import map_union
from beaconflow.operators import lookups as J
from beaconflow.operators.skew import Skew, detect_together, fits_broadcast, lookup_join
from beaconflow.plans.labelling import GeoLabels, LabelPlan, SiteLabels
from beaconflow.operators.track import last_device, movement, track

TINY = Skew(share=8, min_rows=10)


def test_site_golden(spark):
    sites = spark.createDataFrame(
        [("111", "1", "area1", "c1"), ("112", "1", " area1 , area2,", None), ("123", "1", "area1,area2,area3", "c3"), ("9", "9", " ", "c9")],
        "lac string, ci string, areas string, city string",
    )
    records = spark.createDataFrame([("111", "1"), ("112", "1"), ("123", "1"), ("9", "9"), ("0", "0")], "lac string, ci string")
    got = {r.lac: r for r in J.label_site(records, sites).collect()}
    assert [sorted(got[k].area_onsite) for k in ("111", "112", "123")] == [["area1"], ["area1", "area2"], ["area1", "area2", "area3"]]
    assert set(got["123"].area_onsite.values()) == {"true"}
    assert got["9"].area_onsite == {} and got["0"].area_onsite == {}
    assert got["111"].area_info == {"city": "c1", "lac_ci": "1111"}
    assert got["112"].area_info == {"lac_ci": "1121"} and got["0"].area_info == {"lac_ci": "00"}


@pytest.mark.parametrize(
    "calling, called, subject, expected",
    [
        ("A", "B", "A", {"n": "a", "called_n": "b"}),
        ("A", "B", "B", {"n": "b", "calling_n": "a"}),
        ("A", ANONYMOUS_ID, "A", {"n": "a"}),
        ("A", ANONYMOUS_ID, ANONYMOUS_ID, {}),
        ("A", "A", "A", {"n": "a"}),
        (ANONYMOUS_ID, ANONYMOUS_ID, ANONYMOUS_ID, {}),
        ("C", "B", "C", {"called_n": "b"}),
    ],
)
@pytest.mark.parametrize("small", [True, False])
def test_profile_naming(spark, calling, called, subject, expected, small):
    profiles = spark.createDataFrame([("A", "a"), ("B", "b"), ("C", None), (ANONYMOUS_ID, "z")], "imsi string, n string")
    records = spark.createDataFrame([(calling, called, subject)], "callingimsi string, calledimsi string, imsi string")
    assert J.label_profile(records, profiles, ["n"], small=small).first().user_info == expected


def test_map_union_right_wins(spark):
    assert spark.range(1).select(
        map_union(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), F.lit("3"))).alias("m")
    ).first().m == {"a": "1", "b": "3"}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(300).selectExpr("id", "case when id % 3 = 0 then null when id % 3 = 1 then 7 else id % 40 end as k")
    right = spark.range(0, 60, 2).selectExpr("id as k", "concat('v', id) as v").union(spark.sql("select 7L, 'seven'"))
    want = sorted(map(tuple, left.join(right, "k", how).select("id", "k", *(["v"] if how in ("left", "inner") else [])).collect()), key=repr)
    for skew in (TINY, Skew(1000, 10_000)):
        got = lookup_join(left, right, "k", how, small=False, skew=skew).select("id", "k", *(["v"] if how in ("left", "inner") else []))
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_broadcast_only_after_measuring(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 100) as s", "map('a', 'b') as m")
    assert fits_broadcast(df) and not fits_broadcast(df, max_rows=999) and not fits_broadcast(df, max_bytes=100_000)


def test_not_yet_processed(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c")], "seq int, u string")
    fresh, after = J.not_yet_processed(rows, spark.createDataFrame([("a",), ("a",)], "u string"), "u", "seq")
    assert sorted(tuple(r) for r in fresh.collect()) == [(2, "b"), (4, "c")]
    assert sorted({r.u for r in after.collect()}) == ["a", "b", "c"]


def test_enrich_steps(spark):
    rows = spark.createDataFrame([("u1", "1", "1"), ("u2", "1", "2"), ("u3", None, "1")], "imsi string, lac string, cell string")
    cells = spark.createDataFrame([("1", "1", "X"), ("1", "2", None)], "l string, c string, city string")
    targets = spark.createDataFrame([("u1", "Y", "null")], "imsi string, city string, product string")
    steps = [
        J.LookupStep("cell", cells, {"lac": "l", "cell": "c"}, ["city"], "cell__city is not null", ["imsi", "cell__city"]),
        J.LookupStep("t", targets, {"imsi": "imsi"}, ["city", "product", "city"], "t__city <> cell__city and t__product = 'null'", ["imsi"]),
    ]
    assert [tuple(r) for r in J.enrich_and_filter(rows, steps).collect()] == [("u1",)]


def test_data_driven_filter(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1), ("c", 9)], "k string, x int")
    rules = spark.createDataFrame([("a", "x > 3"), ("b", "x < 3"), ("d", "true"), ("c", None)], "k string, rule string")
    assert sorted(tuple(r) for r in J.data_driven_filter(rows, rules, "k", "rule").collect()) == [("a", 5), ("b", 1)]


def test_needed_keys(spark):
    dim = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    records = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    got = J.needed_keys(records, [F.col("x"), F.col("y")], dim, "k")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1), ("b", 2)]


def positions(spark):
    return spark.range(400).selectExpr(
        "id as seq", "case when id % 3 > 0 then 'hot' else concat('u', id % 9) end as imsi", "id * 1000 as ts_ms",
        "concat('d', id % 5) as imei", "cast(20 + id % 13 as string) as geo_latitude",
        "cast(100 + id % 7 as string) as geo_longitude", "concat('c', id % 11) as lac_ci",
    )


def test_track_of_hot_users(spark):
    rows = positions(spark)
    for op in (last_device, movement, track):
        whole, cut = op(rows, skew=None), op(rows, skew=TINY)
        assert sorted(whole.collect()) == sorted(cut.select(whole.columns).collect())


def test_movement_values(spark):
    rows = spark.createDataFrame(
        [(0, "u", 0, "0", "0", "A"), (1, "u", 3_600_000, "0", "1", "B"), (2, "u", 3_600_000, "0", "1", "B")],
        "seq int, imsi string, ts_ms long, geo_latitude string, geo_longitude string, lac_ci string",
    )
    first, second, third = movement(rows).orderBy("seq").collect()
    assert (first.distance_km, first.speed_kmh, first.last_lac_ci) == (None, None, None)
    assert second.distance_km == second.speed_kmh == 111.3195 and second.last_lac_ci == "A"
    assert third.distance_km == 0.0 and third.speed_kmh is None


def test_geo_defaults(spark):
    sites = spark.createDataFrame([("1", "1", "5.5", "6.5")], "lac string, ci string, geo_longitude string, geo_latitude string")
    records = spark.createDataFrame([("1", "1"), ("2", "2")], "lac string, ci string")
    got = sorted((r.lac, r.geo_longitude, r.geo_latitude) for r in J.label_geo(records, sites).collect())
    assert got == [("1", "5.5", "6.5"), ("2", "0", "0")]


def test_any_number_of_stored_predicates(spark):
    rows = spark.range(3000).selectExpr("cast(id % 1500 as string) as k", "id as v")
    rules = spark.range(1201).selectExpr("cast(id as string) as k", "concat('v > ', id + 10) as condition")
    got = J.data_driven_filter(rows, rules, "k", "condition").collect()
    assert sorted(tuple(r) for r in got) == sorted((str(v % 1500), v) for v in range(3000) if v % 1500 <= 1200 and v > v % 1500 + 10)


def test_hot_ids_of_both_parties_are_found_before_the_joins(spark):
    """No detection contains a join, and the result is that of the broadcast form."""
    rows = [("A" if i % 3 else f"u{i}", "B" if i % 2 else f"u{i % 7}", "A" if i % 3 else f"u{i}") for i in range(300)]
    records = spark.createDataFrame(rows, "callingimsi string, calledimsi string, imsi string").withColumn("i", F.monotonically_increasing_id())
    names = sorted({x for r in rows for x in r})
    profiles = spark.createDataFrame([(n, n.lower()) for n in names], "imsi string, n string")
    keyed = records.withColumns({"__own": F.col("imsi"), "__other": F.col("calledimsi")})
    found = detect_together(keyed, ["__own", "__other"], TINY)
    assert set(found["__own"].pieces) == {"A"} and set(found["__other"].pieces) >= {"B"}
    as_rows = lambda df: sorted((r.i, sorted(r.user_info.items())) for r in df.collect())
    plain = J.label_profile(records, profiles, ["n"], small=True)
    assert as_rows(J.label_profile(records, profiles, ["n"], small=False, skew=TINY)) == as_rows(plain)
    assert as_rows(J.label_profile(records, profiles, ["n"], small=False, skew=None)) == as_rows(plain)


def test_areas_and_coordinates_come_from_one_join(spark):
    sites = spark.createDataFrame([("1", "2", "a,b", "3.5", "4.5"), ("9", "9", "c", None, "1")], "lac string, ci string, areas string, geo_longitude string, geo_latitude string")
    records = spark.createDataFrame([("1", "2"), ("9", "9"), ("0", "0")], "lac string, ci string")
    lookups = {"sites": sites}
    plan = LabelPlan([GeoLabels(), SiteLabels()]).stateless(records, lookups)
    apart = LabelPlan([SiteLabels()]).stateless(LabelPlan([GeoLabels()]).stateless(records, lookups), lookups)
    columns = ["lac", "lac_ci", "geo_longitude", "geo_latitude", "area_onsite", "area_info"]
    as_rows = lambda df: sorted((str(tuple(r)) for r in df.select(columns).collect()))
    assert as_rows(plan) == as_rows(apart)
    plan.collect()
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1

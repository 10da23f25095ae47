"""Stored predicates as data against the same texts as expressions."""

import pytest
from pyspark.sql import functions as F

from beaconflow.operators import lookups as J
from beaconflow.operators.predicates import Predicates

ROWS = "k string, i int, l long, d decimal(12,3), r double, s string, b boolean"

PLAIN = [
    "i > 3", "i<=3", "i = 5", "i == 5", "i <> 5", "i != -2", "I >= 2.5", "l < 9007199254740993", "l = 9007199254740993",
    "d = 1.5", "d > 1.499", "r < 0.1", "r >= 1", "r = 0", "s = 'a'", "s > 'a'", "s <> 'x or y'", "s = ''",
    "i between 1 and 5", "i > 1 and s = 'a'", "i > 4 or s = 'a' and r < 2", "s = 'p and q' or i IS NULL", "s is not null",
    "b is null", "s in ('a', 'x or y', 'p, q')", "i IN (1,5, 7.5)", "r in (0, 0.5)", "s between 'a' and 'p and q' and i > 0",
    "s = 'i between 1 and 2'",
]
OTHER = [
    "i > l", "i > 1e0", "i + 1 > 2", "(i > 3)", "s like 'a%'", "b", "b = true", "not (i > 3)", "s = 'it''s'", "s = \"a\"", "i not between 1 and 3",
    "i > '3'", "i not in (1, 5)", "length(s) > 1", "true", "i <=> 5",
]


@pytest.fixture(scope="module")
def rows(spark):
    values = [
        ("a", 5, 9007199254740993, None, 0.1, "a", True), ("b", 1, 9007199254740992, None, 0.0, "x or y", False),
        ("c", None, None, None, None, None, None), ("d", -2, 7, None, float("nan"), "p and q", None), ("e", 3, 3, None, -0.0, "", True),
        ("f", 7, 0, None, 0.5, "i between 1 and 2", True), ("g", 2, 1, None, 1.0, "it's", False),
    ]
    return spark.createDataFrame(values, ROWS).withColumn("d", F.col("i").cast("decimal(12,3)") * F.lit("0.3").cast("decimal(2,1)")).withColumn("d", F.col("d").cast("decimal(12,3)"))


def keys(df):
    return sorted(r.k for r in df.select("k").collect())


def test_parsed_predicates_mean_what_the_expressions_mean(spark, rows):
    stored = Predicates(rows)
    table = spark.createDataFrame([(t,) for t in PLAIN], "text string").withColumn("parts", stored.parsed(F.col("text")))
    assert table.where("parts is null").collect() == []
    met = rows.crossJoin(F.broadcast(table)).where(stored.holds(F.col("parts"))).select("text", "k").collect()
    for text in PLAIN:
        assert sorted(r.k for r in met if r.text == text) == keys(rows.where(F.expr(text))), text


def test_other_predicates_are_left_to_expressions(spark, rows):
    stored = Predicates(rows)
    table = spark.createDataFrame([(t,) for t in OTHER + ["nothing > 3", "i > 'a' and i > 1"]], "text string")
    assert table.where(stored.parsed(F.col("text")).isNotNull()).collect() == []


def test_both_kinds_in_one_table(spark, rows):
    texts = PLAIN + OTHER + [None]
    every = rows.select("k").distinct().collect()
    rules = spark.createDataFrame([(r.k, t) for r in every for t in texts], "k string, condition string")
    got = J.data_driven_filter(rows, rules, "k", "condition")
    want = [k for t in texts if t for k in keys(rows.where(F.expr(t)))]
    assert keys(got) == sorted(want) and got.columns == rows.columns
    assert J.data_driven_filter(rows, rules.limit(0), "k", "condition").collect() == []
    assert J.data_driven_filter(rows.limit(0), rules, "k", "condition").collect() == []


def test_thousands_of_predicates_are_one_pass(spark):
    rows = spark.range(20_000).selectExpr("cast(id % 6000 as string) as k", "id as v", "concat('n', id % 7) as name")
    rules = spark.range(5000).selectExpr("cast(id as string) as k", "concat('v > ', id + 10, ' and name in (''n1'', ''n', id % 7, ''')') as condition")
    got = J.data_driven_filter(rows, rules, "k", "condition")
    want = {v for v in range(20_000) if v % 6000 < 5000 and v > v % 6000 + 10 and f"n{v % 7}" in ("n1", f"n{v % 6000 % 7}")}
    assert {r.v for r in got.collect()} == want and want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "CASE WHEN (__rule" not in plan

"""Keyed lookup tables, dictionaries, the rule catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconflow.operators import aggregates as A
from beaconflow.operators import keyed_table as U
from beaconflow.operators import registers as W
from beaconflow.plans.catalogue import rule_catalogue
from beaconflow.session import new_shared_path, shared_table
from beaconflow.sources import keyed_export as X
from beaconflow.sources.dimensions import read_dimension
from beaconflow.sources.lookup_text import read_lookup_text
from queryset import query
from queryset.views import table

FIELDS = {"name": "c_name", "segment": "c_mktsegment"}

# The customers as a keyed table; each change below starts from it.
_STORE = """
, store AS (SELECT 'userinfo:' || CAST(c_custkey AS VARCHAR) AS hash_key, 'name' AS field, c_name AS value FROM customer
            UNION ALL SELECT 'userinfo:' || CAST(c_custkey AS VARCHAR), 'segment', c_mktsegment FROM customer),
feed AS (SELECT 'userinfo:' || CAST(o_custkey AS VARCHAR) AS hash_key, o_orderkey AS seq, o_orderstatus AS flag,
                'order' || CAST(o_orderkey AS VARCHAR) AS name, o_orderpriority AS segment FROM orders),
"""
_LATEST = """
latest AS (SELECT hash_key, arg_max(name, seq) AS name, arg_max(segment, seq) AS segment FROM changes GROUP BY hash_key),
written AS (SELECT hash_key, 'name' AS field, name AS value FROM latest
            UNION ALL SELECT hash_key, 'segment', segment FROM latest)
SELECT hash_key, field, value FROM written
UNION ALL SELECT hash_key, field, value FROM kept
WHERE (hash_key, field) NOT IN (SELECT (hash_key, field) FROM written)"""


def store(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("seq", F.lit(0))
    return U.upsert_multihash(None, customers, ["c_custkey"], FIELDS, prefix="userinfo:")


def feed(spark, sf_dir):
    return order_feed(table(spark, sf_dir, "orders"))


def order_feed(orders):
    return orders.selectExpr(
        "o_custkey", "o_orderkey as seq", "o_orderstatus as flag", "concat('order', o_orderkey) as c_name",
        "o_orderpriority as c_mktsegment",
    )


def _key():
    return U.key_of(["o_custkey"], prefix="userinfo:")


@query("upsert_multihash", _STORE + "changes AS (SELECT * FROM feed), kept AS (SELECT * FROM store)," + _LATEST)
def upsert_multihash(spark, sf_dir):
    return U.upsert_multihash(store(spark, sf_dir), feed(spark, sf_dir), ["o_custkey"], FIELDS, prefix="userinfo:")


_APPEND = """
SELECT hash_key, field, value FROM store WHERE field = 'name'
UNION ALL
SELECT hash_key, 'segment' AS field,
       CASE WHEN c_mktsegment IS NULL THEN string_agg(segment, '#' ORDER BY seq)
            ELSE c_mktsegment || coalesce('#' || string_agg(segment, '#' ORDER BY seq) FILTER (segment <> c_mktsegment), '')
       END AS value
FROM (SELECT 'userinfo:' || CAST(c_custkey AS VARCHAR) AS hash_key, c_mktsegment FROM customer)
FULL JOIN (SELECT hash_key, segment, min(seq) AS seq FROM feed GROUP BY ALL) USING (hash_key)
GROUP BY hash_key, c_mktsegment"""


@query("upsert_multihash_append", _STORE.rstrip().rstrip(",") + _APPEND)
def upsert_append(spark, sf_dir):
    return U.upsert_multihash(
        store(spark, sf_dir), feed(spark, sf_dir), ["o_custkey"], {"segment": "c_mktsegment"}, prefix="userinfo:",
        overwrite=False, append_sep="#",
    )


@query("merge_distinct", """
SELECT 'part:' || CAST(l_partkey AS VARCHAR) AS hash_key, 'flags' AS field, string_agg(l_returnflag, ',' ORDER BY seq, l_returnflag) AS value
FROM (SELECT l_partkey, l_returnflag, min(l_orderkey * 100000 + l_suppkey) AS seq FROM lineitem GROUP BY ALL)
GROUP BY l_partkey""")
def merge_distinct(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('part:', l_partkey) as hash_key", "'flags' as field", "l_returnflag as value",
        "l_orderkey * 100000 + l_suppkey as seq",
    )
    return A.merge_distinct(rows)


@query("upsert_onehash", """
, written AS (SELECT CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS field,
                     arg_max(l_returnflag || '#' || l_linestatus, l_partkey * 1000000 + l_suppkey) AS value
              FROM lineitem GROUP BY ALL)
SELECT 'lines' AS hash_key, field, value FROM written""")
def upsert_onehash(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("seq", F.expr("l_partkey * 1000000 + l_suppkey"))
    return U.upsert_onehash(
        None, rows, "lines", ["l_orderkey", "l_linenumber"], ["l_returnflag", "l_linestatus"], value_sep="#"
    )


_PART_VALUES = """
, p AS (SELECT p_partkey, printf('%04X', p_partkey) || ':' || printf('%04X', p_size) AS k,
               CASE WHEN p_size IN (1, 3, 5, 7) THEN 'WLAN' END AS w, p_brand FROM part)
"""


@query("upsert_area_map", _PART_VALUES + """
SELECT 'lacci2area:' || k AS hash_key, 'areas' AS field, concat_ws('|', w, p_brand) AS value FROM p
UNION ALL SELECT 'lacci2area:' || k, 'wlan', w FROM p WHERE w IS NOT NULL""")
def upsert_area_map(spark, sf_dir):
    wlan = U.MappedValue("p_size", ("1", "3", "5", "7"), "WLAN")
    return U.upsert_area_map(
        None, table(spark, sf_dir, "part").withColumn("seq", F.lit(0)), ["p_partkey", "p_size"],
        {"areas": [wlan, "p_brand"], "wlan": wlan}, prefix="lacci2area:", hex_columns=["p_partkey", "p_size"],
        value_sep="|",
    )


@query("upsert_area_onehash", _PART_VALUES + """
SELECT 'areamap' AS hash_key, k AS field, w AS value FROM p WHERE w IS NOT NULL""")
def upsert_area_onehash(spark, sf_dir):
    return U.upsert_onehash(
        None, table(spark, sf_dir, "part").withColumn("seq", F.lit(0)), "areamap", ["p_partkey", "p_size"],
        U.MappedValue("p_size", ("1", "3", "5", "7"), "WLAN"), hex_columns=["p_partkey", "p_size"], skip_empty=True,
    )


FLAGS = U.ChangeFlags(insert="O", update="P", delete="F")


@query("apply_changes", _STORE + """
changes AS (SELECT * FROM feed WHERE flag IN ('O', 'P')),
kept AS (SELECT * FROM store WHERE hash_key NOT IN (SELECT hash_key FROM feed WHERE flag = 'F')),""" + _LATEST)
def apply_changes(spark, sf_dir):
    return U.apply_changes(store(spark, sf_dir), feed(spark, sf_dir), _key(), FIELDS, "flag", FLAGS)


@query("apply_changes_fields", _STORE + """
changes AS (SELECT hash_key, seq, flag, name, CAST(NULL AS VARCHAR) AS segment FROM feed WHERE flag = 'P'),
kept AS (SELECT * FROM store WHERE NOT (field = 'name' AND hash_key IN (SELECT hash_key FROM feed WHERE flag = 'F'))),
latest AS (SELECT hash_key, arg_max(name, seq) AS name FROM changes GROUP BY hash_key),
written AS (SELECT hash_key, 'name' AS field, name AS value FROM latest)
SELECT hash_key, field, value FROM written
UNION ALL SELECT hash_key, field, value FROM kept
WHERE (hash_key, field) NOT IN (SELECT (hash_key, field) FROM written)""")
def apply_changes_fields(spark, sf_dir):
    """Inserts switched off, deletes limited to the named field."""
    flags = U.ChangeFlags(insert=None, update="P", delete="F")
    return U.apply_changes(
        store(spark, sf_dir), feed(spark, sf_dir), _key(), {"name": "c_name"}, "flag", flags, delete_mode="fields"
    )


@query("apply_changes_full", _STORE + "changes AS (SELECT * FROM feed), kept AS (SELECT * FROM store)," + _LATEST)
def apply_changes_full(spark, sf_dir):
    """Flags ignored: every row is loaded."""
    return U.apply_changes(
        store(spark, sf_dir), feed(spark, sf_dir), _key(), FIELDS, "flag", FLAGS, increment=False
    )


@query("apply_changes_onehash", """
, store AS (SELECT CAST(c_custkey AS VARCHAR) AS field, c_name AS value FROM customer),
latest AS (SELECT CAST(o_custkey AS VARCHAR) AS field, arg_max('order' || CAST(o_orderkey AS VARCHAR), o_orderkey) AS value
           FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY ALL),
gone AS (SELECT CAST(o_custkey AS VARCHAR) AS field FROM orders WHERE o_orderstatus = 'F')
SELECT 'users' AS hash_key, field, value FROM latest
UNION ALL SELECT 'users', field, value FROM store
WHERE field NOT IN (SELECT field FROM gone) AND field NOT IN (SELECT field FROM latest)""")
def apply_changes_onehash(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("seq", F.lit(0))
    before = U.upsert_onehash(None, customers, "users", ["c_custkey"], "c_name")
    return U.apply_changes(
        before, feed(spark, sf_dir), U.key_of(["o_custkey"]), {"user": "c_name"}, "flag", FLAGS, onehash="users"
    )


# Each change counts at its own seq: a field lives if it was written after the last delete of its record.
RUNS = _STORE.rstrip().rstrip(",") + """,
gone AS (SELECT hash_key, max(seq) AS seq FROM feed WHERE flag = 'F' GROUP BY hash_key),
writes AS (SELECT hash_key, field, value, 0 AS seq FROM store
           UNION ALL SELECT hash_key, 'name', name, seq FROM feed WHERE flag IN ('O', 'P')
           UNION ALL SELECT hash_key, 'segment', segment, seq FROM feed WHERE flag IN ('O', 'P')),
last AS (SELECT hash_key, field, arg_max(value, seq) AS value, max(seq) AS seq FROM writes GROUP BY hash_key, field)
SELECT hash_key, field, value FROM last LEFT JOIN gone USING (hash_key) WHERE gone.seq IS NULL OR last.seq >= gone.seq"""


def store_state(spark, sf_dir):
    return W.merge_registers(W.written(store(spark, sf_dir).withColumn("seq", F.lit(0))))


def order_changes(rows):
    return W.change_state(rows, _key(), FIELDS, "flag", FLAGS)


@query("apply_changes_runs", RUNS)
def apply_changes_runs(spark, sf_dir):
    """The feed in four runs, out of order and one of them twice, each merged into the state that the last one stored."""
    rows = feed(spark, sf_dir).withColumn("run", F.pmod(F.xxhash64("seq"), F.lit(4)))
    state = store_state(spark, sf_dir)
    for run in (2, 0, 3, 0, 1):
        state = shared_table(W.compacted(W.merge_registers(state, order_changes(rows.where(F.col("run") == run)))), "registers")
    return W.current(state)


@query("apply_changes_unknown", "SELECT count(*) AS num_unknown FROM orders WHERE o_orderstatus NOT IN ('F', 'P')")
def apply_changes_unknown(spark, sf_dir):
    return U.unknown_changes(feed(spark, sf_dir), "flag", U.ChangeFlags(insert=None, update="P", delete="F"))


@query("delete_keys", _STORE.rstrip().rstrip(",") + """
SELECT hash_key, field, value FROM store WHERE hash_key NOT IN (SELECT hash_key FROM feed WHERE flag = 'F')""")
def delete_keys(spark, sf_dir):
    gone = feed(spark, sf_dir).where("flag = 'F'").select(_key().alias("hash_key"))
    return U.delete_keys(store(spark, sf_dir), gone)


@query("delete_fields", _STORE.rstrip().rstrip(",") + """
SELECT hash_key, field, value FROM store
WHERE NOT (field = 'segment' AND hash_key IN (SELECT hash_key FROM feed WHERE flag = 'F'))""")
def delete_fields(spark, sf_dir):
    gone = feed(spark, sf_dir).where("flag = 'F'").select(_key().alias("hash_key"), F.lit("segment").alias("field"))
    return U.delete_fields(store(spark, sf_dir), gone)


@query("export_lookup", _STORE.rstrip().rstrip(",") + """
SELECT hash_key, max(value) FILTER (field = 'name') AS name, max(value) FILTER (field = 'segment') AS segment
FROM store WHERE hash_key LIKE 'userinfo:%1%7' GROUP BY hash_key""")
def export_lookup(spark, sf_dir):
    return X.export_lookup(store(spark, sf_dir), ["segment", "name"], prefix="userinfo:", mid="1", suffix="7")


@query("matching_keys", _STORE.rstrip().rstrip(",") + """
SELECT DISTINCT hash_key FROM store WHERE hash_key LIKE 'userinfo:%9'""")
def matching_keys(spark, sf_dir):
    return X.matching_keys(store(spark, sf_dir), prefix="userinfo:", suffix="9")


def _written(spark, lines, name):
    path = new_shared_path(spark, name)
    lines.write.text(path)
    return path


@query("read_lookup_list", """
SELECT 'brand:' AS kind, p_brand AS key, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS values FROM part
GROUP BY p_brand""")
def read_lookup_list(spark, sf_dir):
    lines = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.concat("p_brand", F.lit(":"), F.array_join(F.array_sort(F.collect_set("p_type")), ",")).alias("value")
    ).select("value")
    parsed = read_lookup_text(spark, _written(spark, lines, "lookup-list"), "list")
    return parsed.select(F.lit("brand:").alias("kind"), "key", F.array_join("values", ",").alias("values"))


@query("read_lookup_map", "SELECT CAST(p_partkey AS VARCHAR) AS key, p_brand AS brand, p_type AS type FROM part")
def read_lookup_map(spark, sf_dir):
    lines = table(spark, sf_dir, "part").selectExpr(
        "concat(p_partkey, ':brand,', p_brand, ':type,', p_type) as value"
    )
    parsed = read_lookup_text(spark, _written(spark, lines, "lookup-map"), "map")
    return parsed.select("key", F.col("entries")["brand"].alias("brand"), F.col("entries")["type"].alias("type"))


@query("read_lookup_value", """
SELECT 'lacci2area' AS cache, CAST(s_suppkey AS VARCHAR) || ',' || CAST(s_nationkey AS VARCHAR) AS key, s_name AS value
FROM supplier""")
def read_lookup_value(spark, sf_dir):
    lines = table(spark, sf_dir, "supplier").selectExpr(
        "concat('lacci2area:', s_suppkey, ',', s_nationkey, ':', s_name) as value"
    )
    return read_lookup_text(spark, _written(spark, lines, "lookup-value"), "value")


@query("read_dimension", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment FROM customer")
def read_dimension_query(spark, sf_dir):
    lines = table(spark, sf_dir, "customer").selectExpr(
        "concat_ws('|+|', c_custkey, c_name, concat(' ', c_mktsegment, ' '), 'x', '') as value"
    )
    path = _written(spark, lines, "dimension")
    return read_dimension(spark, "file", path=path, columns={"id": 0, "segment": 2}, delim="|+|")


@query("pivot_properties", "SELECT p_partkey, p_brand AS brand, p_type AS type, CAST(p_size AS VARCHAR) AS size FROM part")
def pivot_properties(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "stack(3, 'brand', p_brand, 'type', p_type, 'size', cast(p_size as string)) as (name, pvalue)"
    )
    out = A.pivot_properties(rows, ["p_partkey"])
    return out.select("p_partkey", *[F.col("properties")[n].alias(n) for n in ("brand", "type", "size")])


def catalogue_tables(spark, sf_dir):
    """The given tables in the roles of the catalogue's administration tables."""
    t = {n: table(spark, sf_dir, n) for n in ("nation", "supplier", "customer", "orders", "lineitem")}
    bought = t["orders"].join(t["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"))
    return {
        "EventSource": t["nation"].selectExpr("n_nationkey as id", "n_name as name", "n_regionkey <> 2 as enabled"),
        "EventSourceProp": t["customer"].groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n")).selectExpr(
            "c_nationkey as esourceid", "c_mktsegment as name", "cast(n as string) as pvalue"
        ),
        "LabelRules": t["supplier"].selectExpr("s_suppkey as id", "s_nationkey as esourceid", "s_name as classname",
                                               "s_acctbal > 0 as enabled"),
        "LabelRulesProp": t["lineitem"].groupBy("l_suppkey", "l_returnflag").agg(
            F.max("l_linestatus").alias("v")).selectExpr("l_suppkey as lrid", "l_returnflag as name", "v as pvalue"),
        "EventRules": t["supplier"].selectExpr("s_suppkey as id", "s_nationkey as esourceid", "s_name as classname",
                                               "s_acctbal > 1000 as enabled"),
        "EventRulesProp": t["lineitem"].groupBy("l_suppkey", "l_linestatus").agg(
            F.max("l_returnflag").alias("v")).selectExpr("l_suppkey as erid", "l_linestatus as name", "v as pvalue"),
        "BusenessEvents": t["customer"].selectExpr("c_custkey as id", "c_name as name", "c_acctbal > 0 as enabled"),
        "BusenessEventsProp": t["orders"].groupBy("o_custkey", "o_orderstatus").agg(
            F.max("o_orderpriority").alias("v")).selectExpr("o_custkey as beid", "o_orderstatus as name", "v as pvalue"),
        "BusenessEventsMapEventRules": bought.selectExpr("o_custkey as beid", "l_suppkey as erid").distinct(),
        "BusenessEventsMapEventSources": t["customer"].selectExpr("c_custkey as beid", "c_nationkey as esid"),
    }


_CATALOGUE = """
, src AS (SELECT n_nationkey AS id FROM nation WHERE n_regionkey <> 2),
be AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal > 0),
lr AS (SELECT s_suppkey AS id, s_nationkey AS esourceid, s_name AS classname FROM supplier
       WHERE s_acctbal > 0 AND s_nationkey IN (SELECT id FROM src)),
er AS (SELECT s_suppkey AS id FROM supplier WHERE s_acctbal > 1000)
"""


@query("rule_catalogue", _CATALOGUE + """
, p AS (SELECT l_suppkey, max(l_linestatus) FILTER (l_returnflag = 'A') AS a, max(l_linestatus) FILTER (l_returnflag = 'R') AS r
        FROM lineitem GROUP BY l_suppkey)
SELECT id, esourceid, classname, a AS prop_a, r AS prop_r FROM lr LEFT JOIN p ON l_suppkey = id""")
def catalogue_label_rules(spark, sf_dir):
    rules = rule_catalogue(catalogue_tables(spark, sf_dir)).label_rules
    return rules.select(
        "id", "esourceid", "classname", F.col("properties")["A"].alias("prop_a"), F.col("properties")["R"].alias("prop_r")
    )


@query("rule_catalogue_sources", _CATALOGUE + """
, p AS (SELECT c_nationkey, CAST(count(*) FILTER (c_mktsegment = 'BUILDING') AS VARCHAR) AS b FROM customer GROUP BY ALL)
SELECT id, nullif(b, '0') AS building FROM src LEFT JOIN p ON c_nationkey = id""")
def catalogue_sources(spark, sf_dir):
    sources = rule_catalogue(catalogue_tables(spark, sf_dir)).sources
    return sources.select("id", F.col("properties")["BUILDING"].alias("building"))


@query("rule_catalogue_links", _CATALOGUE + """
SELECT DISTINCT o_custkey AS beid, l_suppkey AS erid FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE o_custkey IN (SELECT id FROM be) AND l_suppkey IN (SELECT id FROM er)""")
def catalogue_links(spark, sf_dir):
    return rule_catalogue(catalogue_tables(spark, sf_dir)).event_rule_links


@query("rule_catalogue_business", _CATALOGUE + """
, p AS (SELECT o_custkey, max(o_orderpriority) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY o_custkey)
SELECT id, f AS prop_f FROM be LEFT JOIN p ON o_custkey = id""")
def catalogue_business(spark, sf_dir):
    events = rule_catalogue(catalogue_tables(spark, sf_dir)).business_events
    return events.select("id", F.col("properties")["F"].alias("prop_f"))


@query("rule_catalogue_event_rules", _CATALOGUE + """
, p AS (SELECT l_suppkey, max(l_returnflag) FILTER (l_linestatus = 'F') AS f, max(l_returnflag) FILTER (l_linestatus = 'O') AS o
        FROM lineitem GROUP BY l_suppkey)
SELECT s_suppkey AS id, s_nationkey AS esourceid, f AS prop_f, o AS prop_o FROM supplier LEFT JOIN p ON l_suppkey = s_suppkey
WHERE s_suppkey IN (SELECT id FROM er) AND s_nationkey IN (SELECT id FROM src)""")
def catalogue_event_rules(spark, sf_dir):
    rules = rule_catalogue(catalogue_tables(spark, sf_dir)).event_rules
    return rules.select(
        "id", "esourceid", F.col("properties")["F"].alias("prop_f"), F.col("properties")["O"].alias("prop_o")
    )


@query("rule_catalogue_source_links", _CATALOGUE + """
SELECT c_custkey AS beid, c_nationkey AS esid FROM customer
WHERE c_custkey IN (SELECT id FROM be) AND c_nationkey IN (SELECT id FROM src)""")
def catalogue_source_links(spark, sf_dir):
    return rule_catalogue(catalogue_tables(spark, sf_dir)).event_source_links


@query("record_fields", "SELECT CAST(c_custkey AS VARCHAR) AS field, c_name AS value FROM customer")
def record_fields(spark, sf_dir):
    """One record that holds a whole table, beside the records of the store."""
    customers = table(spark, sf_dir, "customer").withColumn("seq", F.col("c_custkey").cast("long"))
    records = U.upsert_onehash(store(spark, sf_dir), customers, "customers", ["c_custkey"], "c_name")
    return X.record_fields(records, "customers")


@query("export_records", """
SELECT 'userinfo:' || CAST(c_custkey AS VARCHAR) AS hash_key, 'name' AS field, c_name AS value FROM customer
UNION ALL SELECT 'userinfo:' || CAST(c_custkey AS VARCHAR), 'segment', c_mktsegment FROM customer""")
def export_records(spark, sf_dir):
    return X.export_records(store(spark, sf_dir), prefix="userinfo:")

"""The rule catalogue: enabled sources, rules and business events with their properties.

The catalogue is a handful of administration tables. Each has ``id`` and an
``enabled`` flag, properties are rows (owner id, name, pvalue) that may be
missing altogether.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconflow.operators.aggregates import pivot_properties


@dataclass(frozen=True)
class Catalogue:
    sources: DataFrame
    label_rules: DataFrame
    event_rules: DataFrame
    business_events: DataFrame
    event_rule_links: DataFrame
    event_source_links: DataFrame


def with_properties(entities: DataFrame, props: DataFrame, owner: str) -> DataFrame:
    """Each entity with a map of its properties, empty when it has none."""
    maps = pivot_properties(props.withColumnRenamed(owner, "__owner"), ["__owner"])
    joined = entities.join(maps, entities["id"] == maps["__owner"], "left").drop("__owner")
    empty = F.create_map().cast(maps.schema["properties"].dataType)
    return joined.withColumn("properties", F.coalesce("properties", empty))


def enabled(entities: DataFrame) -> DataFrame:
    return entities.where(F.col("enabled").cast("int") == 1).drop("enabled")


def enabled_sources(sources: DataFrame, props: DataFrame) -> DataFrame:
    return with_properties(enabled(sources), props, "esourceid")


def rules_of_sources(rules: DataFrame, props: DataFrame, owner: str, sources: DataFrame) -> DataFrame:
    """Enabled rules of enabled sources."""
    live = enabled(sources).select(F.col("id").alias("esourceid"))
    return with_properties(enabled(rules).join(live, "esourceid"), props, owner)


def links_between(links: DataFrame, left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """The rows of a mapping table whose both ends are enabled."""
    return (
        links.select(left_key, right_key)
        .join(enabled(left).select(F.col("id").alias(left_key)), left_key)
        .join(enabled(right).select(F.col("id").alias(right_key)), right_key)
        .select(left_key, right_key)
    )


# The names of the administration tables.
TABLES = (
    "EventSource", "EventSourceProp", "LabelRules", "LabelRulesProp", "EventRules", "EventRulesProp", "BusenessEvents",
    "BusenessEventsProp", "BusenessEventsMapEventRules", "BusenessEventsMapEventSources",
)


def rule_catalogue(tables: dict[str, DataFrame]) -> Catalogue:
    """All parts of the catalogue in numeric order of their ids, from the tables named in ``TABLES``."""
    missing = [name for name in TABLES if name not in tables]
    if missing:
        raise ValueError(f"the catalogue lacks the tables {missing}")
    t = tables
    return Catalogue(
        sources=enabled_sources(t["EventSource"], t["EventSourceProp"]).orderBy("id"),
        label_rules=rules_of_sources(t["LabelRules"], t["LabelRulesProp"], "lrid", t["EventSource"]).orderBy(
            "esourceid", "id"
        ),
        event_rules=rules_of_sources(t["EventRules"], t["EventRulesProp"], "erid", t["EventSource"]).orderBy(
            "esourceid", "id"
        ),
        business_events=with_properties(enabled(t["BusenessEvents"]), t["BusenessEventsProp"], "beid").orderBy("id"),
        event_rule_links=links_between(
            t["BusenessEventsMapEventRules"], t["BusenessEvents"], "beid", t["EventRules"], "erid"
        ),
        event_source_links=links_between(
            t["BusenessEventsMapEventSources"], t["BusenessEvents"], "beid", t["EventSource"], "esid"
        ),
    )

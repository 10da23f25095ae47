"""Flat dictionary files in three layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconflow.functions.text import split_fields


def parse_lookup_lines(lines: DataFrame, layout: str, delim: str = ":") -> DataFrame:
    """``list``: key, values array. ``map``: key, entries map. ``value``: cache, key, value."""
    parts = lines.select(split_fields(F.col("value"), delim).alias("p"))

    def part(i: int):
        return F.get("p", F.lit(i))

    if layout == "list":
        return parts.where(F.size("p") >= 2).select(
            part(0).alias("key"), split_fields(part(1), ",").alias("values")
        )
    if layout == "map":
        pairs = F.transform(F.slice("p", 2, F.size("p")), lambda e: F.split(e, ","))
        pairs = F.filter(pairs, lambda e: F.size(e) >= 2)
        # A repeated field keeps its last value: sort by (name, place), keep the last of each name.
        placed = F.array_sort(F.transform(pairs, lambda e, i: F.struct(e[0].alias("name"), i.alias("place"), e[1].alias("value"))))
        rows = parts.select(part(0).alias("key"), placed.alias("e"))
        last = F.filter("e", lambda e, i: ~F.coalesce(F.get("e", i + 1)["name"] == e["name"], F.lit(False)))
        entries = F.map_from_entries(F.transform(last, lambda e: F.struct(e["name"], e["value"])))
        return rows.select("key", entries.alias("entries"))
    if layout == "value":
        return parts.where(F.size("p") >= 3).select(
            part(0).alias("cache"), part(1).alias("key"), part(2).alias("value")
        )
    raise ValueError(f"unknown lookup layout {layout!r}")


def read_lookup_text(spark: SparkSession, path: str, layout: str, delim: str = ":") -> DataFrame:
    return parse_lookup_lines(spark.read.text(path), layout, delim)

"""Map expressions for labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRING_MAP = "map<string,string>"


def empty_map() -> Column:
    return F.create_map().cast(STRING_MAP)


def map_union(left: Column, right: Column) -> Column:
    """All entries of both maps; on equal keys the right one wins."""
    rest = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(rest, right)


def present_entries(columns: dict[str, Column]) -> Column:
    """A map of the named columns without the null ones."""
    if not columns:
        return empty_map()
    pairs = [x for name, c in columns.items() for x in (F.lit(name), c.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())

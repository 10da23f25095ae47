"""Labels and filters that come from lookup tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconflow.constants import ANONYMOUS_ID, AREA_INFO, AREA_ONSITE, USER_INFO
from beaconflow.functions.maps import empty_map, map_union, present_entries
from beaconflow.operators.predicates import Predicates
from beaconflow.operators.skew import DEFAULT_SKEW, HotKeys, Skew, detect_together, fits_broadcast, lookup_join


_PLACE = ("geo_longitude", "geo_latitude")


def site_key(lac: Column, ci: Column) -> Column:
    return F.concat_ws(":", lac, ci)


def area_flags(areas: Column) -> Column:
    """A comma list of area names as a map area -> "true"."""
    names = F.transform(F.split(F.coalesce(areas, F.lit("")), ","), lambda a: F.trim(a))
    names = F.array_distinct(F.filter(names, lambda a: a != ""))
    return F.map_from_entries(F.transform(names, lambda a: F.struct(a, F.lit("true"))))


def label_site(
    records: DataFrame,
    sites: DataFrame,
    small: bool | None = None,
    skew: Skew | HotKeys | None = DEFAULT_SKEW,
    geo: bool = False,
) -> DataFrame:
    """Area flags and area information of the record's cell, with ``geo`` also what :func:`label_geo` adds, in one join.

    ``skew`` may name hot cells already known by their ``site_key``.

    ``sites`` has ``lac``, ``ci``, ``areas`` (comma list) and any further columns,
    which become the area information together with ``lac_ci``.
    """
    others = [c for c in sites.columns if c not in ("lac", "ci", "areas")]
    own = F.create_map(F.lit("lac_ci"), F.concat("lac", "ci"))
    # Both maps are made once per cell rather than once per record.
    table = sites.select(
        site_key(F.col("lac"), F.col("ci")).alias("__cell"),
        area_flags(F.col("areas")).alias("__flags"),
        map_union(present_entries({c: F.col(c) for c in others}), own).alias("__info"),
        *[F.col(c).cast("string").alias(c) for c in _PLACE if geo],
    )
    joined = lookup_join(
        records.withColumn("__cell", site_key(F.col("lac"), F.col("ci"))), table, "__cell", small=small, skew=skew
    )
    return joined.withColumns(
        {
            AREA_ONSITE: F.coalesce("__flags", empty_map()),
            AREA_INFO: F.coalesce("__info", own),
            **{c: F.coalesce(F.col(c), F.lit("0")) for c in _PLACE if geo},
        }
    ).drop("__cell", "__flags", "__info")


def label_profile(
    records: DataFrame,
    profiles: DataFrame,
    columns: list[str],
    key: str = "imsi",
    small: bool | None = None,
    skew: Skew | None = DEFAULT_SKEW,
) -> DataFrame:
    """Profiles of both parties: the subject's under plain names, the other's prefixed.

    The other party counts only when both ids are usable and differ. Hot ids of
    both are found in one pass over the records, before either join.
    """
    calling, called, subject = F.col("callingimsi"), F.col("calledimsi"), F.col("imsi")
    usable = (calling != ANONYMOUS_ID) & (called != ANONYMOUS_ID) & (calling != called)
    other = F.when(usable, F.when(subject == calling, called).otherwise(calling))

    if small is None:
        small = fits_broadcast(profiles.select(key, *columns))

    def side(alias: str) -> DataFrame:
        entries = present_entries({c: F.col(c) for c in columns})
        return profiles.select(F.col(key).alias(f"__{alias}"), entries.alias(f"__{alias}_map"))

    keyed = records.withColumns(
        {"__own": F.when(subject != ANONYMOUS_ID, subject), "__other": other}
    )
    hot: dict[str, HotKeys | None] = {"__own": None, "__other": None}
    if not small and skew is not None and not records.isStreaming:
        hot |= detect_together(keyed, list(hot), skew)
    joined = lookup_join(keyed, side("own"), "__own", small=small, skew=hot["__own"])
    joined = lookup_join(joined, side("other"), "__other", small=small, skew=hot["__other"])
    prefix = F.when(F.col("__other") == called, "called_").otherwise("calling_")
    prefixed = F.transform_keys("__other_map", lambda name, _: F.concat(prefix, name))
    info = F.map_concat(F.coalesce("__own_map", empty_map()), F.coalesce(prefixed, empty_map()))
    return joined.withColumn(USER_INFO, info).drop("__own", "__other", "__own_map", "__other_map")


def label_geo(
    records: DataFrame, sites: DataFrame, small: bool | None = None, skew: Skew | HotKeys | None = DEFAULT_SKEW
) -> DataFrame:
    """Coordinates of the record's cell as text, "0" where unknown."""
    table = sites.select(
        site_key(F.col("lac"), F.col("ci")).alias("__cell"),
        *[F.col(c).cast("string").alias(c) for c in _PLACE],
    )
    joined = lookup_join(
        records.withColumn("__cell", site_key(F.col("lac"), F.col("ci"))), table, "__cell", small=small, skew=skew
    )
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit("0")) for c in _PLACE}
    ).drop("__cell")


#: Bits of the filter for each needed key (about one key in 30 passes by mistake), and the most bytes it may have.
FILTER_BITS, FILTER_BYTES = 32, 256 << 20
#: Bits of one row of a filter, as Spark's bitmap functions cut them.
BITMAP = 32_768


def key_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int] | None:
    """(part, bits) rows of a Bloom filter of the keys with one hash, and its size in bits; ``None`` if it would be too large.

    Bits are set by the tasks and joined by parts, so the driver holds nothing
    but an approximate number of keys, from which the size follows.
    """
    n = keys.agg(F.approx_count_distinct(key)).first()[0]
    bits = max(1, -(-n * FILTER_BITS // BITMAP)) * BITMAP
    if bits // 8 > FILTER_BYTES:
        return None
    place = _place(key, bits)
    parts = keys.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("__part"))
    return parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__bits")), bits


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(41), key), F.lit(bits)) + 1


def passing(rows: DataFrame, found: tuple[DataFrame, int], key: str) -> DataFrame:
    """The rows whose key the filter holds, and few others; no shuffle of the rows."""
    parts, bits = found
    place = _place(key, bits)
    marked = rows.withColumns({"__part": F.bitmap_bucket_number(place), "__at": F.bitmap_bit_position(place).cast("int")})
    joined = marked.join(F.broadcast(parts), "__part")
    byte = F.conv(F.hex(F.substring("__bits", F.expr("cast(__at div 8 as int)") + 1, F.lit(1))), 16, 10).cast("long")
    return joined.where(F.getbit(byte, F.col("__at") % 8) == 1).drop("__part", "__at", "__bits")


def needed_keys(
    records: DataFrame, keys: list[Column], dimension: DataFrame, dimension_key: str, small: bool | None = None
) -> DataFrame:
    """The part of a large dimension that a batch refers to, over all key expressions.

    Few keys (measured unless ``small`` says so) are broadcast. Of many, a Bloom
    filter is, which drops most of the dimension before its shuffle; keys too
    many for that meet the whole dimension by shuffle.
    """
    wanted = (
        records.select(F.explode(F.array(*keys)).alias(dimension_key))
        .where(F.col(dimension_key).isNotNull())
        .distinct()
    )
    if small is None:
        small = fits_broadcast(wanted)
    if not small and (found := key_filter(wanted, dimension_key)):
        dimension = passing(dimension, found, dimension_key)
    return lookup_join(dimension, wanted, dimension_key, "left_semi", small=small, skew=None)


@dataclass(frozen=True)
class LookupStep:
    """One enrich-and-filter step; looked-up columns appear as ``<name>__<column>``."""

    name: str
    table: DataFrame
    on: dict[str, str]
    columns: list[str]
    where: str | None = None
    output: list[str] = field(default_factory=list)


def _step_key(columns: list[str]) -> Column:
    """One comparable key of one or more columns; null if any of them is."""
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    complete = F.coalesce(*[F.when(t.isNull(), False) for t in texts], F.lit(True))
    return F.when(complete, F.to_json(F.array(*texts)))


def enrich_and_filter(rows: DataFrame, steps: list[LookupStep]) -> DataFrame:
    """A chain of lookups: join, keep the rows satisfying ``where``, project ``output``."""
    for step in steps:
        side = step.table.select(
            _step_key(list(step.on.values())).alias("__key"),
            *[F.col(c).alias(f"{step.name}__{c}") for c in dict.fromkeys(step.columns)],
        )
        key = _step_key(list(step.on))
        rows = lookup_join(rows.withColumn("__key", key), side, "__key").drop("__key")
        if step.where:
            rows = rows.where(F.expr(step.where))
        if step.output:
            rows = rows.select(*step.output)
    return rows


def not_yet_processed(rows: DataFrame, processed: DataFrame, key: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """(first row of each key absent from ``processed``, the enlarged processed table)."""
    # One row per key first, so no hot key reaches the join.
    first = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), seq).alias("row")).select("row.*")
    known = processed.select(key).distinct()
    fresh = lookup_join(first, known, key, "left_anti", skew=None).select(*rows.columns)
    return fresh, processed.select(key).unionByName(fresh.select(key))


def data_driven_filter(
    rows: DataFrame, rules: DataFrame, on: str, condition: str, branches: int = 200
) -> DataFrame:
    """Keep a row if the predicate stored for its key in ``rules`` holds.

    Comparisons with stored values (see :class:`Predicates`) are parsed by the
    tasks and meet the rows as data, so their number is that of a join's rows.
    The distinct texts of all other predicates become the branches of CASE
    expressions of ``branches`` each, one pass for every so many. Keys without
    a rule, like rules that are not true, keep nothing.
    """
    stored = Predicates(rows)
    known = rules.select(on, F.col(condition).alias("__rule")).where(F.col("__rule").isNotNull())
    known = known.withColumn("__parts", stored.parsed(F.col("__rule")))
    plain = known.where(F.col("__parts").isNotNull()).drop("__rule")
    other = known.where(F.col("__parts").isNull()).drop("__parts")
    texts = sorted(r[0] for r in other.select("__rule").distinct().toLocalIterator())
    met = lookup_join(rows, plain, on, "inner")
    parts = [met.where(stored.holds(F.col("__parts"))).drop("__parts")]
    if texts:
        joined = lookup_join(rows, other, on, "inner")
    for i in range(0, len(texts), branches):
        some = texts[i : i + branches]
        verdict = F.when(F.lit(False), F.lit(False))
        for text in some:
            verdict = verdict.when(F.col("__rule") == text, F.expr(text))
        own = joined if len(texts) <= branches else joined.where(F.col("__rule").between(some[0], some[-1]))
        parts.append(own.where(verdict).drop("__rule"))
    return reduce(DataFrame.unionByName, parts)

"""Contiguous shards of least possible largest size over atomic groups."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconflow.session import shared_table

#: Hex digits of a group's key that the first bins go by, and that each refinement adds.
FIRST_DIGITS, MORE_DIGITS = 3, 1
#: Hex digits of a whole key.
ALL_DIGITS = 32


class Bin(NamedTuple):
    """Groups whose keys share a prefix; they follow each other in the order of keys."""

    prefix: str
    size: int
    groups: int


class Cuts:
    """Where shards of a capacity end, as far as bins can tell.

    Groups are packed greedily in their order. Inside a bin of several groups
    only bounds are known: at the least a shard ends at the bin's edge, at the
    most anywhere in it. Both bounds rise with the capacity.
    """

    def __init__(self, bins: list[Bin], shards: int):
        self.bins, self.shards = sorted(bins), shards
        self.edges = [0, *accumulate(b.size for b in self.bins)]
        self.total = self.edges[-1]

    def least(self, capacity: int) -> list[int]:
        ends, at = [], 0
        for _ in range(self.shards):
            at = self.edges[bisect_right(self.edges, at + capacity) - 1]
            ends.append(at)
        return ends

    def most(self, capacity: int) -> list[int]:
        ends, at = [], 0
        for _ in range(self.shards):
            at = min(at + capacity, self.total)
            inner = bisect_right(self.edges, at) - 1
            if inner < len(self.bins) and self.bins[inner].groups == 1:
                at = self.edges[inner]
            ends.append(at)
        return ends

    def smallest(self, ends) -> int:
        """The smallest capacity with which these ends reach the end of all groups, by binary search."""
        low, high = -(-self.total // self.shards), max(self.total, 1)
        while low < high:
            middle = (low + high) // 2
            if ends(middle)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def open_bins(self) -> list[str]:
        """Prefixes of the bins of several groups in which a shard of the best capacity might end."""
        low, high = self.smallest(self.most), self.smallest(self.least)
        found = set()
        for begin, end in zip(self.least(low), self.most(high), strict=True):
            first = bisect_right(self.edges, begin) - 1
            last = bisect_left(self.edges, end)
            found.update(b.prefix for b in self.bins[first:last] if b.groups > 1)
        return sorted(found)

    def boundaries(self) -> list[str]:
        """First prefix of every shard but the first; shards that stay empty at the end have none."""
        ends = self.least(self.smallest(self.least))
        return [self.bins[bisect_left(self.edges, e)].prefix for e in ends[:-1] if e < self.total]


def find_cuts(groups: DataFrame, shards: int) -> Cuts:
    """Exact cuts for ``groups`` (key, size), read in bins; only bins that a cut may fall in are split further.

    A few thousand bins are on the driver, however many groups there are.
    """

    def bins(digits: int, within: list[str] | None) -> list[Bin]:
        rows = groups
        if within is not None:
            by_length: dict[int, list[str]] = {}
            for p in within:
                by_length.setdefault(len(p), []).append(p)
            rows = rows.where(" or ".join(f"substring(key, 1, {n}) in ({', '.join(repr(p) for p in ps)})" for n, ps in by_length.items()))
        prefix = F.substring("key", 1, digits).alias("prefix")
        return [Bin(*r) for r in rows.groupBy(prefix).agg(F.sum("size"), F.count("*")).collect()]

    digits = FIRST_DIGITS
    cuts = Cuts(bins(digits, None), shards)
    while digits < ALL_DIGITS and (split := cuts.open_bins()):
        digits += MORE_DIGITS
        cuts = Cuts([b for b in cuts.bins if b.prefix not in set(split)] + bins(digits, split), shards)
    return cuts


def balanced_shards(documents: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each document.

    Size is the UTF-8 bytes of the text plus 1. Documents of equal texts are an
    atomic group; groups are ordered by the MD5 of the text and cut into
    contiguous shards whose largest is as small as it can be: a binary search
    for the smallest capacity, each checked by packing greedily. Slots number
    a shard's documents from 0 without gaps, by group and doc_id.

    Texts are hashed where they are read; only keys and sizes are shuffled,
    after pre-aggregation. A group of a third of all rows is one row to the
    search, and its documents are numbered in ranges of (group, doc_id).

    Null and empty texts are one group of size 1 each. Null doc_id: comes first
    in its group. Repeated rows: a slot each. Fewer groups than shards: the
    last shards stay empty. Empty table: empty result. Other columns are left
    out.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = shared_table(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1).cast("long")).alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("key")
        ),
        "sizes",
    )
    groups = shared_table(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    starts = find_cuts(groups, shards).boundaries()
    shard = sum((F.when(F.col("key") >= s, 1).otherwise(0) for s in starts), F.lit(0)).cast("int")

    # Partitions hold ranges of (group, doc_id, row), so a row's number is its
    # place in the partition plus the rows of its shard in partitions before.
    spread = rows.withColumn("shard", shard).withColumn("row", F.monotonically_increasing_id())
    spread = spread.repartitionByRange("key", "doc_id", "row").sortWithinPartitions("key", "doc_id", "row")
    spread = shared_table(spread.select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("place")), "ranges")
    part = F.shiftright("place", 33)
    parts = spread.groupBy(part.alias("part"), "shard").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = shared_table(parts.select("part", "shard", "first", F.coalesce(before, F.lit(0)).alias("before")), "parts")
    slot = F.col("place") - F.col("first") + F.col("before")
    return (
        spread.withColumn("part", part)
        .join(parts, ["part", "shard"])
        .select("doc_id", "size", "text_crc32", "shard", slot.cast("long").alias("slot"))
    )

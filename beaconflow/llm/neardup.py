"""MinHash near-duplicates with odd sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconflow.llm.graph import components
from beaconflow.llm.words import WordHashes, lower_words, sequence_hashes, small_batches
from beaconflow.session import shared_table

#: MinHash samples: BANDS bands of ROWS. A pair at 0.75 shares no band with probability (1 - 0.75**4)**32 = 5e-6.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch.
BITS = 1024
#: What the estimate may fall short by before a candidate is dropped. A pair at 0.75 has more differing bits with
#: probability 4.6e-7 (each differing sample throws two of BITS), so bands and sketch together lose 5.6e-6.
MARGIN = 0.22
#: Members of a bucket, and shingles of theirs, in one block of the second candidate search.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Ids of candidates that are broadcast to the scan of the texts; more are joined by shuffle.
BROADCAST_IDS = 1_000_000

_SKETCH = "doc_id long, text_hash long, n_shingles long, set_id binary, bands array<long>, sketch array<long>"


def shingle_set(words: list[bytes], cache: WordHashes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; fewer words are one shingle; no words, an empty set."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(sequence_hashes(cache.of(words), min(n, len(words))))


def _min_samples(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples, one row for each (non-empty) set."""
    values = np.concatenate(sets)
    low = (values ^ (values >> np.uint64(32))).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), SAMPLES), np.uint32)
    seeds = np.random.default_rng(7).integers(1, 2**32, (SAMPLES, 2), np.uint32)
    for k in range(SAMPLES):
        x = (low ^ seeds[k, 0]) * (seeds[k, 1] | np.uint32(1))
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def _fold(samples: np.ndarray) -> np.ndarray:
    """Odd sketches: each sample toggles one bit, so common samples cancel in an XOR."""
    mixed = (samples + np.arange(SAMPLES, dtype=np.uint32) * np.uint32(0x9E3779B1)) * np.uint32(0x85EBCA6B)
    place = ((mixed ^ (mixed >> np.uint32(16))) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS.bit_length() + 1)
    rows = np.repeat(np.arange(len(samples)), SAMPLES)
    odd = np.bincount(rows * BITS + place.ravel(), minlength=len(samples) * BITS).reshape(-1, BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def _band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(samples), BANDS), np.uint64)
    wide = samples.astype(np.uint64).reshape(len(samples), BANDS, ROWS)
    for r in range(ROWS):
        keys = (keys + wide[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(31)
    keys = (keys + np.arange(BANDS, dtype=np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return (keys ^ (keys >> np.uint64(32))).view(np.int64)


def estimate(differing_bits):
    """Similarity that an XOR of two odd sketches with so many set bits stands for (numpy)."""
    left = np.clip(1 - 2 * np.asarray(differing_bits) / BITS, 1e-9, None)
    return 1 + BITS / (4 * SAMPLES) * np.log(left)


def most_differing_bits(similarity: float) -> int:
    """The largest XOR count that an estimate of ``similarity`` or more can have."""
    return int(np.flatnonzero(estimate(np.arange(BITS // 2)) >= similarity).max())


def _sketches(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in small_batches(batches, "text", 1 << 19):
            sets = [shingle_set(lower_words(t), cache, n) for t in batch.column("text").to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            folds: list = [None] * len(sets)
            if full:
                samples = _min_samples([sets[i] for i in full])
                for i, keys, fold in zip(full, _band_keys(samples), _fold(samples), strict=True):
                    bands[i], folds[i] = keys, fold
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(folds, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n_shingles", "set_id", "bands", "sketch"],
            )

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in small_batches(batches, "text", 1 << 20):
            sets = [shingle_set(lower_words(t), cache, n).view(np.int64) for t in batch.column("text").to_pylist()]
            ids = [xxhash.xxh3_128_digest(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                ["doc_id", "set_id", "shingles"],
            )

    return run


def _full_sets(ids: DataFrame, nodes: DataFrame, documents: DataFrame, n: int) -> DataFrame:
    """(node, shingles) of these distinct node ids, computed anew from their texts."""
    ids = shared_table(ids.select(F.col("node").alias("doc_id")), "candidates")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = documents.join(ids, "doc_id", "left_semi")
    sets = texts.mapInArrow(_sets(n), "doc_id long, set_id binary, shingles array<long>")
    own = nodes.select("set_id", F.col("node").alias("doc_id"))
    sets = sets.join(own, ["doc_id", "set_id"], "left_semi").dropDuplicates(["doc_id", "set_id"])
    return shared_table(sets.select(F.col("doc_id").alias("node"), "shingles"), "sets")


def _confirmed(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough; for stars, which are as many as their members."""
    ids = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _full_sets(ids, nodes, documents, n)
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(100 * common >= percent * (F.size("a_set") + F.size("b_set") - common)).select("a", "b")


class _Block:
    """The members of a bucket in two of its blocks, and which of them may be linked across components."""

    def __init__(self, table: pa.Table, most: int, percent: int):
        self.most, self.percent = most, percent
        self.node, self.part, self.size = (table.column(c).to_numpy() for c in ("node", "component", "n_shingles"))
        block, left, right = (table.column(c).to_numpy() for c in ("block", "left", "right"))
        matrix = lambda c: table.column(c).combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        self.words, self.bands = matrix("sketch").view(np.uint64), matrix("bands")  # bits of an int64 are counted without its sign
        self.left, self.right, self.same = np.flatnonzero(block == left), np.flatnonzero(block == right), left[0] == right[0]
        self.earlier = int(np.argmax(self.bands[0] == table.column("band")[0].as_py()))

    def partners(self, i: int, part: np.ndarray) -> np.ndarray:
        """Right members in another component than i (by ``part``) with a similar sketch and size.

        Pairs that share an earlier band are left to that one, whose bucket
        holds both components as well.
        """
        other = self.right[part[self.right] != part[i]]
        if self.same:
            other = other[self.node[other] > self.node[i]]
        other = other[np.bitwise_count(self.words[other] ^ self.words[i]).sum(axis=1) <= self.most]
        small, large = np.minimum(self.size[other], self.size[i]), np.maximum(self.size[other], self.size[i])
        other = other[100 * small >= self.percent * large]
        return other[~(self.bands[other, : self.earlier] == self.bands[i, : self.earlier]).any(axis=1)]


def _crossing(most: int, percent: int):
    """(band, left, right, block, node) of the members that some pair of this block pair may link across components: a row a member, never one a pair."""

    def run(table: pa.Table) -> pa.Table:
        found = np.zeros(table.num_rows, bool)
        if table.num_rows:
            block = _Block(table, most, percent)
            for i in block.left:
                other = block.partners(i, block.part)
                found[other] = True
                found[i] |= len(other) > 0
        return table.filter(pa.array(found)).select(["band", "left", "right", "block", "node"])

    return run


def _united(most: int, percent: int):
    """Links (a, b) of a block pair, confirmed on the full sets; only those that unite two components that nothing united before them."""

    def run(table: pa.Table) -> pa.Table:
        links: list[tuple[int, int]] = []
        if table.num_rows:
            block = _Block(table, most, percent)
            _, part = np.unique(block.part, return_inverse=True)
            column = table.column("shingles").combine_chunks()
            starts = np.r_[0, np.cumsum(block.size)]
            words, codes = np.unique(column.flatten().to_numpy(), return_inverse=True)
            mine = np.zeros(len(words), bool)
            for i in block.left:
                other = block.partners(i, part)
                if not len(other):
                    continue
                own = codes[starts[i] : starts[i + 1]]
                mine[own] = True
                sizes = block.size[other]
                ends = np.cumsum(sizes)
                flat = codes[np.arange(ends[-1]) + np.repeat(starts[other] - ends + sizes, sizes)]
                common = np.add.reduceat(mine[flat], ends - sizes, dtype=np.int64)
                mine[own] = False
                for j in other[100 * common >= percent * (sizes + len(own) - common)]:
                    if part[j] != part[i]:
                        links.append((min(block.node[i], block.node[j]), max(block.node[i], block.node[j])))
                        part[part == part[j]] = part[i]
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 75) -> DataFrame:
    """Component of each document under links of ``percent`` similarity of shingle sets.

    ``documents`` has doc_id and text; other columns are left out. One row per
    input row: doc_id, n_shingles, component_id (the smallest doc_id reachable
    over links, itself included), kept (doc_id = component_id), text_hash.

    1. Each text becomes its shingle set's identity, MinHash band keys and an
       odd sketch: the samples folded into a parity bitmap.
    2. Equal sets are one class, named by its smallest doc_id, so exact copies
       cost one pre-aggregated row however many there are.
    3. Every class of a band bucket is paired with the bucket's smallest id (a
       star, never all pairs); pairs whose sketches' XOR counts show far lower
       similarity go, the rest are confirmed on the full sets.
    4. Buckets that still hold several components are searched for links
       between different components, block by block: sketches tell which
       members to fetch the full sets of, and within the block these confirm
       links until no two components can be united. A block gives out at most
       one link less than it has components, so a large group whose pairs stay
       just below the threshold costs rows for its members, not its pairs.

    Null doc_id: linked with nothing, component_id null, kept. Null or empty
    text: an empty set, linked with nothing. Repeated rows: each gets the same
    answer; rows with one doc_id and several texts are judged by their texts.
    Empty table: empty result.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    sketched = shared_table(rows.mapInArrow(_sketches(shingle), _SKETCH), "sketches")
    linked = sketched.where("set_id is not null and doc_id is not null")
    nodes = linked.groupBy("set_id").agg(F.min("doc_id").alias("node"))
    own = linked.join(nodes.select("set_id", F.col("node").alias("doc_id")), ["set_id", "doc_id"], "left_semi")
    own = own.select(F.col("doc_id").alias("node"), "set_id", "n_shingles", "bands", "sketch").dropDuplicates(["node", "set_id"])
    own = shared_table(own, "classes")

    keyed = own.select("node", F.explode("bands").alias("band"))
    heads = keyed.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last")
    in_bucket = shared_table(keyed.join(heads.select("band", "head"), "band"), "buckets")
    most = most_differing_bits(percent / 100 - MARGIN)
    sketch = own.select("node", "sketch", "bands", "n_shingles")
    stars = in_bucket.where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    near = _similar(stars, sketch, most, percent)
    first = shared_table(_confirmed(near, own, rows, shingle, percent), "links")
    labels = components(first)

    member = in_bucket.select("band", "node").join(labels, "node", "left")
    member = member.withColumn("component", F.coalesce("component", "node"))
    member = member.join(own.select("node", "n_shingles"), "node")
    many = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    mixed = member.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(many).cast("int").alias("blocks"))
    mixed = mixed.where("low < high").select("band", "blocks")
    member = member.select("band", "node", "component").join(mixed, "band")
    member = member.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    member = member.select("band", "node", "component", "block", other.alias("other"))
    member = member.select(
        "band", "node", "component", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    ).join(sketch, "node")
    crossing = member.groupBy("band", "left", "right").applyInArrow(_crossing(most, percent), "band long, left int, right int, block int, node long")
    crossing = shared_table(crossing, "crossing")
    sets = _full_sets(crossing.select("node").distinct(), own, rows, shingle)
    known = sets.join(sketch, "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    second = crossing.join(known, "node").groupBy("band", "left", "right").applyInArrow(_united(most, percent), "a long, b long")
    second = shared_table(second.distinct(), "links")
    found = components(first.unionByName(second))

    named = nodes.join(found, nodes["node"] == found["node"], "left").select("set_id", F.coalesce("component", nodes["node"]).alias("least"))
    out = sketched.select("doc_id", "text_hash", "n_shingles", "set_id").join(named, "set_id", "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_hash")


def _similar(pairs: DataFrame, sketch: DataFrame, most: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose sketches differ in at most ``most`` bits and whose sizes allow the similarity."""
    side = lambda c: sketch.select(F.col("node").alias(c), F.col("sketch").alias(f"{c}_s"), F.col("n_shingles").alias(f"{c}_n"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
    bits = F.zip_with("a_s", "b_s", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return both.where(F.aggregate(bits, F.lit(0), lambda total, x: total + x) <= most).select("a", "b")


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """The documents that stay: one of each group, with all their columns.

    Of rows that repeat a kept doc_id and text one stays. Rows with a null
    doc_id all stay.
    """
    judged = shared_table(near_duplicates(documents), "judged")
    key = {"__id": F.col("doc_id").cast("long"), "__hash": F.xxhash64(F.col("text").cast("binary"))}
    names = judged.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "kept")
    keyed = documents.withColumns(key)
    stay = keyed.join(names.where("not kept").distinct(), ["__id", "__hash"], "left_anti")
    twice = names.where("__id is not null").groupBy("__id", "__hash").count().where("count > 1")
    if not twice.isEmpty():
        once = stay.join(twice, ["__id", "__hash"], "left_semi").dropDuplicates(["__id", "__hash"])
        stay = stay.join(twice, ["__id", "__hash"], "left_anti").unionByName(once)
    return stay.drop(*key)

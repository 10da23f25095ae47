"""Prefix trie of conversations: ternary search trees over range shards, merged along their boundaries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconflow.session import shared_table

#: Conversations, and turns, of one tree; a longer conversation has a tree of its own.
TREE_ROWS, TREE_TURNS = 4096, 1 << 16
#: Shards whose boundaries one task merges in a round.
FAN = 64
#: Bytes of a turn's code in a sequence.
CODE = 16

ROOT = xxhash.xxh3_128_digest(b"")
_EMPTY = hashlib.sha256(b"").hexdigest()

_BOUNDARY = "key binary, parent binary, depth long, least long, n long, size long, children long, leaves long, saved long, first boolean, last boolean"
_NODE = (
    "key binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_OUT = f"shard long, node struct<{_NODE.replace(' ', ': ').replace(',: ', ', ')}>, ends struct<key: binary, least: long, ids: binary>, boundary array<struct<{_BOUNDARY.replace(' ', ': ').replace(',: ', ', ')}>>"


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as array<struct<code, size>>.

    ``code`` is a 128-bit hash of role and text in hex, ``size`` the UTF-8 bytes
    of the text. Turns are ordered by turn (nulls first), equal ones by code.
    Null role or text is empty. Rows without a conv_id are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    code = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.col("turn").cast("long")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(turn.isNotNull().alias("known"), turn.alias("turn"), code.alias("code"), F.octet_length(text).cast("long").alias("size")).alias("t"),
    )
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["code"].alias("code"), t["size"].alias("size")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns"))


def rebuilt(sequences: DataFrame, family: int = 5, modulus: int = 9) -> DataFrame:
    """The same after the first h turns of conversation c - c % ``family`` took the place of c's own first h; h = crc32(c) % ``modulus``."""
    base = F.col("conv_id") - F.col("conv_id") % family
    head = F.slice("turns", 1, modulus - 1).alias("head")
    heads = sequences.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), head)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus).cast("int")
    none = F.array().cast("array<struct<code: string, size: bigint>>")
    rows = sequences.withColumn("base", base).join(heads, "base", "left").withColumn("h", h)
    begun = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return rows.select("conv_id", F.concat(begun, own).alias("turns"))


def _keys(sequence: bytes) -> list[bytes]:
    """The key of each node on a sequence's path, the root's first: chained 128-bit hashes."""
    out = [ROOT]
    for i in range(0, len(sequence), CODE):
        out.append(xxhash.xxh3_128_digest(out[-1] + sequence[i : i + CODE]))
    return out


class TernaryTree:
    """A ternary search tree over sequences of dictionary codes.

    Each node holds one turn: ``low`` and ``high`` lead to smaller and larger
    turns in its place, ``equal`` to the turns that follow it. A node is also
    the trie's node for the turns that lead to it. Node 0 is the root.
    """

    def __init__(self):
        self.split, self.low, self.equal, self.high = [-1], [0], [0], [0]

    def insert(self, codes: list[int]) -> list[int]:
        """The nodes of a sequence of codes, the root's first, made where they are missing."""
        split, low, equal, high = self.split, self.low, self.equal, self.high
        path, at = [0], 0
        for code in codes:
            side, before, now = equal, at, equal[at]
            while now and split[now] != code:
                side, before = (low, now) if code < split[now] else (high, now)
                now = side[now]
            if not now:
                now = side[before] = len(split)
                split.append(code)
                low.append(0)
                equal.append(0)
                high.append(0)
            path.append(now)
            at = now
        return path

    def walk(self) -> list[tuple[int, int]]:
        """(node, its parent in the trie), each parent before its children; by a stack, so depth is no limit."""
        out, stack = [(0, -1)], [(self.equal[0], 0)] if self.equal[0] else []
        while stack:
            now, parent = stack.pop()
            out.append((now, parent))
            stack.extend((child, above) for child, above in ((self.low[now], parent), (self.high[now], parent), (self.equal[now], now)) if child)
        return out


def medians(n: int) -> list[int]:
    """0 to n - 1, the middle of each range before its halves, which keeps the tree balanced."""
    out, ranges = [], [(0, n)]
    for low, high in ranges:  # grows while it is read
        if low < high:
            middle = (low + high) // 2
            out.append(middle)
            ranges += [(low, middle), (middle + 1, high)]
    return out


@dataclass
class _Node:
    """A node on a shard's boundary: what the shard knows of it. ``children``, ``leaves`` and ``saved`` count closed subtrees only."""

    key: bytes
    parent: bytes | None
    depth: int
    least: int
    n: int
    size: int
    children: int = 0
    leaves: int = 0
    saved: int = 0
    first: bool = False
    last: bool = False

    def row(self) -> dict:
        return dict(self.__dict__)


@dataclass
class _Rows:
    """What a task gives out: closed nodes, ids of conversations that end in a node, and at last a boundary."""

    shard: int
    nodes: list = field(default_factory=list)
    ends: list = field(default_factory=list)

    def closed(self, node: _Node) -> tuple[int, int]:
        """Gives out a node whose subtree is complete; (leaves, saved) of that subtree."""
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.n - 1) * node.size
        self.nodes.append((node.key, node.parent, node.least, node.depth, None, node.n, node.children, leaves, saved, None))
        return leaves, saved

    def batch(self, schema: pa.Schema, boundary: list[_Node] | None = None) -> pa.RecordBatch:
        n, e, b = len(self.nodes), len(self.ends), int(boundary is not None)
        node = [dict(zip((f.name for f in schema.field("node").type), x, strict=True)) for x in self.nodes]
        ends = [{"key": k, "least": c, "ids": i} for k, c, i in self.ends]
        edge = [[x.row() for x in boundary]] if b else []
        parts = [node + [None] * (e + b), [None] * n + ends + [None] * b, [None] * (n + e) + edge]
        out = [pa.array([self.shard] * (n + e + b), pa.int64())]
        out += [pa.array(x, schema.field(c).type) for c, x in zip(("node", "ends", "boundary"), parts, strict=True)]
        self.nodes, self.ends = [], []
        return pa.RecordBatch.from_arrays(out, schema=schema)


def _merge(parts: list[list[_Node]], rows: _Rows, whole: bool = False) -> list[_Node]:
    """The boundary of consecutive ranges together; nodes that lie inside now are closed and given out.

    ``whole``: nothing lies beyond, so every node is closed.
    """
    known: dict[bytes, _Node] = {}
    for number, part in enumerate(parts):
        for x in part:
            first, last = not whole and x.first and number == 0, not whole and x.last and number == len(parts) - 1
            if (y := known.get(x.key)) is None:
                x.first, x.last = first, last
                known[x.key] = x
                continue
            y.least, y.n = min(y.least, x.least), y.n + x.n
            y.children, y.leaves, y.saved = y.children + x.children, y.leaves + x.leaves, y.saved + x.saved
            y.first, y.last = y.first or first, y.last or last
    for x in sorted(known.values(), key=lambda x: -x.depth):
        if x.first or x.last:
            continue
        leaves, saved = rows.closed(x)
        if x.parent is not None:
            above = known[x.parent]
            above.children, above.leaves, above.saved = above.children + 1, above.leaves + leaves, above.saved + saved
    return [x for x in known.values() if x.first or x.last]


def _tree(conv: np.ndarray, sequences: list[bytes], sizes: list[np.ndarray], rows: _Rows) -> list[_Node]:
    """The trie of some conversations, sorted by sequence and id: closed nodes go to ``rows``, the boundary is returned."""
    starts = [0] + [i for i in range(1, len(sequences)) if sequences[i] != sequences[i - 1]]
    stops = [*starts[1:], len(sequences)]
    halves = np.frombuffer(b"".join(sequences[i] for i in starts), ">u8").astype(np.uint64).reshape(-1, 2)
    _, codes = np.unique(halves, axis=0, return_inverse=True)
    lengths = [len(sequences[i]) // CODE for i in starts]
    cut = np.cumsum([0, *lengths])
    codes = codes.reshape(-1).tolist()

    tree, ending = TernaryTree(), {}
    paths: dict[int, list[int]] = {}
    for k in medians(len(starts)):
        path = tree.insert(codes[cut[k] : cut[k + 1]])
        ending[path[-1]] = k
        if k in (0, len(starts) - 1):
            paths[k] = path
    order = tree.walk()
    total = len(tree.split)
    parent, sample, depth = [-1] * total, [-1] * total, [0] * total
    n, least = [0] * total, [None] * total
    for node, above in order:
        parent[node] = above
        depth[node] = depth[above] + 1 if above >= 0 else 0
    for node, k in ending.items():
        n[node], least[node] = stops[k] - starts[k], int(conv[starts[k] : stops[k]].min())
        sample[node] = k
    for node, above in reversed(order):
        if above >= 0:
            n[above] += n[node]
            sample[above] = sample[node]
            if least[above] is None or least[node] < least[above]:
                least[above] = least[node]
    edge_first, edge_last = set(paths[0]), set(paths[len(starts) - 1])
    edge = edge_first | edge_last
    keys: dict[int, bytes] = {}
    for k, path in paths.items():
        keys.update(zip(path, _keys(sequences[starts[k]]), strict=True))
    children, leaves, saved = [0] * total, [0] * total, [0] * total
    for node, above in reversed(order):
        if node in edge:
            continue
        size = int(sizes[starts[sample[node]]][depth[node] - 1])
        leaf = leaves[node] if children[node] else 1
        gain = saved[node] + (n[node] - 1) * size
        leaves[node], saved[node] = leaf, gain
        children[above] += 1
        leaves[above] += leaf
        saved[above] += gain
        k = ending.get(node)
        digest = _EMPTY if k is None else hashlib.sha256(",".join(map(str, conv[starts[k] : stops[k]].tolist())).encode()).hexdigest()
        inside = above not in edge
        rows.nodes.append((None, None if inside else keys[above], least[node], depth[node], least[above] if inside else None, n[node], children[node], leaf, gain, digest))
    for node in edge & ending.keys():
        k = ending[node]
        ids = conv[starts[k] : stops[k]].tolist()
        rows.ends.append((keys[node], ids[0], ",".join(map(str, ids)).encode()))
    out = []
    for node in sorted(edge, key=lambda x: depth[x]):
        size = int(sizes[starts[sample[node]]][depth[node] - 1]) if depth[node] else 0
        above = keys[parent[node]] if parent[node] >= 0 else None
        counts = (children[node], leaves[node], saved[node])
        out.append(_Node(keys[node], above, depth[node], least[node], n[node], size, *counts, node in edge_first, node in edge_last))
    return out


def _shard(schema: pa.Schema):
    """One range shard: trees over runs of its sorted conversations, merged one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, boundary, held, turns = _Rows(TaskContext.get().partitionId()), None, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal boundary, held, turns
            conv, sequences, sizes = zip(*held, strict=True)
            mine = _tree(np.array(conv, np.int64), list(sequences), list(sizes), rows)
            held, turns = [], 0
            if boundary is None:
                boundary = mine
            else:
                boundary = _merge([boundary, mine], rows)
            return rows.batch(schema)

        for batch in batches:
            sizes = batch.column("sizes")
            offsets, flat = sizes.offsets.to_numpy(), sizes.values.to_numpy(zero_copy_only=False)
            for i, (conv, sequence) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("sequence").to_pylist(), strict=True)):
                held.append((conv, sequence, flat[offsets[i] : offsets[i + 1]]))
                turns += len(sequence) // CODE
                if len(held) >= TREE_ROWS or turns >= TREE_TURNS:
                    yield flush()
        if held:
            yield flush()
        if boundary is not None:
            yield rows.batch(schema, boundary)

    return run


def _round(schema: pa.Schema, whole: bool):
    """Merges the boundaries of consecutive shards (rows of one group)."""

    def run(table: pa.Table) -> pa.Table:
        found = sorted(zip(table.column("shard").to_pylist(), table.column("boundary").to_pylist(), strict=True), key=lambda x: x[0])
        parts = [[_Node(**x) for x in part] for _, part in found]
        rows = _Rows(found[0][0] // FAN)
        boundary = _merge(parts, rows, whole)
        return pa.Table.from_batches([rows.batch(schema, None if whole else boundary)])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends_sha256) of id lists that come sorted by key and first id, one piece in memory at a time."""
    key, digest = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if k == key:
                digest.update(b"," + ids)
                continue
            if key is not None:
                done.append((key, digest.hexdigest()))
            key, digest = k, hashlib.sha256(ids)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], ["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["key", "ends_sha256"])


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    struct = lambda ddl: pa.struct([(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))])
    ends = struct("key binary, least long, ids binary")
    return pa.schema([("shard", pa.int64()), ("node", struct(_NODE)), ("ends", ends), ("boundary", pa.list_(struct(_BOUNDARY)))])


def _split(found: DataFrame, what: str) -> DataFrame:
    return found.where(F.col(what).isNotNull())


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of all conversations' prefixes.

    ``sequences`` has conv_id and turns (array<struct<code, size>>, as
    :func:`turn_sequences` makes them), one row per conversation. Returns
    conv_id (smallest member), depth, parent_conv_id (the root's: null),
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    1. Conversations are sorted by (sequence, id) over range shards, so a
       conversation that a third of all repeat is cut across shards too.
    2. A shard encodes its turns by a dictionary and builds ternary search
       trees, medians first. Walking them adds up members, leaves and savings
       from the leaves to the root.
    3. Only nodes on the path of a tree's first or last sequence can have
       members elsewhere. These boundaries, two paths each, are merged along
       the shards, then in rounds of FAN shards; nodes that lie inside are done.
    4. Ids that end in a boundary node come as lists in order, hashed as a stream.

    A conversation is a row, so a task holds it whole; trees and boundaries are
    bounded by TREE_ROWS, TREE_TURNS and the longest conversation.
    No turns: the conversation ends in the root. Repeated conv_id rows count
    each. Empty table: no node, not even a root.
    """
    spark = sequences.sparkSession
    code = F.unhex(F.array_join(F.transform("turns", lambda t: t["code"]), ""))
    sizes = F.transform("turns", lambda t: t["size"])
    rows = sequences.select(F.col("conv_id").cast("long").alias("conv_id"), code.alias("sequence"), sizes.alias("sizes"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(shards, "sequence", "conv_id").sortWithinPartitions("sequence", "conv_id")
    schema = _arrow_schema()
    found = shared_table(rows.mapInArrow(_shard(schema), _OUT), "trie_shards")

    boundaries = _split(found, "boundary").select("shard", "boundary")
    paths = boundaries.select("shard", F.explode("boundary.key").alias("parent"))
    inside = _split(found, "node").select("shard", "node.*")
    between = inside.where("key is not null")  # closed while trees of one shard were merged
    merged, last = between.drop("shard"), found.agg(F.max("shard")).first()[0] or 0
    while boundaries is not None:
        whole = last < FAN
        after = boundaries.groupBy(F.floor(F.col("shard") / FAN).alias("group")).applyInArrow(_round(schema, whole), _OUT)
        after = shared_table(after, "trie_boundaries")
        merged = merged.unionByName(_split(after, "node").select("node.*"))
        boundaries, last = None if whole else _split(after, "boundary").select("shard", "boundary"), last // FAN
    merged = shared_table(merged, "trie_merged")

    ends = _split(found, "ends").select("ends.*").repartition("key").sortWithinPartitions("key", "least")
    ends = ends.select("key", "ids").mapInArrow(_digests, "key binary, ends_sha256 string")
    named = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    merged = merged.drop("ends_sha256").join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    merged = merged.join(named, "parent", "left")
    # a frequent parent has children in every shard: its id is looked up once for each shard, not for each child
    there = paths.join(named, "parent").unionByName(between.select("shard", F.col("key").alias("parent"), F.col("conv_id").alias("above")))
    inside = inside.where("key is null")
    below = inside.where("parent is not null").join(there, ["shard", "parent"])
    done = _columns(inside.where("parent is null"), F.col("parent_conv_id"))
    return done.unionByName(_columns(below, F.col("above"))).unionByName(_columns(merged, F.col("above")))


def _columns(nodes: DataFrame, parent: Column) -> DataFrame:
    return nodes.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

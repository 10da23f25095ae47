"""Near-duplicate vectors by a pigeonhole join over low-dimensional blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconflow.llm.graph import components
from beaconflow.session import shared_table

#: Dimensions of a block, and how many of them its cells cut.
BLOCK_DIMS, CELL_DIMS = 8, 2
#: Width of a cell in radii of the block's range join.
CELL_RADII = 2
#: Vectors of a cell that one task compares with as many others; larger cells are compared part by part.
PART = 4096
#: Left rows and candidate pairs that are compared at a time.
ROWS, PAIRS = 256, 1 << 17
#: Added to the squared distance that the threshold stands for, against rounding; the exact test follows.
SLACK = 1e-9

_KEY = ("label", "dim", "block", "cell")


def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix, which spreads any vector's length evenly over its dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def blocks(dim: int) -> list[np.ndarray]:
    """The rotated dimensions in blocks of BLOCK_DIMS or fewer."""
    return np.array_split(np.arange(dim), -(-dim // BLOCK_DIMS))


def budgets(dim: int, threshold: float) -> list[float]:
    """Squared distances of which at least one block keeps to its own if unit vectors have a cosine of ``threshold``: in proportion to dimensions."""
    return [(2 - 2 * threshold + SLACK) * len(b) / dim for b in blocks(dim)]


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors (rows, doubles) after the rotation.

    One product and one sum at a time, so a vector gets the same bits in
    whatever batch a task sees it: tasks must agree on what keeps to a budget.
    """
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    squares = np.zeros(len(unit))
    for j in range(unit.shape[1]):
        squares += unit[:, j] * unit[:, j]
    unit = unit / np.sqrt(squares)[:, None]
    out, turn = np.zeros_like(unit), rotation(unit.shape[1])
    for j in range(unit.shape[1]):
        out += unit[:, j : j + 1] * turn[j]
    return out


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _cells(threshold: float):
    """Adds to each vector the cells it enters: its own of each block (home), and those after it that its range reaches."""

    def of(vectors: np.ndarray) -> list[list[tuple[int, int, bool]]]:
        turned, out = rotated(vectors), [[] for _ in vectors]
        for block, (dims, budget) in enumerate(zip(blocks(vectors.shape[1]), budgets(vectors.shape[1], threshold), strict=True)):
            radius = np.sqrt(budget) * (1 + SLACK)
            at = turned[:, dims[:CELL_DIMS]]
            low, own, high = (np.floor((at + s) / (CELL_RADII * radius)).astype(np.int64) for s in (-radius, 0.0, radius))
            for i in range(len(out)):
                home = tuple(own[i])
                for cell in product(*(range(a, b + 1) for a, b in zip(low[i], high[i], strict=True))):
                    if cell >= home:
                        out[i].append((block, sum((c & 0xFFFF) << (16 * k) for k, c in enumerate(cell)), cell == home))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("block", pa.int32()), ("cell", pa.int64()), ("home", pa.bool_())]))
        for batch in batches:
            dims, column = batch.column("dim").to_numpy(), batch.column("embedding")
            found: list = [None] * batch.num_rows
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for i, cells in zip(rows, of(_matrix(column.take(pa.array(rows)), len(rows))), strict=True):
                    found[i] = [{"block": b, "cell": c, "home": h} for b, c, h in cells]
            yield batch.append_column("cells", pa.array(found, kind))

    return run


def _joined(threshold: float):
    """Links of one cell, or of two of its parts: (node, links, root) for every vector that has any.

    ``links`` counts the vectors (copies included) linked with the node here;
    ``root`` is a node that links lead to, the same for all that they connect,
    so no pair leaves the task. A pair counts in the first block whose budget
    it keeps to; there it meets once, as only one of both enters the other's cell.
    """

    def run(table: pa.Table) -> pa.Table:
        empty = pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        n = table.num_rows
        if n < 2:
            return empty
        first = lambda c: table.column(c)[0].as_py()
        block, left_part, right_part = first("block"), first("left"), first("right")
        node, weight, home, part = (table.column(c).to_numpy() for c in ("node", "weight", "home", "part"))
        vectors = _matrix(table.column("embedding"), n)
        turned, limits = rotated(vectors), budgets(vectors.shape[1], threshold)
        cuts = blocks(vectors.shape[1])
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        left, right = np.flatnonzero(part == left_part), np.flatnonzero(part == right_part)
        here = turned[:, cuts[block]]
        square = np.einsum("ij,ij->i", here, here)
        links, root = np.zeros(n, np.int64), np.arange(n)

        def within(i: np.ndarray, j: np.ndarray, b: int) -> np.ndarray:
            total = np.zeros(len(i))
            for d in cuts[b]:
                gap = turned[i, d] - turned[j, d]
                total += gap * gap
            return total <= limits[b]

        def verify(i: np.ndarray, j: np.ndarray) -> None:
            new = within(i, j, block)
            for b in range(block):
                new &= ~within(i, j, b)
            i, j = i[new], j[new]
            cosine = np.einsum("ij,ij->i", vectors[i], vectors[j]) / (length[i] * length[j])
            near = cosine >= threshold
            i, j = i[near], j[near]
            links[:] += np.bincount(i, weight[j], n).astype(np.int64) + np.bincount(j, weight[i], n).astype(np.int64)
            while True:
                a, b = root[i], root[j]
                if (a == b).all():
                    return
                np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
                while (root != root[root]).any():
                    root[:] = root[root]

        for start in range(0, len(left), ROWS):
            rows = left[start : start + ROWS]
            apart = square[rows, None] + square[right] - 2 * (here[rows] @ here[right].T)
            a, b = np.nonzero(apart <= limits[block] + 1e-9)
            i, j = rows[a], right[b]
            ok = (home[i] | home[j]) & ((i < j) if left_part == right_part else True)
            i, j = i[ok], j[ok]
            for at in range(0, len(i), PAIRS):
                verify(i[at : at + PAIRS], j[at : at + PAIRS])
        some = np.flatnonzero(links)
        return pa.table({"node": node[some], "links": links[some], "root": node[root[some]]})

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept: vectors of one label linked by a cosine of ``threshold`` (above 0) or more.

    ``vectors`` has vec_id, embedding (array of numbers) and label; other
    columns are left out. One row per input row: ``n_links`` other rows are
    linked with it directly, ``component_id`` is the smallest vec_id reachable.

    1. Equal vectors of a label are one class with a weight, so copies cost one
       pre-aggregated row.
    2. Unit vectors are rotated and cut into blocks of few dimensions. Whatever
       is near as a whole keeps to at least one block's share of the squared
       distance: each block is a range join over a grid of cells.
    3. Each cell compares its members block first, then exactly; large cells
       are compared in pairs of parts. Counts and one edge for each linked
       vector leave the task, never pairs.

    Links are exact: rounding cannot lose a pair, as budgets have some slack
    and the whole cosine decides. Vectors of different lengths are not
    compared. A null vec_id or label, a null, empty or zero vector, and one
    with null or non-finite components link with nothing: n_links 0, their own
    vec_id as component_id, kept. Repeated rows each count as a link of the
    other; of rows with the smallest vec_id all are kept. Empty table: empty.
    """
    inner = vectors.schema["embedding"].dataType.simpleString()
    kind = inner if inner == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"), "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    classes = rows.where("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    classes = classes.select(F.monotonically_increasing_id().alias("node"), "*", F.size("embedding").alias("dim"))
    placed = classes.withColumn("cells", F.lit(None).cast("array<struct<block: int, cell: long, home: boolean>>"))
    classes = shared_table(classes.mapInArrow(_cells(threshold), placed.schema), "vector_classes")

    entered = classes.select("node", "weight", "embedding", "label", "dim", F.explode("cells").alias("at"))
    entered = entered.select("node", "weight", "embedding", "label", "dim", "at.block", "at.cell", "at.home")
    large = entered.groupBy(*_KEY).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")).where("parts > 1")
    large = shared_table(large, "large_cells")
    if large.isEmpty():
        member = entered.withColumns({c: F.lit(0) for c in ("part", "left", "right")})
    else:
        member = entered.join(large, list(_KEY), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        member = member.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
        member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        member = member.withColumn("left", F.least("part", "other")).withColumn("right", F.greatest("part", "other")).drop("parts", "other")
    found = member.groupBy(*_KEY, "left", "right").applyInArrow(_joined(threshold), "node long, links long, root long")
    found = shared_table(found, "vector_links")

    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()
    group = components(edges).withColumnRenamed("component", "top")
    named = classes.select("label", "embedding", "least", "weight", "node").join(counted, "node", "left").join(group, "node", "left")
    named = named.withColumn("top", F.coalesce("top", "node"))
    least = named.groupBy("top").agg(F.min("least").alias("component_id"))
    named = named.join(least, "top").select("label", "embedding", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    named = named.withColumn("usable", F.lit(True))
    out = rows.join(named, ["usable", "label", "embedding"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

"""Approximate nearest neighbours from balanced posting lists."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconflow.session import shared_table

#: Distinct vectors that centroids and the search ratio are fitted on, chosen by a hash of their ids, and their bytes at most.
SAMPLE, SAMPLE_BYTES = 20_000, 64 << 20
#: Vectors for which there is one list, and lists at most (so that all centroids fit in memory); longer lists are cut in blocks.
LIST_SIZE, MAX_LISTS = 256, 4096
#: A vector also joins lists whose centroid is at most this many times as far as the nearest, REPLICAS lists in all.
BOUNDARY, REPLICAS = 1.04, 4
#: Neighbours of a centroid in the graph, entry points, and centroids expanded at least.
DEGREE, ENTRIES, EXPANDED = 24, 8, 16
#: Recall that the search ratio is fitted for, and the sampled queries for it.
RECALL, TRIALS = 0.97, 256
#: Vectors and queries of a list that meet in one task.
BLOCK, QUERY_BLOCK = 8192, 4096


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all of ``b`` (a block of queries against some vectors)."""
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


class Graph(NamedTuple):
    """Centroids, the nearest other centroids of each, entry points and the ratio that prunes a search."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    ratio: float

    def search(self, vectors: np.ndarray, ratio: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each vector, the lists whose centroids are at most ``ratio`` times as far as the nearest, nearest first.

        A walk over the graph: the nearest centroid seen and not yet expanded
        hands over its links, until all within the ratio are expanded. Vectors
        walk side by side in blocks.
        """
        for begin in range(0, len(vectors), 256):
            block = vectors[begin : begin + 256]
            rows = np.arange(len(block))
            seen = np.full((len(block), len(self.centroids)), np.inf)
            left = seen.copy()  # distances of what is seen and not expanded
            seen[:, self.entries] = left[:, self.entries] = _distances(block, self.centroids[self.entries])
            for step in range(len(self.centroids)):
                nearest = left.argmin(axis=1)
                far = left[rows, nearest]
                going = np.isfinite(far) & ((far <= ratio * seen.min(axis=1)) | (step < EXPANDED))
                if not going.any():
                    break
                left[rows, nearest] = np.inf
                row, centre = np.repeat(rows[going], self.links.shape[1]), self.links[nearest[going]].ravel()
                fresh = np.isinf(seen[row, centre])
                row, centre = row[fresh], centre[fresh]
                d = np.sqrt(((block[row] - self.centroids[centre]) ** 2).sum(axis=1))
                seen[row, centre] = left[row, centre] = d
            for d in seen:
                lists = np.flatnonzero(d <= ratio * d.min())
                order = np.argsort(d[lists], kind="stable")
                yield lists[order], d[lists[order]]


def _halves(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of equal size: a few rounds of two means, each cut at the median of the difference of distances."""
    a, b = points[rng.choice(len(points), 2, replace=False)]
    for _ in range(6):
        side = ((points - a) ** 2).sum(axis=1) - ((points - b) ** 2).sum(axis=1)
        order = np.argsort(side, kind="stable")
        first, second = order[: len(order) // 2], order[len(order) // 2 :]
        a, b = points[first].mean(axis=0), points[second].mean(axis=0)
    return first, second


def _balanced_centroids(points: np.ndarray, lists: int) -> np.ndarray:
    """Means of cells that hold equally many of ``points``, halved again and again."""
    rng, cells = np.random.default_rng(3), [points]
    while len(cells) < lists:
        if len(cells[0]) < 2:
            break
        cell = cells.pop(0)
        cells += [cell[half] for half in _halves(cell, rng)]
        cells.sort(key=len, reverse=True)
    return np.array([c.mean(axis=0) for c in cells])


def fit(points: np.ndarray, rows: int) -> Graph:
    """Centroids for an index of ``rows`` vectors, their graph, and a ratio that reaches RECALL on the sample.

    The sample's neighbours are farther away than those among all vectors, so a
    ratio that finds them finds the others more easily.
    """
    points = np.unique(points, axis=0)
    lists = int(np.clip(rows // LIST_SIZE, 1, min(MAX_LISTS, max(1, len(points) // 4))))
    centroids = _balanced_centroids(points, lists)
    between = _distances(centroids, centroids)
    links = np.argsort(between, axis=1, kind="stable")[:, 1 : DEGREE + 1]
    if links.shape[1] == 0:
        links = np.zeros((len(centroids), 1), np.int64)
    # a ring makes every centroid reachable
    ring = (np.arange(len(centroids)) + 1) % len(centroids)
    links = np.column_stack([links, ring])
    entries = np.unique(np.linspace(0, len(centroids) - 1, ENTRIES).astype(int))
    graph = Graph(centroids, links, entries, np.inf)
    return graph._replace(ratio=_fitted_ratio(graph, points))


def _fitted_ratio(graph: Graph, points: np.ndarray, k: int = 10) -> float:
    """The smallest ratio with which the lists searched hold RECALL of the sampled neighbours."""
    if len(graph.centroids) == 1 or len(points) <= k:
        return np.inf
    rng = np.random.default_rng(9)
    trial = rng.choice(len(points), min(TRIALS, len(points)), replace=False)
    exact = _distances(points[trial], points)
    exact[np.arange(len(trial)), trial] = np.inf
    near = np.argpartition(exact, k - 1, axis=1)[:, :k]
    found, place = np.unique(near, return_inverse=True)
    member = [lists for lists, _ in _assigned(graph, points[found])]
    to_list = _distances(points[trial], graph.centroids)
    best = to_list.min(axis=1)
    need = [to_list[i, member[j]].min() / best[i] for i, own in enumerate(place.reshape(near.shape)) for j in own]
    return float(np.quantile(need, RECALL)) * (1 + 1e-9)


def _assigned(graph: Graph, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for lists, d in graph.search(vectors, BOUNDARY):
        yield lists[:REPLICAS], d[:REPLICAS]


class Index(NamedTuple):
    """Postings (list, block, blocks, vec_id, vector), written to the shared folder, and the centroid graph."""

    postings: DataFrame
    sizes: DataFrame
    graph: Graph


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no nulls, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v) in double precision of the rows that take part; of several lengths the most frequent does."""
    rows = vectors.where(F.col(vec_id).isNotNull() & usable(F.col(embedding)))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(2).collect()
    return rows.where(F.size("v") == lengths[0]["n"]) if len(lengths) > 1 else rows


def _matrix(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def build_index(rows: DataFrame) -> Index:
    """Index of all ``rows`` (vec_id, v); centroids are fitted on a bounded sample of them.

    Cells of equal size make balanced lists; a vector near a border is posted
    in each list across it. Lists of more than BLOCK vectors (also many equal
    ones) are cut in blocks by row, so no list has to fit in one task.
    """
    n = rows.count()
    length = (rows.select(F.size("v").alias("n")).limit(1).collect() or [{"n": 1}])[0]["n"]
    size = int(max(1, min(SAMPLE, SAMPLE_BYTES // (8 * length))))
    distinct = rows.groupBy("v").agg(F.min("vec_id").alias("vec_id"))
    sample = distinct.orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).select("v").toArrow()
    points = _matrix(sample.column("v").combine_chunks(), sample.num_rows) if sample.num_rows else np.zeros((1, length))
    graph = fit(points, n)
    shared = rows.sparkSession.sparkContext.broadcast(graph)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = [own for own, _ in _assigned(shared.value, _matrix(batch.column("v"), batch.num_rows))]
                place = np.repeat(np.arange(batch.num_rows), [len(own) for own in lists])
                taken = batch.take(pa.array(place))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists).astype(np.int32)), *taken.columns], ["list", "vec_id", "v"])

    posted = shared_table(rows.select("vec_id", "v").mapInArrow(post, "list int, vec_id long, v array<double>"), "postings")
    sizes = posted.groupBy("list").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    return Index(posted, shared_table(sizes, "posting_sizes"), graph)


def _best(k: int):
    """The k nearest of a block of a list for each query of a block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if left.num_rows and right.num_rows:
            queries, vectors = (_matrix(t.column("v").combine_chunks(), t.num_rows) for t in (left, right))
            q_id, v_id = left.column("query_id").to_numpy(), right.column("vec_id").to_numpy()
            for begin in range(0, len(queries), 64):
                near = _distances(queries[begin : begin + 64], vectors)
                for i, d in enumerate(near, begin):
                    d[v_id == q_id[i]] = np.inf
                    limit = np.partition(d, k - 1)[k - 1] if len(d) > k else d.max()
                    # the products are rounded: keep what may tie, then measure exactly
                    some = np.flatnonzero((d <= limit + 1e-6 * (1 + limit)) & np.isfinite(d))
                    exact = np.sqrt(((vectors[some] - queries[i]) ** 2).sum(axis=1))
                    order = np.lexsort((v_id[some], exact))[:k]
                    out.append((np.full(len(order), q_id[i]), v_id[some][order], exact[order]))
        ids, found, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"query_id": ids, "vec_id": found, "score": score})

    return run


def nearest(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query (vec_id, v), itself left out.

    A query walks the centroid graph and searches the lists whose distance is
    within the fitted ratio of the nearest, and more in the order of distance
    until they hold vectors enough. Distances are measured on the vectors in
    double precision; ties go to the smaller id.
    """
    size = {r["list"]: r["n"] for r in index.sizes.collect()}  # at most MAX_LISTS rows
    counts = np.array([size.get(i, 0) for i in range(len(index.graph.centroids))])
    shared = queries.sparkSession.sparkContext.broadcast((index.graph, counts))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, count = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("v"), batch.num_rows)
            lists = []
            for i, (own, _) in enumerate(graph.search(vectors, graph.ratio)):
                if count[own].sum() < REPLICAS * (k + 1):
                    order = np.argsort(_distances(vectors[i : i + 1], graph.centroids)[0], kind="stable")
                    own = order[: 1 + np.searchsorted(np.cumsum(count[order]), REPLICAS * (k + 1))]
                lists.append(own)
            place = np.repeat(np.arange(batch.num_rows), [len(own) for own in lists])
            taken = batch.take(pa.array(place))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists).astype(np.int32)), *taken.columns], ["list", "query_id", "v"])

    asked = queries.select(F.col("vec_id").alias("query_id"), "v").mapInArrow(probe, "list int, query_id long, v array<double>")
    asked = shared_table(asked, "probes")
    probes = asked.groupBy("list").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    cells = shared_table(index.sizes.join(probes, "list").select("list", "blocks", "query_blocks"), "cells")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(cells, "list").withColumn("query_block", F.pmod(F.xxhash64("query_id"), "query_blocks").cast("int")).withColumn("block", each("blocks"))
    right = index.postings.join(cells, "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")).withColumn("query_block", each("query_blocks"))
    key = ["list", "block", "query_block"]
    found = (
        left.select(*key, "query_id", "v")
        .groupBy(*key)
        .cogroup(right.select(*key, "vec_id", "v").groupBy(*key))
        .applyInArrow(_best(k), "query_id long, vec_id long, score double")
    )
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def every_nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The ``k`` nearest of each row whose vec_id is divisible by ``every``, against all rows of ``vectors``.

    ``vectors`` has vec_id and embedding (array); other columns are left out.
    Rows with a null id or a vector that is null, empty, zero or holds nulls or
    non-finite components take no part. A repeated id is one row: its smallest
    vector counts. Equal vectors tie and are ranked by id. Fewer candidates than ``k``: all. Empty
    table: empty result.
    """
    rows = usable_vectors(vectors).groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = shared_table(rows, "vectors")
    return nearest(build_index(rows), rows.where(F.col("vec_id") % every == 0), k)

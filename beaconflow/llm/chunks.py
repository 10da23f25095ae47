"""Chunks of documents that tell each other what they have in common.

Comparing all windows or words of a corpus by shuffling one row for each is
what makes such jobs slow. Here documents are packed once into chunks of a few
megabytes. A chunk sends its *distinct* keys, as arrays cut by key into shards;
a shard sees what all chunks sent of its keys, and answers each chunk. A key
that a third of all documents share arrives once for each chunk, so no shard
grows with it, and shards are as many as their bounded size asks for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconflow.llm.words import small_batches
from beaconflow.session import shared_table

#: Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Bytes of text for which one shard is made.
SHARD_BYTES = 8 << 20


def pack(documents: DataFrame, text: str = "text") -> DataFrame:
    """(chunk, n_bytes, docs, sizes, texts): rows in packs, written once to the shared folder so that chunk numbers stay.

    ``text`` (binary) becomes one compressed block for each chunk, with the size
    of each text (-1: null), as chunks are shuffled to what is found for them.
    """
    rest = documents.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        pressed = zstandard.ZstdCompressor(level=3)
        for batch in small_batches(batches, text, CHUNK_BYTES):
            texts = batch.column(text).to_pylist()
            sizes = pa.array([-1 if t is None else len(t) for t in texts], pa.int64())
            whole = b"".join(t for t in texts if t)
            others = batch.drop_columns([text])
            docs = pa.StructArray.from_arrays(others.columns, others.schema.names)
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(whole)]), one(docs), one(sizes), pa.array([pressed.compress(whole)], pa.binary())],
                ["chunk", "n_bytes", "docs", "sizes", "texts"],
            )
            number += 1

    packed = documents.mapInArrow(run, f"chunk long, n_bytes long, docs array<{rest.schema.simpleString()}>, sizes array<long>, texts binary")
    return shared_table(packed, "chunks", "zstd")


def shard_count(chunks: DataFrame) -> int:
    """Shards for what these chunks send: by their bytes, and enough to keep all partitions busy."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    partitions = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4 * partitions, total // SHARD_BYTES + 1)


def documents_of(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.StructArray, list[bytes | None], dict]]:
    """(chunk, its documents, their texts, its other columns) of each row of a packed batch."""
    own = ("chunk", "n_bytes", "docs", "sizes", "texts")
    plain = zstandard.ZstdDecompressor()
    for i in range(batch.num_rows):
        rest = {n: batch.column(n)[i].as_py() for n in batch.schema.names if n not in own}
        whole, texts, at = plain.decompress(batch.column("texts")[i].as_py()), [], 0
        for size in batch.column("sizes")[i].values.to_pylist():
            texts.append(None if size < 0 else whole[at : at + size])
            at += max(size, 0)
        yield batch.column("chunk")[i].as_py(), batch.column("docs")[i].values, texts, rest


def by_shard(chunk: int, keys: np.ndarray, shards: int, **values: np.ndarray) -> pa.RecordBatch:
    """Rows (chunk, shard, keys, values...) of sorted distinct uint64 ``keys`` with aligned arrays."""
    shard = (keys % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    numbers, starts = np.unique(shard[order], return_index=True)
    cut = lambda x: pa.array([p.tobytes() for p in np.split(x[order], starts[1:])] if len(x) else [], pa.binary())
    columns = {"keys": keys, **values}
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(numbers), chunk, np.int64)), pa.array(numbers), *map(cut, columns.values())], ["chunk", "shard", *columns]
    )


Reduce = Callable[[np.ndarray, dict], tuple[np.ndarray, np.ndarray]]

#: The chunk number of a shard's summary.
SUMMARY = -1


def answered(sent: DataFrame, reduce: Reduce, kinds: dict[str, type], summary: Reduce | None = None) -> DataFrame:
    """(chunk, keys, found): what ``reduce`` finds, shard by shard, for each chunk.

    ``reduce`` gets all keys that a shard was sent and the aligned values by
    name (of the types ``kinds``); it returns a mask of the keys to answer and
    one int64 for each key. ``summary`` gets the same and returns keys and
    int64s of its own, which are answers to the chunk SUMMARY.
    """

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
        values = {n: np.frombuffer(b"".join(table.column(n).to_pylist()), kind) for n, kind in kinds.items()}
        keys = np.concatenate(parts)
        mask, found = reduce(keys, values)
        ends = np.cumsum([len(p) for p in parts])[:-1]
        rows = [
            (chunk, k[m].tobytes(), f[m].astype(np.int64).tobytes())
            for chunk, k, m, f in zip(table.column("chunk").to_pylist(), parts, np.split(mask, ends), np.split(found, ends), strict=True)
            if m.any()
        ]
        if summary:
            k, f = summary(keys, values)
            rows.append((SUMMARY, k.astype(np.uint64).tobytes(), f.astype(np.int64).tobytes()))
        chunk, k, f = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"chunk": pa.array(chunk, pa.int64()), "keys": pa.array(k, pa.binary()), "found": pa.array(f, pa.binary())})

    return sent.groupBy("shard").applyInArrow(run, "chunk long, keys binary, found binary")


def by_chunk(rows: DataFrame) -> DataFrame:
    """(chunk, answers): all answers to a chunk as structs of keys (uint64) and found (int64)."""
    return rows.groupBy("chunk").agg(F.collect_list(F.struct("keys", "found")).alias("answers"))


def answers(sent: DataFrame, reduce: Reduce, kinds: dict[str, type]) -> DataFrame:
    return by_chunk(answered(sent, reduce, kinds))


def merged(answer: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of all answers to a chunk, and what was found for each."""
    if not answer:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys = np.frombuffer(b"".join(a["keys"] for a in answer), np.uint64)
    found = np.frombuffer(b"".join(a["found"] for a in answer), np.int64)
    order = np.argsort(keys)
    return keys[order], found[order]


def lookup(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each key in the sorted ``known``; -1 if it is not there."""
    if not len(known):
        return np.full(len(keys), -1)
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[place] == keys, place, -1)

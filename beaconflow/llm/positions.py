"""A positional inverted index of documents, and phrase and proximity search in it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconflow.llm.words import plain_words, small_batches
from beaconflow.session import arrow_batches, new_shared_path, shared_table

#: Bytes of text in a segment of the index; a longer document is a segment of its own.
SEGMENT_BYTES = 4 << 20
#: Bytes after which the index begins another row group, as a reader holds a whole one.
GROUP_BYTES = 8 << 20
#: Bytes of texts or segments that a task gets at once.
BATCH_BYTES = 16 << 20
#: Words of test items that are searched for in one go.
QUERY_WORDS = 1_000_000
#: Free positions between two documents, so no match can span them.
GAP = 64

_INDEX = "segment long, docs array<{row}>, n_words binary, begins binary, terms binary, ends binary, places binary"


def build_index(documents: DataFrame, text: str = "text") -> DataFrame:
    """Segments of the index, written to the shared folder.

    A segment has some documents (all columns but ``text``), the number of
    words and first position of each, its distinct terms in the order of first
    use, and for each term the rising positions (posting list); ``ends`` says
    where in ``places`` a term's list ends. Positions count words (letters and
    digits, A-Z folded) with a gap between documents. Numbers are packed as
    int32 and terms joined by blanks, as Spark's reader takes three ints for
    one of an array. Segments come from single tasks, so nothing is shuffled
    and no term is ever hot; a few are a row group, however much a task reads.
    """
    rest = [c for c in documents.columns if c != text]
    rows = documents.select(*rest, F.col(text).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in small_batches(batches, "__text", SEGMENT_BYTES):
            numbers: dict[bytes, int] = {}
            each = [_codes(t.as_py(), numbers) for t in batch.column("__text")]
            codes = np.concatenate(each)
            counts = np.fromiter(map(len, each), np.int32, len(each))
            begins = (np.cumsum(counts + GAP) - counts - GAP).astype(np.int32)
            places = (np.arange(len(codes)) + np.repeat(np.arange(len(each)) * GAP, counts)).astype(np.int32)
            order = np.argsort(codes, kind="stable")
            ends = np.cumsum(np.bincount(codes, minlength=len(numbers))).astype(np.int32)
            columns = [batch.column(n) for n in rest]
            docs = pa.StructArray.from_arrays(columns, rest)
            packed = [counts.tobytes(), begins.tobytes(), b" ".join(numbers), ends.tobytes(), places[order].tobytes()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs), *(pa.array([x], pa.binary()) for x in packed)],
                ["segment", "docs", "n_words", "begins", "terms", "ends", "places"],
            )
            number += 1

    schema = _INDEX.format(row=documents.select(*rest).schema.simpleString())
    index = rows.mapInArrow(run, schema)
    path = new_shared_path(documents.sparkSession, "positions")
    # by default the first hundred segments of a task would be one row group
    groups = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1}
    with arrow_batches(documents.sparkSession, BATCH_BYTES):
        index.write.options(compression="zstd", **groups).parquet(path)
    return documents.sparkSession.read.schema(index.schema).parquet(path)


def _codes(text: bytes | None, numbers: dict[bytes, int]) -> np.ndarray:
    """Each word's number; new words get the next."""
    words = plain_words(text)
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))


class Segment:
    """One segment in memory: posting lists by term."""

    def __init__(self, row: dict):
        self.segment, self.docs = row["segment"], row["docs"]
        self.n_words, self.begins = row["n_words"], row["begins"]
        self.ends, self.places = row["ends"], row["places"]
        self.number = {t: i for i, t in enumerate(row["terms"])}

    def length(self, term: int) -> int:
        return int(self.ends[term] - (self.ends[term - 1] if term else 0))

    def postings(self, term: int) -> np.ndarray:
        return self.places[self.ends[term - 1] if term else 0 : self.ends[term]]

    def has(self, term: int, places: np.ndarray) -> np.ndarray:
        """Which of the places hold the term."""
        own = self.postings(term)
        at = np.minimum(np.searchsorted(own, places), len(own) - 1)
        return own[at] == places

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Starts of the phrase: lists are moved by their offset and intersected, rarest term first."""
        order = sorted(range(len(terms)), key=lambda j: self.length(terms[j]))
        starts = self.postings(terms[order[0]]) - order[0]
        for j in order[1:]:
            if not len(starts):
                break
            starts = starts[self.has(terms[j], starts + j)]
        return starts

    def near(self, terms: np.ndarray, within: int) -> np.ndarray:
        """Places of the rarest term that have every other term at most ``within`` words away, in one document."""
        order = sorted(set(terms.tolist()), key=lambda t: (self.length(t), t))
        places = self.postings(order[0])
        for term in order[1:]:
            own, doc = self.postings(term), self.document(places)
            low = np.maximum(places - within, self.begins[doc])
            high = np.minimum(places + within, self.begins[doc] + self.n_words[doc] - 1)
            places = places[np.searchsorted(own, low) < np.searchsorted(own, high, side="right")]
        return places

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, places, side="right") - 1


class Queries:
    """Word sequences of test items, as one matrix for each length."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int | None):
        numbers: dict[bytes, int] = {}
        groups: dict[int, dict[tuple, set[str]]] = {}
        for name, words in items:
            codes = [numbers.setdefault(w, len(numbers)) for w in words]
            size = min(window or len(codes), len(codes))
            for i in range(len(codes) - size + 1) if codes else ():
                groups.setdefault(size, {}).setdefault(tuple(codes[i : i + size]), set()).add(name)
        self.terms = list(numbers)
        self.groups = [(np.array(list(g)), list(g.values())) for g in groups.values()]

    def present(self, segment: Segment) -> Iterator[tuple[np.ndarray, set[str]]]:
        """(the segment's term numbers, items) of the sequences whose every term the segment has."""
        number = np.fromiter((segment.number.get(t, -1) for t in self.terms), np.int64, len(self.terms))
        for sequences, names in self.groups:
            own = number[sequences]
            for i in np.flatnonzero((own >= 0).all(axis=1)).tolist():
                yield own[i], names[i]


def _segments(batch: pa.RecordBatch) -> Iterator[Segment]:
    for i in range(batch.num_rows):
        row: dict = {"segment": batch.column("segment")[i].as_py(), "docs": batch.column("docs")[i].values}
        for name in ("n_words", "begins", "ends", "places"):
            row[name] = np.frombuffer(batch.column(name)[i].as_buffer(), np.int32)
        row["terms"] = batch.column("terms")[i].as_py().split()
        yield Segment(row)


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items' words, streamed through the driver in blocks of bounded size."""
    block, size = [], 0
    rows = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string"), F.col(text).cast("binary"))
    for name, words in rows.toLocalIterator():
        own = plain_words(bytes(words)) if words else []
        block.append((name, own))
        size += len(own)
        if size >= QUERY_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _phrase(segment: Segment, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = segment.phrase(terms)
    return starts, starts + len(terms)


def _near(within: int):
    def find(segment: Segment, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = segment.near(terms, within)
        return places, places + 1

    return find


def _search(index: DataFrame, items: DataFrame, find, window: int | None, item_id: str, text: str) -> DataFrame:
    """What is found, written to the shared folder, as a task's memory depends on a setting while it runs."""
    context = index.sparkSession.sparkContext
    doc = index.schema["docs"].dataType.elementType.simpleString()
    schema = f"segment long, row int, doc {doc}, n_words long, spans array<struct<begin:int,end:int>>, items array<string>"
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def searched(queries: Queries) -> DataFrame:
        shared = context.broadcast(queries)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for segment in _segments(batch):
                    spans: list[list] = [[] for _ in segment.n_words]
                    names: list[set] = [set() for _ in segment.n_words]
                    for terms, found in shared.value.present(segment):
                        begins, ends = find(segment, terms)
                        rows = segment.document(begins)
                        first = segment.begins[rows]
                        for r, b, e in zip(rows.tolist(), (begins - first).tolist(), (ends - first).tolist(), strict=True):
                            spans[r].append({"begin": b, "end": e})
                            names[r] |= found
                    n = len(spans)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, segment.segment)),
                            pa.array(np.arange(n, dtype=np.int32)),
                            segment.docs,
                            pa.array(segment.n_words.astype(np.int64)),
                            pa.array(spans, span),
                            pa.array([sorted(x) for x in names], pa.list_(pa.string())),
                        ],
                        ["segment", "row", "doc", "n_words", "spans", "items"],
                    )

        return index.mapInArrow(run, schema)

    parts = [searched(Queries(block, window)) for block in _blocks(items, item_id, text)] or [searched(Queries([], window))]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    if len(parts) > 1:
        every = every.groupBy("segment", "row").agg(
            F.first("doc").alias("doc"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
    with arrow_batches(index.sparkSession, BATCH_BYTES):
        return shared_table(every, "found", "zstd")


def find_phrases(index: DataFrame, items: DataFrame, window: int | None = 13, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Exact matches of the items' phrases, one row per indexed document.

    Columns: segment, row, doc (the document's columns), n_words, spans (first
    word and the one after the last of each match), items (ids as text of the
    items with a match). A phrase is each run of ``window`` words of an item,
    or the whole item if that is shorter or ``window`` is null. Items go to the
    tasks in blocks of bounded size; terms that a segment lacks rule a phrase
    out before any list is read. Items without words or id match nothing.
    """
    return _search(index, items, _phrase, window, item_id, text)


def find_near(index: DataFrame, items: DataFrame, within: int = 20, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Proximity matches: every place of an item's rarest word with all its other words at most ``within`` words away."""
    return _search(index, items, _near(within), None, item_id, text)


def contamination(documents: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """Per document, how many of its words lie in phrases of test items.

    All columns of ``documents`` but text are kept; n_words, n_hit, n_items,
    items (sorted ids as text) and contaminated (a twentieth of the words or
    more are hit) replace columns of those names, text_hash tells texts apart.

    Null or empty text: no words, not contaminated. Very long texts: a segment
    of their own. Repeated rows: one result each. Items that repeat an id count
    once; items with null id or without words match nothing. Empty tables:
    nothing is contaminated.
    """
    new = ("n_words", "n_hit", "n_items", "items", "contaminated", "text_hash")
    names = [c for c in documents.columns if c not in (*new, "text")]
    kept = documents.select(*names, "text").withColumn("text_hash", F.xxhash64(F.col("text").cast("binary")))
    found = find_phrases(build_index(kept), items, window)
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))
    hit = F.aggregate(
        F.array_sort("spans"),
        start,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["end"], s["begin"]))).alias("hit"),
        ),
        lambda acc: acc["hit"],
    )
    out = found.select("doc.*", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.array_sort("items").alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all columns, also those named like the operator's own.

    Null or empty text: no words, so it stays. Null doc_id: judged by its text.
    Very long texts are judged whole. Repeated rows stay or go together; rows
    of one doc_id with several texts are judged each by its own. No items, or
    only empty ones: all stay. Empty table: empty result.
    """
    judged = contamination(documents.select("doc_id", "text"), items).where("contaminated")
    bad = judged.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = documents["doc_id"].eqNullSafe(bad["__id"]) & (F.xxhash64(documents["text"].cast("binary")) == bad["__hash"])
    return documents.join(bad, same, "left_anti")

"""Removal of passages that earlier documents have, with automata of repeated phrases."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconflow.llm.chunks import answers, by_shard, documents_of, lookup, merged, pack, shard_count
from beaconflow.llm.words import WordHashes, sequence_hashes, space_words

#: Words of the phrases that stand for a window; a window is known by its phrase of least hash.
PHRASE = 5

_LAST = np.iinfo(np.int64).max


class _Words:
    """The words of a chunk's documents in one row, with the windows that lie within a document."""

    def __init__(self, docs: pa.StructArray, texts: list[bytes | None], cache: WordHashes, window: int):
        self.ids = docs.field("doc_id").cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)
        self.known = docs.field("doc_id").is_valid().to_numpy(zero_copy_only=False)
        each = [space_words(t) for t in texts]
        self.counts = np.array([len(w) for w in each], np.int64)
        self.words = [w for words in each for w in words]
        self.ends = np.cumsum(self.counts)
        self.hashes = cache.of(self.words)
        self.doc = np.repeat(np.arange(len(each)), self.counts)
        n = max(0, len(self.words) - window + 1)
        self.inside = self.doc[:n] == self.doc[len(self.words) - n :]
        self.inside &= self.known[self.doc[:n]]

    def phrase_hashes(self) -> np.ndarray:
        return sequence_hashes(self.hashes, PHRASE)


def _least_phrases(words: _Words, window: int) -> np.ndarray:
    """Start of the phrase of least hash in each window."""
    spans = np.lib.stride_tricks.sliding_window_view(words.phrase_hashes(), window - PHRASE + 1)
    return np.argmin(spans, axis=1) + np.arange(len(spans))


def _distinct(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys with the smallest and largest document of each."""
    if not len(keys):
        return keys, docs, docs
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.minimum.reduceat(docs, starts), np.maximum.reduceat(docs, starts)


def _send_phrases(window: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for chunk, docs, texts, _ in documents_of(batch):
                words = _Words(docs, texts, cache, window)
                if not words.inside.any():
                    continue
                at = np.unique(_least_phrases(words, window)[words.inside])
                keys, low, high = _distinct(words.phrase_hashes()[at], words.ids[words.doc[at]])
                yield by_shard(chunk, keys, shards, several=low < high)

    return run


def _repeated(keys: np.ndarray, values: dict) -> tuple[np.ndarray, np.ndarray]:
    """Keys that several chunks sent, or one for several of its documents."""
    _, place, n = np.unique(keys, return_inverse=True, return_counts=True)
    several = np.bincount(place, values["several"]) > 0
    return ((n > 1) | several)[place], np.zeros(len(keys), np.int64)


def _earlier(keys: np.ndarray, values: dict) -> tuple[np.ndarray, np.ndarray]:
    """The smallest document of each key, for chunks that have a larger one."""
    distinct, place = np.unique(keys, return_inverse=True)
    least = np.full(len(distinct), _LAST)
    np.minimum.at(least, place, values["low"])
    return least[place] < values["high"], least[place]


def _automaton(words: _Words, phrases: np.ndarray) -> ahocorasick.Automaton | None:
    """Compiled from the wording that this chunk has for its share of the repeated phrases."""
    hashes = words.phrase_hashes()
    starts = np.flatnonzero(lookup(hashes, phrases) >= 0)
    if not len(starts):
        return None
    _, first = np.unique(hashes[starts], return_index=True)
    found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for i in starts[first].tolist():
        found.add_word((b" " + b" ".join(words.words[i : i + PHRASE]) + b" ").decode("latin-1"))
    found.make_automaton()
    return found


def _occurrences(words: _Words, automaton: ahocorasick.Automaton) -> np.ndarray:
    """Number of the first word of every occurrence, all documents streamed one after the other."""
    out, begin = [], 0
    for end in words.ends.tolist():
        own = words.words[begin:end]
        if len(own) >= PHRASE:
            line = (b" " + b" ".join(own) + b" ").decode("latin-1")
            hits = np.fromiter((last for last, _ in automaton.iter(line)), np.int64)
            if len(hits):
                # hits are the blanks after a phrase's last word
                after = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
                out.append(begin + np.searchsorted(after, hits) - PHRASE + 1)
        begin = end
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.int64)


def _send_windows(window: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for chunk, docs, texts, rest in documents_of(batch):
                phrases, _ = merged(rest["answers"])
                words = _Words(docs, texts, cache, window)
                automaton = _automaton(words, phrases) if len(phrases) else None
                if automaton is None or not words.inside.any():
                    continue
                at = _occurrences(words, automaton)
                edge = np.zeros(len(words.words) + 1, np.int64)
                np.add.at(edge, np.maximum(at - (window - PHRASE), 0), 1)
                np.add.at(edge, at + 1, -1)
                starts = np.flatnonzero((np.cumsum(edge)[: len(words.inside)] > 0) & words.inside)
                keys, low, high = _distinct(sequence_hashes(words.hashes, window)[starts], words.ids[words.doc[starts]])
                if len(keys):
                    yield by_shard(chunk, keys, shards, low=low, high=high)

    return run


def _cover(window: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for _, docs, texts, rest in documents_of(batch):
                keys, least = merged(rest["answers"])
                words = _Words(docs, texts, cache, window)
                edge = np.zeros(len(words.words) + 1, np.int64)
                if len(keys) and len(words.inside):
                    place = lookup(sequence_hashes(words.hashes, window), keys)
                    gone = words.inside & (place >= 0) & (least[place] < words.ids[words.doc[: len(place)]])
                    np.add.at(edge, np.flatnonzero(gone), 1)
                    np.add.at(edge, np.flatnonzero(gone) + window, -1)
                keep = np.cumsum(edge)[:-1] == 0
                removed = np.bincount(words.doc[~keep], minlength=len(words.counts))
                kept, begin = [], 0
                for end, cut in zip(words.ends.tolist(), removed.tolist(), strict=True):
                    own = words.words[begin:end]
                    kept.append(b" ".join([w for w, k in zip(own, keep[begin:end].tolist(), strict=True) if k] if cut else own))
                    begin = end
                columns = [pa.array(texts, pa.binary()) if n == "__text" else docs.field(n) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(words.counts), pa.array(removed.astype(np.int64)), pa.array(kept, pa.binary())],
                    [*names, "__n_words", "__n_removed", "__kept"],
                )

    return run


def remove_repeated_words(documents: DataFrame, window: int = 13) -> DataFrame:
    """Each document without the words that a smaller document's windows cover.

    ``documents`` has doc_id and text; all columns are kept, and n_words,
    n_removed and kept (the words that stay, joined by one blank) replace
    columns of those names. A word goes if it lies in a run of ``window`` words
    that also begins in a document of smaller doc_id; all runs are judged on
    the input.

    1. Documents are packed into chunks. Each window is known by its phrase of
       least hash; phrases that several documents have are confirmed by shards.
    2. Each chunk compiles an Aho-Corasick automaton of its share of them and
       streams all its documents through it. Only windows around an occurrence
       can repeat; shards find the smallest document of each.
    3. Windows with a smaller document cover the words that go.

    Windows are compared by 64-bit hashes of hashed words. Null or empty text:
    no words, kept is empty. Null doc_id: has no place in the order, so it
    neither loses words nor makes others lose any. Repeated rows and rows of
    one doc_id: treated alike, as none is smaller. Empty table: empty result.
    """
    if window < PHRASE:
        raise ValueError(f"a window has at least {PHRASE} words")
    names = [c for c in documents.columns if c not in ("n_words", "n_removed", "kept")]
    chunks = pack(documents.select(*names).withColumn("__text", F.col("text").cast("binary")).drop("text"), "__text")
    shards = shard_count(chunks)
    sent = chunks.mapInArrow(_send_phrases(window, shards), "chunk long, shard long, keys binary, several binary")
    asked = chunks.join(answers(sent, _repeated, {"several": np.bool_}), "chunk")
    sent = asked.mapInArrow(_send_windows(window, shards), "chunk long, shard long, keys binary, low binary, high binary")
    told = chunks.join(answers(sent, _earlier, {"low": np.int64, "high": np.int64}), "chunk", "left")
    carried = ["__text" if n == "text" else n for n in names]
    types = {f.name: f.dataType for f in documents.schema.fields}
    out = [T.StructField(n, types.get(n, T.BinaryType())) for n in carried]
    out += [T.StructField("__n_words", T.LongType()), T.StructField("__n_removed", T.LongType()), T.StructField("__kept", T.BinaryType())]
    found = told.mapInArrow(_cover(window, carried), T.StructType(out))
    columns = [F.col("__text").cast("string").alias("text") if n == "__text" else F.col(n) for n in carried]
    return found.select(
        *columns, F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.col("__kept").cast("string").alias("kept")
    )


def drop_repeated_passages(documents: DataFrame) -> DataFrame:
    """The documents without passages that an earlier one has; n_chars, if there, counts the new text.

    A document that loses nothing stays as it is; one that loses words has the
    others joined by one blank.
    """
    own = {c: f"__own_{c}" for c in ("n_words", "n_removed", "kept") if c in documents.columns}
    found = remove_repeated_words(documents.withColumnsRenamed(own))
    less = F.col("n_removed") > 0
    new = {"text": F.when(less, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in documents.columns:
        count = F.length("kept").cast(documents.schema["n_chars"].dataType)
        new["n_chars"] = F.when(less, count).otherwise(F.col("n_chars"))
    return found.select(*[new.get(c, F.col(own.get(c, c))).alias(c) for c in documents.columns])

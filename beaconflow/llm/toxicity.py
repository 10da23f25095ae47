"""Toxicity of documents: the worst window under a recurrent network."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconflow.llm.gru import Adam, Network
from beaconflow.llm.words import plain_words, small_batches

#: Words of a window, and from one window's start to the next.
WINDOW, STRIDE = 32, 16
#: Labelled documents of each class that the model is fitted on, chosen by a hash of their ids.
SAMPLE = 2000
#: Windows of each of them that take part, spread evenly over the text.
SAMPLE_WINDOWS = 256
EPOCHS, BATCH = 12, 128
#: Lengths of the character n-grams, and buckets that words and n-grams are hashed to.
CHAR_SIZES = (3, 4, 5, 6, 7)
WORD_BUCKETS, CHAR_BUCKETS = 1 << 17, 1 << 19
#: Distinct words that a task keeps the inputs of, and words whose n-grams are in memory at once.
MEMORY, BLOCK = 100_000, 8192
#: Windows that go through the network at once.
WIDTH = 4096


def _word_buckets(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh32_intdigest(w) for w in words), np.int64, len(words)) % WORD_BUCKETS


def _char_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the character n-grams (bytes, with marked word ends) of all words.

    Also the word of each, and whether it begins with the word. They come by
    length; a word always has one of the shortest.
    """
    line = np.frombuffer(b"".join([b"\x02%b\x03" % w for w in words]), np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    code, found = np.zeros(len(line), np.uint32), []
    for n in range(1, CHAR_SIZES[-1] + 1):
        code = code[: len(line) - n + 1] * np.uint32(0x01000193) + line[n - 1 :]
        if n in CHAR_SIZES:
            inside = np.flatnonzero(np.arange(len(code)) + n <= ends[: len(code)])
            mixed = (code[inside] ^ np.uint32(n)) * np.uint32(0x9E3779B1)
            found.append(((mixed >> np.uint32(12)) % np.uint32(CHAR_BUCKETS), owner[inside], line[inside] == 2))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Inputs:
    """Word and character inputs: how strongly a word's and its n-grams' buckets go with the label, and a hashed code.

    Strengths are counted once, over the sampled training documents that hold
    the bucket, as a z-score that few documents cannot raise. Documents that
    share their three words of least hash are taken for copies and count once.
    """

    SIZE = 8

    def __init__(self, documents: Iterable[list[bytes]], labels: np.ndarray):
        words, chars = np.zeros((2, WORD_BUCKETS)), np.zeros((2, CHAR_BUCKETS))
        met: set[tuple] = set()
        for own, label in zip(documents, labels.tolist(), strict=True):
            distinct = sorted(set(own), key=xxhash.xxh32_intdigest)
            alike = (label, *distinct[:3])
            if distinct and alike not in met:
                met.add(alike)
                words[label, np.unique(_word_buckets(distinct))] += 1
                chars[label, np.unique(_char_buckets(distinct)[0])] += 1
        seen = np.bincount([m[0] for m in met], minlength=2) + 0.5
        self.words, self.chars = (self._strength(x, seen[1] / seen.sum()) for x in (words, chars))

    @staticmethod
    def _strength(counts: np.ndarray, share: float) -> np.ndarray:
        n = counts.sum(axis=0)
        z = (counts[1] - n * share) / np.sqrt((n + 10) * share * (1 - share))
        return np.clip(z / 4, -2, 4).astype(np.float32)

    def of(self, words: list[bytes]) -> np.ndarray:
        blocks = [self._block(words[i : i + BLOCK]) for i in range(0, len(words), BLOCK)]
        return np.vstack(blocks) if blocks else np.zeros((0, self.SIZE), np.float32)

    def _block(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), self.SIZE), np.float32)
        if words:
            bucket, (chars, owner, begins) = _word_buckets(words), _char_buckets(words)
            order = np.argsort(owner, kind="stable")
            owner, begins = owner[order], begins[order]
            strength = self.chars[chars[order]]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            out[:, 0] = self.words[bucket]
            out[:, 1] = np.add.reduceat(strength, first) / np.diff(np.append(first, len(owner)))
            out[:, 2] = np.maximum.reduceat(strength, first)
            out[:, 3] = np.minimum.reduceat(strength, first)
            out[:, 4] = np.maximum.reduceat(np.where(begins, strength, np.float32(-2)), first)
            bits = bucket[:, None] * 40503 >> np.arange(3, 3 + self.SIZE - 5)
            out[:, 5:] = ((bits & 1) - 0.5).astype(np.float32) * 0.2
        return out


class _Codes(dict):
    """word -> its row in the table of gate inputs; 0 is padding. Emptied when full, between batches."""

    def __init__(self, inputs: Inputs, network: Network):
        super().__init__()
        self.inputs, self.network = inputs, network
        self.gates = network.project(np.zeros((1, Inputs.SIZE), np.float32))
        self.used = 1

    def of(self, documents: list[list[bytes]]) -> np.ndarray:
        if len(self) >= MEMORY:
            self.clear()
            self.used = 1
        # dict.fromkeys keeps the order of first use, so codes do not depend on hashing
        fresh = [w for w in dict.fromkeys(w for d in documents for w in d) if w not in self]
        if fresh:
            end = self.used + len(fresh)
            if end > len(self.gates):
                self.gates = np.vstack([self.gates, np.empty((max(end, len(self.gates) * 5 // 4) - len(self.gates), self.gates.shape[1]), np.float32)])
            self.gates[self.used : end] = self.network.project(self.inputs.of(fresh))
            self.update(zip(fresh, range(self.used, end), strict=True))
            self.used = end
        n = sum(map(len, documents))
        return np.fromiter((self[w] for d in documents for w in d), np.int32, n)


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, words) of all overlapping windows; together they hold every word.

    ``counts`` has the words of each document. The last window ends with the
    document; a short document, also an empty one, is one short window.
    """
    n = 1 + -(-np.maximum(counts - WINDOW, 0) // STRIDE)
    doc = np.repeat(np.arange(len(counts)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.minimum(place * STRIDE, np.maximum(counts[doc] - WINDOW, 0))
    return doc, start, np.minimum(counts[doc], WINDOW)


def _matrix(codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of windows (windows, WINDOW) with 0 as padding, and the mask."""
    step = np.arange(WINDOW)
    inside = step < sizes[:, None]
    if not len(codes):
        return np.zeros(inside.shape, np.int32), inside.astype(np.float32)
    place = np.where(inside, begins[:, None] + step, 0)
    return np.where(inside, codes[place], 0), inside.astype(np.float32)


class Model:
    """A fitted network with its inputs; ``scale`` and ``shift`` turn a document's largest logit into a probability's."""

    def __init__(self, inputs: Inputs, network: Network, scale: float = 1.0, shift: float = 0.0):
        self.inputs, self.network, self.scale, self.shift = inputs, network, scale, shift

    def codes(self) -> _Codes:
        return _Codes(self.inputs, self.network)

    def worst(self, documents: list[list[bytes]], codes: _Codes) -> np.ndarray:
        """The largest window logit of each document, all windows scored."""
        if not documents:
            return np.empty(0)
        line = codes.of(documents)
        counts = np.fromiter(map(len, documents), np.int64, len(documents))
        doc, start, size = windows(counts)
        begin = (np.cumsum(counts) - counts)[doc] + start
        logit = np.empty(len(doc), np.float32)
        # whole windows need no mask
        for pick, masked in ((np.flatnonzero(size == WINDOW), False), (np.flatnonzero(size < WINDOW), True)):
            for i in range(0, len(pick), WIDTH):
                at = pick[i : i + WIDTH]
                matrix, mask = _matrix(line, begin[at], size[at])
                logit[at] = self.network.logits(codes.gates, matrix, mask if masked else None)
        return np.maximum.reduceat(logit, np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]))

    def scores(self, documents: list[list[bytes]], codes: _Codes) -> np.ndarray:
        logit = self.scale * self.worst(documents, codes).astype(float) + self.shift
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _spread(words: list[bytes]) -> list[bytes]:
    """Windows of a training document, at most SAMPLE_WINDOWS, spread evenly; words joined by blanks."""
    _, start, _ = windows(np.array([len(words)]))
    if len(start) > SAMPLE_WINDOWS:
        start = start[np.linspace(0, len(start) - 1, SAMPLE_WINDOWS).astype(int)]
    return [b" ".join(words[s : s + WINDOW]) for s in start.tolist()]


def fit(texts: list[list[bytes]], labels: np.ndarray, share: float) -> Model:
    """A model of the sampled documents, given as lists of windows (words
    joined by blanks); ``share`` is the share of label 1 among all.

    A label is the document's, not a window's: in each round every document is
    represented by the window that scores highest so far (first, by its inputs
    alone), and one window by chance if its label is 0. At the end a logistic
    curve over the documents' largest logits, weighted back to ``share``, makes
    the score a probability.
    """
    rng = np.random.default_rng(5)
    inputs = Inputs((b" ".join(t).split() for t in texts), labels)
    network = Network(Inputs.SIZE)
    rate = min(max(share, 1e-4), 1 - 1e-4)
    if len(set(labels.tolist())) < 2:  # nothing to tell apart: the score is the share
        return Model(inputs, network, 0.0, float(np.log(rate / (1 - rate))))
    number: dict[bytes, int] = {}
    rows = [[1 + number.setdefault(w, len(number)) for w in window.split()] for t in texts for window in t]
    features = np.vstack([np.zeros((1, Inputs.SIZE), np.float32), inputs.of(list(number))])
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    line = np.fromiter((c for r in rows for c in r), np.int32, int(size.sum()))
    matrix, mask = _matrix(line, np.cumsum(size) - size, size)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])

    def leading(value: np.ndarray) -> np.ndarray:
        order = np.lexsort((-value, doc))
        return order[first]

    def everywhere(n: Network) -> np.ndarray:
        gates = n.project(features)
        return np.concatenate([n.logits(gates, matrix[i : i + WIDTH], mask[i : i + WIDTH]) for i in range(0, len(matrix), WIDTH)])

    adam = Adam(network.p)
    value = ((features[matrix, 0] + features[matrix, 2]) * mask).max(axis=1)
    for epoch in range(EPOCHS):
        adam.rate = 0.02 * (1 - epoch / EPOCHS) + 0.002
        chance = first + (rng.random(len(first)) * np.diff(np.append(first, len(doc)))).astype(int)
        pick = np.concatenate([leading(value), chance[labels == 0]])
        goal = labels[doc[pick]].astype(np.float32)
        order = rng.permutation(len(pick))
        for i in range(0, len(order), BATCH):
            at = pick[order[i : i + BATCH]]
            used, codes = np.unique(matrix[at], return_inverse=True)
            _, gradient = network.gradients(features[used], codes.reshape(len(at), WINDOW), mask[at], goal[order[i : i + BATCH]])
            adam.step(gradient)
        value = everywhere(network)
    return Model(inputs, network, *_curve(np.maximum.reduceat(value, first).astype(float), labels, rate))


def _curve(logits: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Scale and shift of a logistic curve, fitted by Newton's steps with a small ridge; both classes weigh as in ``share``."""
    weight = np.where(labels == 1, share / np.mean(labels), (1 - share) / (1 - np.mean(labels)))
    x, beta = np.column_stack([logits, np.ones(len(logits))]), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - labels)) + 1e-2 * (beta - [1, 0])
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return max(float(beta[0]), 1e-3), float(beta[1])


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """A model from ``labels`` (doc_id, toxic) and the documents that they name.

    Fitted on at most SAMPLE documents of each class, those of least hash of
    doc_id, and SAMPLE_WINDOWS windows of each, so what reaches the driver is
    bounded. Labels other than 0 and 1 and null ids are left out; without rows
    of both classes the score is the share of label 1.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("__label"))
    counts = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    texts, values = [], []
    for label in (0, 1):
        ids = known.where(F.col("__label") == label).select("__id").distinct().orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE)
        named = documents.join(F.broadcast(ids), documents["doc_id"].cast("long") == ids["__id"])
        cut = named.select(F.col("__id").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        cut = cut.mapInArrow(_windows_of, "doc_id long, windows array<binary>")
        # a table may repeat an id: the bound holds for rows too
        found = cut.orderBy("doc_id", F.hash("windows")).limit(2 * SAMPLE).toArrow().column("windows").to_pylist()
        texts += found
        values += [label] * len(found)
    return fit(texts, np.array(values, np.int64), share)


def _windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", 1 << 20):
        found = [_spread(plain_words(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.binary()))], ["doc_id", "windows"])


def score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``documents`` with a column ``name``, from 0 to 1 (higher: label 1 likelier).

    Every word of every text lies in a window, and the worst window decides. A
    null or empty text is one empty window. Rows are independent; a column of
    that name is replaced, all others are kept; an empty table gives an empty
    result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.drop(name)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value.codes()
        for batch in small_batches(batches, "text", 1 << 20):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = shared.value.scores([plain_words(t) for t in texts], codes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.DoubleType())]))


def held_out(doc_id: str = "doc_id"):
    """Whether a document's label stays unseen: crc32 of its id as text is 2 modulo 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.3 on) of each document.

    Null or empty text: scored as one empty window. Very long texts: every
    window is scored, the worst decides. Null doc_id: scored, not held out.
    Ties and repeated rows: the same score each. Null labels, ids of no
    document, or no labels at all: see :func:`train`. Empty table: empty
    result. Other columns are left out, whatever their names.
    """
    model = train(documents, labels.where(~held_out()))
    found = score(documents.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all columns, also those named like the operator's own.

    Nulls, empty and very long texts and repeated rows are judged as in
    :func:`toxicity`; each row stays or goes by itself. Empty table: empty result.
    """
    model = train(documents, labels.where(~held_out()))
    return score(documents, model, "__toxicity").where("__toxicity < 0.3").drop("__toxicity")

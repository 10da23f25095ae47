"""A hashed maximum-entropy language model with class-factored words.

The probability of a word is that of its class, given the words before, times
that of its subclass within the class, given the class and the words before,
times its smoothed relative frequency within the subclass. Class and subclass
are softmaxes over the sum of the weights of hashed n-gram and skip features,
on top of log-frequencies; the weights follow the gradients of all training
tokens. A word that training texts do not have is one type with a class of its
own, fitted on the words that they have once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconflow.llm.chunks import SUMMARY, answered, by_chunk, by_shard, documents_of, lookup, merged, pack, shard_count
from beaconflow.llm.words import WordHashes, lower_words
from beaconflow.session import drop_table, shared_table

#: A word with this share of all tokens or more is a class of its own; there are at most 1 / OWN_CLASS of them.
OWN_CLASS = 1 / 512
#: Classes of the other words, by how they begin and whether a mark ends them.
SHAPES = 32
#: Subclasses of a class, by a hash of the word.
SUBS = 32
#: Hash buckets of the three kinds of features of a class: the word before, the classes of the two before, those before the last.
BUCKETS = (1 << 14, 1 << 13, 1 << 13)
#: Features of a subclass, each a word so many places back together with the class. One bucket for so many training
#: tokens, from the least to the most that a worker is to hold (2 ** 16 rows in all, 8.4 MB).
BACK, TOKENS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = (1, 2), 64, 1 << 10, 1 << 15
#: Tokens of a gradient step, and the first step's length, chosen among 0.4, 1, 1.5 and 2 by a tenth of the learned texts.
STEP, RATE = 8192, 1.5
#: Row ranges of each table of weights that are merged apart, and how many tasks' weights meet in one task.
RANGES, FAN_IN = 16, 64
#: Chunks that one task learns from, unless cores would stand idle: each task gives out weights of its own.
TASK_CHUNKS = 6

#: The token that ends every text; no word holds a blank.
END = b" "

_MARKS = np.isin(np.arange(256), list(b".,;:!?"))


def shapes_of(words: list[bytes]) -> np.ndarray:
    """One of SHAPES classes of each word, from its first two bytes and its last."""
    line = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    first, half = ends - sizes, SHAPES // 2
    second = np.where(sizes > 1, line[np.minimum(first + 1, ends - 1)], 0)
    return (line[first] * 31 + second * 17) % half + half * _MARKS[line[ends - 1]]


def learns(doc_id: str = "doc_id"):
    """Whether a document is learned from: crc32 of its id as text is not 1 modulo 5. A null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 1, F.lit(False))


class Classes(NamedTuple):
    """Classes of words: sorted keys of the words with one of their own, the weight of each (shape, subclass), class priors, N and V."""

    own: np.ndarray
    cell_size: np.ndarray
    prior: np.ndarray
    tokens: int
    types: int

    @property
    def buckets(self) -> int:
        """Buckets of each feature of a subclass: a power of two that follows the training tokens."""
        return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (self.tokens // TOKENS_PER_BUCKET).bit_length()))

    @property
    def shapes(self) -> tuple[tuple[int, int], tuple[int, int]]:
        """(rows, columns) of the weights of classes and of subclasses."""
        return (sum(BUCKETS), len(self.prior)), (len(BACK) * self.buckets, SUBS)

    @property
    def sub_prior(self) -> np.ndarray:
        """Log-frequency of each subclass within its shape; a shape without words has even ones."""
        size = self.cell_size + 1e-6
        return np.log(size / size.sum(axis=1, keepdims=True)).astype(np.float32)

    @property
    def unknown(self) -> int:
        return len(self.own) + SHAPES

    def of(self, keys: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        place = lookup(keys, self.own)
        return np.where(place >= 0, place, len(self.own) + shapes)

    def within(self, counts: np.ndarray, shapes: np.ndarray, subs: np.ndarray) -> np.ndarray:
        """Log-probability of words within their (shape, subclass)."""
        return np.log(counts + 0.5) - np.log(np.maximum(self.cell_size[shapes, subs], 0.5))


def subs_of(keys: np.ndarray) -> np.ndarray:
    """The subclass of each word, by its key."""
    return ((keys >> np.uint64(40)) % np.uint64(SUBS)).astype(np.int64)


class _Chunk:
    """Words of a chunk as codes of its distinct words, every document closed by END."""

    def __init__(self, docs: pa.StructArray, texts: list[bytes | None]):
        each = [lower_words(t) for t in texts]
        for words in each:
            words.append(END)
        self.counts = np.fromiter(map(len, each), np.int64, len(each))
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__  # each new word gets the next number
        self.codes = np.fromiter(map(numbers.__getitem__, chain([END], chain.from_iterable(each))), np.int32, self.counts.sum() + 1)[1:]
        self.words = list(numbers)
        self.learned = docs.field("__learned").to_numpy(zero_copy_only=False).astype(bool)


def _send_counts(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for chunk, docs, texts, _ in documents_of(batch):
                own = _Chunk(docs, texts)
                learned = np.bincount(own.codes[np.repeat(own.learned, own.counts)], minlength=len(own.words))
                keys = cache.of(own.words)
                shapes = shapes_of(own.words).astype(np.uint8)
                order = np.argsort(keys)
                yield by_shard(chunk, keys[order], shards, count=learned[order], shape=shapes[order])

    return run


def _total(keys: np.ndarray, values: dict) -> tuple[np.ndarray, np.ndarray]:
    _, place = np.unique(keys, return_inverse=True)
    total = np.bincount(place, values["count"]).astype(np.int64)
    return np.ones(len(keys), bool), total[place]


def _summary(keys: np.ndarray, values: dict) -> tuple[np.ndarray, np.ndarray]:
    """Words, tokens, words met once, then these of each (shape, subclass); then (key, count, shape) of the most frequent.

    Of fixed size: no more than 1 / OWN_CLASS words can have a class of their own.
    """
    distinct, first, place = np.unique(keys, return_index=True, return_inverse=True)
    total, shapes = np.bincount(place, values["count"]).astype(np.int64), values["shape"][first].astype(np.int64)
    known, cells = total > 0, shapes * SUBS + subs_of(distinct)
    sums = [known.sum(), total.sum(), (total == 1).sum()]
    words, tokens = (np.bincount(cells[known], w, minlength=SHAPES * SUBS).astype(np.int64) for w in (None, total[known]))
    once = np.bincount(cells[total == 1], minlength=SHAPES * SUBS)
    top = np.argsort(-total, kind="stable")[: int(1 / OWN_CLASS)]
    head = np.concatenate([sums, words, tokens, once])
    return np.concatenate([np.zeros(len(head), np.uint64), distinct[top], distinct[top]]), np.concatenate([head, total[top], shapes[top]])


def _classes(rows: DataFrame) -> Classes:
    """From the summaries of all shards; each is folded in as it comes."""
    head = np.zeros(3 + 3 * SHAPES * SUBS, np.int64)
    best: dict[int, tuple[int, int]] = {}
    for r in rows.where(F.col("chunk") == SUMMARY).select("keys", "found").toLocalIterator():
        found, keys = np.frombuffer(r["found"], np.int64), np.frombuffer(r["keys"], np.uint64)
        n = (len(found) - len(head)) // 2
        head += found[: len(head)]
        best |= {k: (c, s) for k, c, s in zip(keys[len(head) :][:n].tolist(), found[len(head) :][:n].tolist(), found[len(head) + n :].tolist(), strict=True)}
        if len(best) > 20_000:
            best = dict(sorted(best.items(), key=lambda e: -e[1][0])[: int(1 / OWN_CLASS)])
    types, tokens, once = head[:3].tolist()
    words, uses, single = head[3:].astype(float).reshape(3, SHAPES, SUBS)
    end = WordHashes()[END]
    own = sorted(k for k, (c, _) in best.items() if (c >= OWN_CLASS * tokens and c > 1) or k == end)
    for k in own:
        count, s = best[k]
        cell = s, int(subs_of(np.array([k], np.uint64))[0])
        words[cell] -= 1
        uses[cell] -= count
        single[cell] -= count == 1
    prior = np.array([*(best[k][0] for k in own), *(uses - single).sum(axis=1), once], float) + 0.5
    return Classes(np.array(own, np.uint64), uses + 0.5 * words, np.log(prior / prior.sum()), tokens, types)


_CODED = "chunk long, doc_ids array<long>, learned array<boolean>, n array<long>, codes array<int>, counts array<long>, classes array<int>, keys array<long>"


def _code(classes) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for chunk, docs, texts, rest in documents_of(batch):
                own, (known, found) = _Chunk(docs, texts), merged(rest["answers"])
                keys = cache.of(own.words)
                counts = found[lookup(keys, known)]
                shapes = shapes_of(own.words)
                kind = np.where(counts > 0, classes.value.of(keys, shapes), classes.value.unknown)
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                columns = [docs.field("doc_id").cast(pa.int64()), pa.array(own.learned), *map(pa.array, (own.counts, own.codes, counts, kind.astype(np.int32), keys.view(np.int64)))]
                names = ["chunk", "doc_ids", "learned", "n", "codes", "counts", "classes", "keys"]
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), *(one(c) for c in columns)], names)

    return run


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Tokens:
    """A coded chunk: for each token its document, class and features, and those of the subclass of ``inner`` tokens, whose class has several words."""

    def __init__(self, batch: pa.RecordBatch, row: int, classes: Classes):
        get = lambda name: batch.column(name)[row].values.to_numpy(zero_copy_only=False)
        self.ids, self.learned, self.n = batch.column("doc_ids")[row].values, get("learned").astype(bool), get("n")
        codes, counts, kinds, keys = get("codes"), get("counts"), get("classes").astype(np.int64), get("keys").view(np.uint64)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self.count, self.kind = counts[codes], kinds[codes]
        # what comes once tells as little about the next word as what never came
        rare = counts <= 1
        seen = np.where(rare, classes.unknown, kinds)[codes]
        bucket = np.where(rare, 0, ((keys >> np.uint64(20)) % np.uint64(BUCKETS[0])).astype(np.int64))[codes]
        place = np.arange(len(codes)) - np.repeat(np.cumsum(self.n) - self.n, self.n)
        many = len(classes.prior) + 1

        def back(x: np.ndarray, k: int, start: int) -> np.ndarray:
            out = np.full(len(x), start, np.int64)
            out[k:] = x[: len(x) - k]
            out[place < k] = start
            return out

        before = [back(seen, k, many - 1) for k in (1, 2, 3)]
        spread = lambda x, n: (x * 2654435761 >> 5) % n if many * many > n else x
        self.features = np.empty((len(codes), 3), np.int32)
        self.features[:, 0] = back(bucket, 1, 1)
        self.features[:, 1] = BUCKETS[0] + spread(before[0] * many + before[1], BUCKETS[1])
        self.features[:, 2] = BUCKETS[0] + BUCKETS[1] + spread(before[1] * many + before[2], BUCKETS[2])
        del before, bucket
        self.inner = np.flatnonzero((self.kind >= len(classes.own)) & (self.count > 0))
        self.shape, self.sub = self.kind[self.inner] - len(classes.own), subs_of(keys).astype(np.int32)[codes[self.inner]]
        heard = np.where(rare, np.uint64(1), keys)[codes].view(np.int64)
        class_hash = self.kind[self.inner].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.inner_features = np.empty((len(self.inner), len(BACK)), np.int32)
        for i, k in enumerate(BACK):
            context = _mixed(_mixed(back(heard, k, 0)[self.inner].view(np.uint64) + np.uint64(k)) + class_hash)
            self.inner_features[:, i] = (context % np.uint64(classes.buckets)).astype(np.int32) + i * classes.buckets


def _exponentials(weights: np.ndarray, prior: np.ndarray, features: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials of the summed weights of each token's features by class, their sums, and the logit of ``target``.

    ``prior`` is one row, or one for each token. One common shift keeps them in range; should a token lie so far below it
    that nothing of it is left, each token is shifted by itself.
    """
    logit = weights.take(features[:, 0], axis=0)
    for j in range(1, features.shape[1]):
        logit += weights.take(features[:, j], axis=0)
    logit += prior
    logit -= logit.max()
    one, place = np.ones(logit.shape[1], np.float32), np.arange(len(target))
    own, power = logit[place, target], np.exp(logit)
    total = power @ one
    if total.size and total.min() < 1e-30:
        logit -= logit.max(axis=1, keepdims=True)
        own, power = logit[place, target], np.exp(logit)
        total = power @ one
    return power, total, own


def _log_probability(weights: np.ndarray, prior: np.ndarray, features: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probability of each token's class, or subclass, ``target``."""
    _, total, own = _exponentials(weights, prior, features, target)
    return own - np.log(total)


def _row_sums(gradient: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sums of the gradient's rows in each run of ``order``.

    Most runs are short: the k-th members of all runs that have so many are
    added at once, and the few long runs that are left are summed up by themselves.
    """
    sizes = np.diff(np.append(starts, len(order)))
    out = gradient.take(order[starts], axis=0)
    alive, k = np.flatnonzero(sizes > 1), 1
    while len(alive) > 64:
        out[alive] += gradient.take(order[starts[alive] + k], axis=0)
        k += 1
        alive = alive[sizes[alive] > k]
    for i in alive.tolist():
        out[i] += gradient.take(order[starts[i] + k : starts[i] + sizes[i]], axis=0).sum(axis=0)
    return out


class _Learner:
    """Weights of one task for one softmax, moved by adaptive steps along the gradient of its tokens."""

    def __init__(self, weights: np.ndarray, buckets: tuple[int, ...]):
        self.weights, self.buckets = weights.copy(), buckets
        self.square = np.zeros(len(weights), np.float32)
        self.uses = np.zeros(len(weights), np.float32)

    def learn(self, features: np.ndarray, target: np.ndarray, prior: np.ndarray) -> None:
        """``prior`` has one row, or one for each token."""
        for i in range(0, len(target), STEP):
            own, goal = features[i : i + STEP], target[i : i + STEP]
            gradient, total, _ = _exponentials(self.weights, prior if prior.ndim == 1 else prior[i : i + STEP], own, goal)
            gradient /= total[:, None]
            gradient[np.arange(len(goal)), goal] -= 1
            base = 0
            for j, buckets in enumerate(self.buckets):
                # 16-bit integers are sorted by their digits, in linear time
                local = (own[:, j] - base).astype(np.uint16)
                order = np.argsort(local, kind="stable")
                local = local[order]
                starts = np.flatnonzero(np.r_[True, local[1:] != local[:-1]])
                rows = local[starts].astype(np.int64) + base
                uses = np.diff(np.append(starts, len(goal))).astype(np.float32)
                slope = _row_sums(gradient, order, starts)
                self.square[rows] += np.einsum("ij,ij->i", slope, slope)
                self.uses[rows] += uses
                slope *= (RATE / np.sqrt(self.square[rows] + 1))[:, None]
                self.weights[rows] -= slope
                base += buckets


_MOVED = "part long, range int, rows binary, uses binary, weights binary"


def _blocks(part: int, number: int, rows: np.ndarray, uses: np.ndarray, weights: np.ndarray, size: int) -> pa.RecordBatch:
    """Weights of table ``number`` (of ``size`` rows) by ranges of rows, as half floats; ranges count on from table to table."""
    at = np.searchsorted(rows, np.linspace(0, size, RANGES + 1)[1:-1])
    cut = lambda x, kind: pa.array([p.astype(kind).tobytes() for p in np.split(x, at)], pa.binary())
    ranges = pa.array(np.arange(RANGES, dtype=np.int32) + number * RANGES)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(RANGES, part)), ranges, cut(rows, np.int32), cut(uses, np.float32), cut(weights, np.float16)],
        ["part", "range", "rows", "uses", "weights"],
    )


def _learn(model, classes) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed: Classes = classes.value
        learners, prior, sub_prior = None, fixed.prior.astype(np.float32), fixed.sub_prior
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = _Tokens(batch, i, fixed)
                used = tokens.learned[tokens.doc]
                if used.any():
                    if learners is None:
                        learners = [_Learner(w, b) for w, b in zip(model.value, (BUCKETS, (fixed.buckets,) * len(BACK)), strict=True)]
                    # a word met once stands for words never met
                    known = (tokens.count > 1) | (tokens.kind < len(fixed.own))
                    learners[0].learn(tokens.features[used], np.where(known, tokens.kind, fixed.unknown)[used], prior)
                    inner = (used & known)[tokens.inner]
                    learners[1].learn(tokens.inner_features[inner], tokens.sub[inner], sub_prior[tokens.shape[inner]])
        for number, learner in enumerate(learners or []):
            rows = np.flatnonzero(learner.uses)
            yield _blocks(TaskContext.get().partitionId(), number, rows, learner.uses[rows], learner.weights[rows], len(learner.uses))

    return run


def _average(shapes: tuple[tuple[int, int], ...]):
    """Weights of several tasks for one range of rows, averaged by how often each task used a row."""

    def run(table: pa.Table) -> pa.Table:
        part, number = table.column("part")[0].as_py(), table.column("range")[0].as_py()
        size, width = shapes[number // RANGES]
        total, uses = np.zeros((size, width), np.float32), np.zeros(size, np.float32)
        for r, u, w in zip(*(table.column(n).to_pylist() for n in ("rows", "uses", "weights")), strict=True):
            rows, n = np.frombuffer(r, np.int32), np.frombuffer(u, np.float32)
            total[rows] += n[:, None] * np.frombuffer(w, np.float16).reshape(-1, width)
            uses[rows] += n
        rows = np.flatnonzero(uses)
        columns = {"rows": rows.astype(np.int32), "uses": uses[rows], "weights": (total[rows] / uses[rows][:, None]).astype(np.float16)}
        return pa.table(
            {"part": pa.array([part]), "range": pa.array([number], pa.int32()), **{n: pa.array([x.tobytes()], pa.binary()) for n, x in columns.items()}}
        )

    return run


def learn(coded: DataFrame, classes: Classes, passes: int = 1) -> list[np.ndarray]:
    """Weights of both softmaxes from all learned tokens of ``coded``: in each pass every task starts from the common
    weights, moves them along the gradients of its own tokens, and the tasks' weights are averaged, FAN_IN at a time."""
    context, shapes = coded.sparkSession.sparkContext, classes.shapes
    weights = [np.zeros(shape, np.float32) for shape in shapes]
    fixed = context.broadcast(classes)
    coded = coded.coalesce(max(2 * context.defaultParallelism, -(-coded.count() // TASK_CHUNKS)))
    for _ in range(passes):
        moved = coded.mapInArrow(_learn(context.broadcast(weights), fixed), _MOVED)
        while True:
            groups = moved.withColumn("part", F.floor(F.col("part") / FAN_IN))
            moved = shared_table(groups.groupBy("part", "range").applyInArrow(_average(shapes), _MOVED), "weights", "zstd")
            if (moved.agg(F.max("part")).first()[0] or 0) == 0:
                break
        weights = [w.copy() for w in weights]
        for r in moved.toLocalIterator():  # RANGES rows for each table, whose size is bounded
            table = weights[r["range"] // RANGES]
            table[np.frombuffer(r["rows"], np.int32)] = np.frombuffer(r["weights"], np.float16).reshape(-1, table.shape[1])
    return weights


def _score(model, classes) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed: Classes = classes.value
        prior, sub_prior, floor = fixed.prior.astype(np.float32), fixed.sub_prior, fixed.tokens + 0.5 * (fixed.types + 1)
        top, inner = model.value
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = _Tokens(batch, i, fixed)
                own = np.zeros(len(tokens.kind))
                own[tokens.inner] = fixed.within(tokens.count[tokens.inner], tokens.shape, tokens.sub)
                for k in range(0, len(tokens.inner), STEP):
                    at = slice(k, k + STEP)
                    own[tokens.inner[at]] += _log_probability(inner, sub_prior[tokens.shape[at]], tokens.inner_features[at], tokens.sub[at])
                for k in range(0, len(own), STEP):
                    own[k : k + STEP] += _log_probability(top, prior, tokens.features[k : k + STEP], tokens.kind[k : k + STEP])
                sums = lambda x: np.bincount(tokens.doc, x, minlength=len(tokens.n))
                yield pa.RecordBatch.from_arrays(
                    [
                        tokens.ids,
                        pa.array(tokens.learned),
                        pa.array(tokens.n),
                        pa.array(sums(tokens.count > 0).astype(np.int64)),
                        pa.array(sums(np.log10((tokens.count + 0.5) / floor))),
                        pa.array(sums(own / np.log(10))),
                    ],
                    ["doc_id", "learned", "n_tokens", "n_known", "base_score", "score"],
                )

    return run


def language_scores(documents: DataFrame, passes: int = 1) -> DataFrame:
    """doc_id, learned, n_tokens, n_known, train_tokens, base_score and score of each document.

    Tokens are the words of the text, A-Z folded, and one end. Counts and model
    come from all documents that are learned from (:func:`learns`), every token
    of them. base_score is the log10 probability under smoothed token
    frequencies, score that under the model; n_known counts tokens that are in
    the learned texts, train_tokens all tokens of these.

    Words are told apart by 64-bit hashes. Null or empty text: the end token
    alone. Null doc_id: scored, not learned from. Repeated rows: each is learned
    and scored. No learned texts: every word is unknown. Empty table: empty
    result. Other columns are left out.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("__text"), learns().alias("__learned"))
    chunks = pack(rows, "__text")
    shards = shard_count(chunks)
    sent = chunks.mapInArrow(_send_counts(shards), "chunk long, shard long, keys binary, count binary, shape binary")
    found = shared_table(answered(sent, _total, {"count": np.int64, "shape": np.uint8}, _summary), "word_counts", "zstd")
    classes = _classes(found)
    context = documents.sparkSession.sparkContext
    fixed = context.broadcast(classes)
    told = chunks.join(by_chunk(found), "chunk", "left")
    coded = shared_table(told.mapInArrow(_code(fixed), _CODED), "coded", "zstd")
    drop_table(chunks, found)
    model = context.broadcast(learn(coded, classes, passes))
    out = coded.mapInArrow(_score(model, fixed), "doc_id long, learned boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(classes.tokens).cast("long"))

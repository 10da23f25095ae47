"""Quality of documents: a regularised quadratic discriminant on statistics of the text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconflow.llm.words import small_batches, space_words
from beaconflow.session import shared_table

#: Transformed statistics of a text, in this order.
STATISTICS = (
    "log_words word_length length_spread distinct_share repeated_share top_share short_share capital_share "
    "digit_share symbol_share bar_share mark_share wide_share log_line_words shout_share"
).split()

#: How far a class covariance is drawn to the pooled one, and that to a multiple of the unit matrix.
TO_POOLED, TO_ROUND = 0.2, 0.05
#: Smallest probability of a score; a discriminant is too sure far from both classes.
FLOOR = 1e-4
#: Cases that a share counts as at most: a share in a long text is not surer than one of so many words. All words are counted.
EVIDENCE = 400

_UPPER, _LOWER, _DIGIT = (np.isin(np.arange(256), list(x)) for x in (range(65, 91), range(97, 123), range(48, 58)))
_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _BLANK | (np.arange(256) >= 128) | np.isin(np.arange(256), list(b".,;:'\"()-!?")))


def _logit(share: float, n: int) -> float:
    """A share as log-odds, drawn to the middle as much as few cases (n) ask for."""
    hit = share * n
    return float(np.log((hit + 0.5) / (n - hit + 0.5)))


def statistics(text: bytes | None) -> list[float]:
    """The STATISTICS of one text: shares as log-odds, sizes as logarithms. Empty and null texts have those of no words."""
    text = text or b""
    words = space_words(text)
    n = len(words)
    letters = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    ink = int(letters[~_BLANK].sum())
    length = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    share = lambda hit, of: _logit(hit / of if of else 0.0, min(of, EVIDENCE))
    capital, letter = int(letters[_UPPER].sum()), int(letters[_UPPER | _LOWER].sum())
    repeated = sum(map(eq, words, words[1:]))
    lines = 1 + int(letters[10])
    return [
        np.log1p(n),
        np.log1p(length.mean()) if n else 0.0,
        np.log1p(length.std()) if n else 0.0,
        # the share of distinct words falls with length even in good prose
        np.log((len(counts) + 0.5) / (n + 0.5) ** 0.9),
        share(repeated, max(0, n - 1)),
        share(max(counts.values(), default=0), n),
        share(int((length <= 3).sum()), n),
        share(capital, letter),
        share(int(letters[_DIGIT].sum()), ink),
        share(int(letters[_SYMBOL].sum()), ink),
        share(int(letters[124]), ink),
        share(int(letters[33]), ink),
        share(int(letters[128:].sum()), ink),
        np.log1p(n / lines),
        share(counts.get(b"!!", 0) + sum(w.endswith(b"!!") for w in counts), len(counts)),
    ]


def _measure(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "__text", 1 << 20):
            rows = [statistics(t) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], [*names, "x"])

    return run


def measure(documents: DataFrame) -> DataFrame:
    """The columns of ``documents`` but text, and the statistics of the text as an array x."""
    names = [c for c in documents.columns if c not in ("text", "x")]
    rows = documents.select(*names, F.col("text").cast("binary").alias("__text"))
    kept = documents.select(*names).schema
    return rows.mapInArrow(_measure(names), ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields), "x array<double>"]))


class Discriminant:
    """Class means, Cholesky factors of the shrunk covariances and log-priors."""

    def __init__(self, counts: np.ndarray, sums: np.ndarray, squares: np.ndarray):
        """From the number, sum and sum of outer products of the vectors of classes 0 and 1."""
        size = sums.shape[1]
        self.known = bool((counts > 0).all())
        self.prior = float(np.log((counts[1] + 0.5) / (counts[0] + 0.5)))
        n = np.maximum(counts, 1)
        self.mean = sums / n[:, None]
        own = squares - n[:, None, None] * self.mean[:, :, None] * self.mean[:, None, :]
        pooled = own.sum(axis=0) / max(counts.sum(), 1)
        scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        # the unit matrix stands for standardised statistics
        pooled = (1 - TO_ROUND) * pooled + TO_ROUND * np.diag(scale**2)
        weight = TO_POOLED + (1 - TO_POOLED) * size / (size + n)
        self.factor = [np.linalg.cholesky((1 - w) * own[k] / n[k] + w * pooled + 1e-9 * np.eye(size)) for k, w in enumerate(weight)]
        self.log_det = [2 * np.log(np.diag(f)).sum() for f in self.factor]
        # inverted once, so that a batch costs one product
        self.whiten = [np.linalg.inv(f) for f in self.factor]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row, from the difference of the two log-densities."""
        if not self.known or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.prior)))
        log_density = []
        for mean, whiten, log_det in zip(self.mean, self.whiten, self.log_det, strict=True):
            z = whiten @ (x - mean).T
            log_density.append(-0.5 * ((z * z).sum(axis=0) + log_det))
        difference = np.clip(log_density[1] - log_density[0] + self.prior, -40, 40)
        return np.clip(1 / (1 + np.exp(-difference)), FLOOR, 1 - FLOOR)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class and task: count, sum and outer products (upper and lower) of the vectors."""
    size = len(STATISTICS)
    total = np.zeros((2, 1 + size + size * size))
    for batch in batches:
        if batch.num_rows:
            x = batch.column("x").flatten().to_numpy().reshape(-1, size)
            label = batch.column("label").to_numpy()
            for k in (0, 1):
                own = x[label == k]
                total[k] += np.r_[len(own), own.sum(axis=0), (own.T @ own).ravel()]
    place = np.tile(np.arange(total.shape[1], dtype=np.int32), 2)
    label = np.repeat(np.array([0, 1], np.int32), total.shape[1])
    yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(place), pa.array(total.ravel())], ["label", "place", "value"])


def train(measured: DataFrame, labels: DataFrame) -> Discriminant:
    """Fitted on all of ``labels`` (doc_id, quality) whose documents are in ``measured`` (doc_id, x).

    The tasks add up moments, so what reaches the driver has a fixed size
    however many labels there are. Labels other than 0 and 1 and null ids are
    left out; without rows of both classes every score is the prior.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("label"))
    rows = measured.join(known, measured["doc_id"].cast("long") == known["__id"]).select("label", "x")
    sums = rows.mapInArrow(_moments, "label int, place int, value double").groupBy("label", "place").agg(F.sum("value").alias("value"))
    size = len(STATISTICS)
    total = np.zeros((2, 1 + size + size * size))
    for r in sums.collect():
        total[r["label"], r["place"]] = r["value"]
    return Discriminant(total[:, 0], total[:, 1 : 1 + size], total[:, 1 + size :].reshape(2, size, size))


def score(measured: DataFrame, model: Discriminant) -> DataFrame:
    """``measured`` with the probability of label 1 in place of x."""
    shared = measured.sparkSession.sparkContext.broadcast(model)
    names = [c for c in measured.columns if c not in ("x", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(shared.value.scores(x))], [*names, "score"])

    rows = measured.select(*names, "x")
    kept = measured.select(*names).schema
    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields), "score double"]))


def held_out(doc_id: str = "doc_id"):
    """Whether a document's label stays unseen: crc32 of its id as text is 0 modulo 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.3 on) of each document.

    Every text is read once and whole. Null and empty texts are scored by the
    statistics of no words; a null id is not held out; repeated rows get the
    same score; an empty table gives an empty result.
    """
    measured = shared_table(measure(documents.select("doc_id", "text")), "statistics")
    model = train(measured, labels.where(~held_out()))
    return score(measured, model).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )

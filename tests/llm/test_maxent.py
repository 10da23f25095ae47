import math
import zlib
from collections import Counter

import numpy as np
import pytest

from beaconflow.llm import chunks, maxent
from beaconflow.llm.maxent import SHAPES, Classes, language_scores
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def tokens(text):
    return [*brute.SPACE.findall(brute.fold(text)), " "]


def base(rows):
    learned = [t for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 5 != 1]
    c = Counter(w for t in learned for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return {
        d: (len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)))
        for d, t in rows
    }


def check(df, rows):
    got, want = df.collect(), base(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9)
        assert r.score <= 1e-6 and math.isfinite(r.score)
        assert r.learned == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 != 1)
    return got


@pytest.mark.parametrize("chunk_bytes", [4 << 20, 200_000])
def test_counts_match_brute_force_and_the_model_beats_them(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", chunk_bytes)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = check(language_scores(docs), rows)
    held = [r for r in got if not r.learned]
    assert len(held) > 100
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.93
    assert np.mean([r.score > r.base_score for r in held]) > 0.9


def test_probabilities_sum_to_one():
    """Over all known words and the unknown one, in any context, word by word."""
    rng = np.random.default_rng(1)
    own = np.sort(rng.integers(0, 2**63, 3).astype(np.uint64))
    counts, shapes = rng.integers(1, 50, 900), rng.integers(0, SHAPES, 900)
    keys = rng.integers(0, 2**63, 900).astype(np.uint64)
    subs = maxent.subs_of(keys)
    size = np.zeros((SHAPES, maxent.SUBS))
    np.add.at(size, (shapes, subs), counts + 0.5)
    prior = rng.normal(size=3 + SHAPES + 1)
    classes = Classes(own, size, prior, int(counts.sum()), 903)
    top, inner = (rng.normal(size=shape).astype(np.float32) for shape in classes.shapes)
    kind = classes.of(keys, shapes)
    for _ in range(5):
        features = np.tile(rng.integers(0, len(top), 3), (len(prior), 1))
        of_class = maxent._log_probability(top, prior.astype(np.float32), features, np.arange(len(prior)))
        total = np.exp(of_class[:3]).sum() + np.exp(of_class[classes.unknown])
        rows = rng.integers(0, len(inner), (SHAPES, 2))  # a context has its own rows with each class
        for w in range(len(keys)):
            sub = maxent._log_probability(inner, classes.sub_prior[shapes[w : w + 1]], rows[shapes[w : w + 1]], subs[w : w + 1])
            within = classes.within(counts[w : w + 1], shapes[w : w + 1], subs[w : w + 1])
            total += np.exp(of_class[kind[w]] + sub[0] + within[0])
        # subclasses without words hold next to nothing of their classes
        assert total == pytest.approx(1, abs=1e-3)


def test_steps_follow_the_gradient(monkeypatch):
    """What the word before says about the next class is learned."""
    monkeypatch.setattr(maxent, "STEP", 256)
    rng = np.random.default_rng(2)
    before = rng.integers(0, 4, 40_000)
    target = np.where(rng.random(40_000) < 0.9, before, rng.integers(0, 4, 40_000))
    even = np.log(np.full(4, 0.25)).astype(np.float32)
    learner = maxent._Learner(np.zeros((sum(maxent.BUCKETS), 4), np.float32), maxent.BUCKETS)
    features = np.column_stack([before, maxent.BUCKETS[0] + before * 0, maxent.BUCKETS[0] + maxent.BUCKETS[1] + before * 0])
    learner.learn(features, target, np.tile(even, (len(target), 1)))
    log = maxent._log_probability(learner.weights, even, features[:4000], target[:4000])
    best = -(0.925 * np.log(0.925) + 0.075 * np.log(0.025))
    assert -log.mean() < best + 0.05


def test_weights_of_many_tasks_are_averaged(spark, monkeypatch):
    monkeypatch.setattr(maxent, "FAN_IN", 2)
    rows = [(i, "a b c d e. " * 5) for i in range(60)]
    check(language_scores(spark.createDataFrame(rows, SCHEMA).repartition(9)), rows)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 5000}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, "A a"), (4, long), (5, "é ÉÉ \x00"), (6, " \n"), (None, "a b")]
    check(language_scores(spark.createDataFrame(rows, SCHEMA)), rows)
    twice = spark.createDataFrame([(2, "a", 1, "x"), (2, "a", 1, "x")], SCHEMA + ", n_tokens int, score string")
    assert [(r.n_tokens, r.train_tokens) for r in language_scores(twice).collect()] == [(2, 4)] * 2
    nothing = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    assert [(r.n_known, r.train_tokens, r.base_score) for r in language_scores(spark.createDataFrame([(nothing, "a")], SCHEMA)).collect()] == [(0, 0, 0.0)]
    assert language_scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_word_before_tells_words_of_one_class_apart(spark):
    """No word has a class of its own; all that come second are of one shape and as frequent."""
    ids = iter(range(100_000))
    crc = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    learned, held = (lambda: next(i for i in ids if not crc(i))), (lambda: next(i for i in ids if crc(i)))
    rows = [(learned(), f"le{i} ri{i} {far} to{i}") for i in range(700) for far in ("xx", "yy", "zz") for _ in range(8)]
    apart = next(i for i in range(1, 700) if _sub(f"ri{i}") != _sub("ri0") and _sub(f"to{i}") != _sub("to0"))
    right, wrong, skip, other = [(held(), t) for t in ("le0 ri0", f"le0 ri{apart}", "ri0 aa to0", f"ri0 aa to{apart}")]
    score = {r.doc_id: r.score for r in check(language_scores(spark.createDataFrame([*rows, right, wrong, skip, other], SCHEMA)), [*rows, right, wrong, skip, other])}
    assert score[right[0]] > score[wrong[0]] + 0.15
    assert score[skip[0]] > score[other[0]] + 0.05


def _sub(word):
    return maxent.subs_of(maxent.WordHashes().of([word.encode()]))[0]


def test_sums_of_rows():
    rng = np.random.default_rng(3)
    gradient, rows = rng.normal(size=(3000, 5)).astype(np.float32), (900 * rng.random(3000) ** 4).astype(int)
    order = np.argsort(rows, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(rows[order]) > 0])
    want = np.array([gradient[rows == r].sum(axis=0) for r in np.unique(rows)])
    assert np.allclose(maxent._row_sums(gradient, order, starts), want, atol=1e-3)


def test_the_table_of_subclasses_follows_the_training_tokens():
    rows = [Classes(np.empty(0, np.uint64), np.ones((SHAPES, maxent.SUBS)), np.zeros(SHAPES + 1), n, 9).shapes[1][0] for n in (10, 10**5, 10**6, 10**12)]
    assert rows[0] == 2 * maxent.LEAST_BUCKETS < rows[1] < rows[2] < rows[3] == 2 * maxent.MOST_BUCKETS


def test_scores_against_a_walk_word_by_word(spark, monkeypatch):
    """With weights that only depend on the row, each token's probability is worked out again from its row numbers."""
    rows = [(i, t) for i, t in enumerate(["b c b. d", "b b c", "c d. e", "", "x b c b. d", "d. d. b"] * 3)]
    kept = []
    real = maxent._classes
    monkeypatch.setattr(maxent, "_classes", lambda found: kept.append(real(found)) or kept[-1])

    def fixed(coded, classes, passes):
        rng = np.random.default_rng(0)
        return [rng.normal(size=shape).astype(np.float32) for shape in classes.shapes]

    monkeypatch.setattr(maxent, "learn", fixed)
    got = {r.doc_id: r.score for r in language_scores(spark.createDataFrame(rows, SCHEMA)).collect()}
    classes = kept[0]
    top, inner = fixed(None, classes, 1)
    learned = Counter(w for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1 for w in tokens(t))
    hashes, many = maxent.WordHashes(), len(classes.prior) + 1

    def kind(w):
        k = hashes.of([w.encode()])
        return int(classes.of(k, maxent.shapes_of([w.encode()]))[0]) if learned[w] else classes.unknown

    def softmax(logits, target):
        return logits[target] - math.log(sum(math.exp(x) for x in logits))

    def mixed(x):
        return int(maxent._mixed(np.array([x % 2**64], np.uint64))[0])

    for d, t in rows:
        total, line = 0.0, tokens(t)
        for i, w in enumerate(line):
            before = [line[i - k] if i >= k else None for k in (1, 2, 3)]
            seen = [many - 1 if b is None else classes.unknown if learned[b] <= 1 else kind(b) for b in before]
            key = [None if b is None else 1 if learned[b] <= 1 else int(hashes.of([b.encode()])[0]) for b in before]
            bucket = 1 if before[0] is None else 0 if learned[before[0]] <= 1 else (key[0] >> 20) % maxent.BUCKETS[0]
            spread = [x * 2654435761 >> 5 if many * many > n else x for x, n in ((seen[0] * many + seen[1], maxent.BUCKETS[1]), (seen[1] * many + seen[2], maxent.BUCKETS[2]))]
            feature = [bucket, maxent.BUCKETS[0] + spread[0] % maxent.BUCKETS[1], maxent.BUCKETS[0] + maxent.BUCKETS[1] + spread[1] % maxent.BUCKETS[2]]
            c = kind(w)
            total += softmax([float(p + sum(top[f, j] for f in feature)) for j, p in enumerate(classes.prior)], c)
            if learned[w] and c >= len(classes.own):
                s, sub = c - len(classes.own), int(_sub(w))
                salt = c * 0x9E3779B97F4A7C15
                at = [mixed(mixed((key[k - 1] or 0) + k) + salt) % classes.buckets + n * classes.buckets for n, k in enumerate(maxent.BACK)]
                total += softmax([float(p + sum(inner[r, j] for r in at)) for j, p in enumerate(classes.sub_prior[s])], sub)
                total += math.log(learned[w] + 0.5) - math.log(classes.cell_size[s, sub])
        assert got[d] == pytest.approx(total / math.log(10), abs=1e-3)

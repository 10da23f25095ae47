import random

import pytest

from beaconflow.llm import chunks, phrases
from beaconflow.llm.phrases import drop_repeated_passages, remove_repeated_words
from pyspark.sql import functions as F
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def judged(df):
    out = df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha")).collect()
    return {r.doc_id: (r.n_words, r.n_removed, r.sha) for r in out}


@pytest.mark.parametrize("chunk_bytes", [4 << 20, 100_000])
def test_matches_brute_force_on_the_whole_table(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", chunk_bytes)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = remove_repeated_words(docs)
    assert set(docs.columns) <= set(out.columns)
    assert judged(out) == brute.repeated_words(rows)


def test_few_words_repeat_often(spark, monkeypatch):
    """A tiny vocabulary, so phrases repeat by chance and passages overlap in all ways."""
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 500)
    rng = random.Random(5)
    base = [rng.choice("ab") for _ in range(60)]
    rows = []
    for doc in rng.sample(range(1000), 80):
        words = []
        while len(words) < 30:
            i = rng.randrange(40)
            words += base[i : i + rng.randrange(5, 20)] if rng.random() < 0.7 else [rng.choice("abcdé,")]
        rows.append((doc, rng.choice([" ", "\n", " \t "]).join(words)))
    want = brute.repeated_words(rows)
    assert sum(w[1] for w in want.values()) > 300
    assert judged(remove_repeated_words(spark.createDataFrame(rows, SCHEMA).repartition(5))) == want


def test_edge_cases(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    long = " ".join(f"v{i}" for i in range(200_000))
    rows = [(5, passage), (3, passage), (9, "a " + passage + " b"), (1, None), (2, ""), (4, " \n "), (7, "x " * 12), (8, "x " * 12)]
    rows += [(10, "y " * 30), (11, "y " * 13), (20, long), (21, long + " end"), (22, "nul\x00 " * 15), (23, "nul\x00 " * 15)]
    assert judged(remove_repeated_words(spark.createDataFrame(rows, SCHEMA))) == brute.repeated_words(rows)
    odd = spark.createDataFrame([(None, passage, "x", 1), (3, passage, "y", 2), (3, passage, "y", 2)], SCHEMA + ", kept string, n_words int")
    out = remove_repeated_words(odd)
    assert [r.n_removed for r in out.collect()] == [0, 0, 0] and out.columns == ["doc_id", "text", "n_words", "n_removed", "kept"]
    assert remove_repeated_words(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        remove_repeated_words(odd, window=3)


def test_only_documents_that_lose_words_change(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(1, "keep  this\nlayout", 17), (2, passage, 99), (3, "a\n" + passage + "\nb", 99)]
    out = drop_repeated_passages(spark.createDataFrame(rows, SCHEMA + ", n_chars long"))
    assert sorted(map(tuple, out.collect())) == [(1, "keep  this\nlayout", 17), (2, passage, 99), (3, "a b", 3)]


def test_the_automaton_finds_every_occurrence():
    cache = phrases.WordHashes()
    import pyarrow as pa

    text = [b"a b c d e f a b c d e", b"x a b c d e", b"a b c d", None]
    docs = pa.StructArray.from_arrays([pa.array([1, 2, 3, 4])], ["doc_id"])
    words = phrases._Words(docs, text, cache, 5)
    import numpy as np

    wanted = np.unique(words.phrase_hashes()[[0]])
    assert phrases._occurrences(words, phrases._automaton(words, wanted)).tolist() == [0, 6, 12]

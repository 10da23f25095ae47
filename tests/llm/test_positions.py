import random

import corpus_pipeline
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from beaconflow.llm import positions
from beaconflow.llm.positions import build_index, contamination, drop_contaminated, find_near, find_phrases
from tests.llm import brute

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def judged(df):
    rows = df.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("sha"), "contaminated")
    return {r.doc_id: tuple(r)[1:] for r in rows.collect()}


@pytest.mark.parametrize("query_words", [10**6, 500])
def test_matches_brute_force_on_the_whole_table(spark, monkeypatch, query_words):
    monkeypatch.setattr(positions, "QUERY_WORDS", query_words)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = brute.contamination(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert judged(contamination(docs, items)) == want
    assert any(w[4] for w in want.values())


def test_few_words_match_in_all_ways(spark, monkeypatch):
    monkeypatch.setattr(positions, "SEGMENT_BYTES", 300)
    rng = random.Random(2)
    text = lambda n: rng.choice([" ", "-", ". "]).join(rng.choice(["a", "b", "A", "É", "7"]) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(60)]
    items = [(i, text(rng.randrange(0, 4))) for i in range(8)] + [(i, docs[i][1][: rng.randrange(20, 60)]) for i in range(10, 30)]
    assert judged(contamination(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS))) == brute.contamination(docs, items)


def test_edge_cases(spark):
    long = " ".join(f"v{i}" for i in range(200_000))
    docs = [(1, None), (2, ""), (3, "...!"), (4, "Short item"), (5, "a short item, indeed"), (6, long), (7, long + " short item")]
    items = [(10, "short ITEM"), (2, "short item"), (3, None), (4, ""), (5, "v7 v8 v9 v10 v11 v12 v13 v14 v15 v16 v17 v18 v19 v20"), (10, "short item")]
    some, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert judged(contamination(some, bench)) == brute.contamination(docs, items)
    assert judged(contamination(some, spark.createDataFrame([], ITEMS))) == brute.contamination(docs, [])
    assert contamination(spark.createDataFrame([], DOCS), bench).collect() == []
    assert sorted(r.doc_id for r in drop_contaminated(some, bench).collect()) == [1, 2, 3, 6, 7]
    clash = spark.createDataFrame([(None, "short item", 5, "x"), (1, "short item", 6, "y"), (1, "short item", 6, "y")], DOCS + ", n_hit int, items string")
    assert [(r.doc_id, r.n_hit, r["items"]) for r in contamination(clash, bench).sort("doc_id").collect()] == [(d, 2, ["10", "2"]) for d in (None, 1, 1)]
    assert drop_contaminated(clash, bench).collect() == []
    unnamed = spark.createDataFrame([(None, "short item")], ITEMS)
    assert drop_contaminated(clash, unnamed).count() == 3


def test_phrase_and_proximity_search(spark):
    docs = [(1, "the quick brown fox jumps over the lazy dog"), (2, "a dog, a fox and then much later nothing"), (3, "fox"), (4, "dog")]
    index = build_index(spark.createDataFrame(docs, DOCS).coalesce(1))
    found = lambda df: {r.doc.doc_id: ([tuple(s) for s in r.spans], r["items"]) for r in df.collect() if r.spans}
    items = spark.createDataFrame([(1, "the lazy dog"), (2, "quick fox")], ITEMS)
    assert found(find_phrases(index, items)) == {1: ([(6, 9)], ["1"])}
    assert found(find_near(index, spark.createDataFrame([(7, "fox dog")], ITEMS), within=5)) == {1: ([(3, 4)], ["7"]), 2: ([(3, 4)], ["7"])}
    assert found(find_near(index, spark.createDataFrame([(7, "fox dog")], ITEMS), within=2)) == {2: ([(3, 4)], ["7"])}


@pytest.mark.parametrize(("segment", "batch"), [(20_000, 1 << 20), (1 << 20, 20_000)])
def test_what_a_task_holds_does_not_grow_with_its_input(spark, monkeypatch, segment, batch):
    for name, value in (("SEGMENT_BYTES", segment), ("GROUP_BYTES", 40_000), ("BATCH_BYTES", batch)):
        monkeypatch.setattr(positions, name, value, raising=False)
    rng = random.Random(3)
    docs = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(1000))) for i in range(80)]
    index = build_index(spark.createDataFrame(docs, DOCS).coalesce(1))
    groups = [m.row_group(g).num_rows for f in index.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for g in range(m.num_row_groups)]
    assert sum(groups) >= 20  # segments
    assert max(groups) <= 3
    found = find_phrases(index, spark.createDataFrame([(1, docs[7][1])], ITEMS))
    assert {r.doc.doc_id: len(r.spans) for r in found.collect() if r.spans} == {7: 988}


def test_the_stage_of_the_pipeline_has_a_bounded_index(spark, monkeypatch, tmp_path):
    built = []
    monkeypatch.setattr(positions, "build_index", lambda docs: built.append(build_index(docs)) or built[0])
    for name, value in (("SEGMENT_BYTES", 2_000), ("GROUP_BYTES", 4_000)):
        monkeypatch.setattr(positions, name, value, raising=False)
    rng = random.Random(4)
    docs = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))) for i in range(90)]
    spark.createDataFrame([(1, docs[5][1]), (2, docs[70][1])], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)["decontamination"]
    kept = stage(spark, spark.createDataFrame(docs, DOCS).coalesce(1), str(tmp_path))
    assert sorted(map(tuple, kept.collect())) == [d for d in docs if d[0] not in (5, 70)]
    groups = [m.row_group(g).num_rows for f in built[0].inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for g in range(m.num_row_groups)]
    assert sum(groups) > 20
    assert max(groups) <= 4

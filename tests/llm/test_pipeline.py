import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from beaconflow.llm.toxicity import toxicity
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_run_is_the_chain_of_brute_force(spark):
    docs, labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    text = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity(docs, labels).where("predicted = 1").collect()}
    text = {d: t for d, t in text.items() if d not in toxic}
    groups = brute.near_duplicates(list(text.items()))
    text = {d: t for d, t in text.items() if groups[d][1] == d}
    rest = brute.rest_of_repeated(list(text.items()))
    text = {d: rest[d][2] if rest[d][1] else t for d, t in text.items()}
    found = brute.contamination(list(text.items()), items.select("item_id", "text").collect())
    text = {d: t for d, t in text.items() if not found[d][4]}
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    want = {}
    for d, t in text.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[d] = (len(ids), brute.digest(",".join(map(str, ids))), brute.digest(t), ids)
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.tokens) for r in out.collect()} == want
    assert 0 < len(want) < docs.count()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_take_any_table(spark, stage):
    """Nulls, empty and repeated rows, a long text, no rows, and columns named like those of the operators."""
    name, run = stage
    given = spark.read.parquet(f"{SF}/documents.parquet")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields)
    schema += ", kept string, score double, n_words int, items string, tokens string, text_hash int"
    long = " ".join(f"w{i % 7919}" for i in range(120_000))
    texts = [(1, None), (2, ""), (None, "a b"), (3, "plain words here"), (3, "plain words here"), (4, long), (5, " \n\t ")]
    rows = [(d, t, None, None, None, "k", 0.5, 3, "i", "t", 9) for d, t in texts]
    out = run(spark, spark.createDataFrame(rows, schema), SF)
    ids = sorted(str(r.doc_id) for r in out.select("doc_id").collect())
    assert set(ids) == {"1", "2", "3", "4", "5", "None"}
    assert len(ids) == (6 if name == "near_duplicates" else 7)
    assert run(spark, spark.createDataFrame([], schema), SF).count() == 0
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == [f.name for f in spark.createDataFrame([], schema).schema.fields]
        assert {(r.kept, r.score, r.n_words) for r in out.collect()} == {("k", 0.5, 3)}


def test_clean_documents_pass_unchanged(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, run in corpus_pipeline.STAGES[:-1]:
        if name != "repeated_passages":
            out = run(spark, docs, SF)
            assert out.exceptAll(docs).isEmpty() and out.count() > 0.5 * docs.count(), name
    both = corpus_pipeline.without_repeated_passages(spark, docs, SF).alias("o").join(docs.alias("d"), "doc_id")
    assert both.where(F.col("o.text") == F.col("d.text")).count() > 0.5 * docs.count()
    assert both.where("o.text <> d.text and o.n_chars <> length(o.text)").isEmpty()

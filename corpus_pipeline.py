"""From raw documents to training tokens: the stages of the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from beaconflow.llm.bpe import Vocabulary, token_digests
from beaconflow.llm.neardup import drop_near_duplicates
from beaconflow.llm.phrases import drop_repeated_passages
from beaconflow.llm.positions import drop_contaminated
from beaconflow.llm.toxicity import drop_toxic
from beaconflow.session import shared_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The tokenizer that the last stage encodes with.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, fitted on ``labels``, rejects go.

    Null and empty texts are scored as empty windows, long ones whole; repeated rows and ties are judged alike, null ids
    too. An empty table stays empty; columns of any names are kept.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of smallest id stays.

    Null and empty texts and null ids are in no group and stay; of rows that repeat a kept id and text one stays. Long texts
    are compared whole. An empty table stays empty; columns of any names are kept.
    """
    return drop_near_duplicates(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go from the later ones.

    Null and empty texts and such without a repeated passage stay as they are; no row goes. Long texts are read whole,
    repeated rows of one id count as one document. An empty table stays empty; columns of any names are kept.
    """
    return drop_repeated_passages(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of ``benchmark`` go.

    Null and empty texts have no words and stay; null ids are judged by their texts, repeated rows alike, long texts whole.
    An empty table stays empty; columns of any names are kept.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the tokens, their number, and digests of the ids and of the text decoded from them.

    Null and empty texts have no tokens; long ones are encoded whole, repeated rows and null ids each. An empty table gives
    an empty result; other columns are left out.
    """
    return token_digests(docs, Vocabulary(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each_group),
    ("repeated_passages", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("bpe", tokens),
]

#: SQL can express neither the network nor the tokenizer; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the ``documents`` of ``sf_dir``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs

"""The queries of this subpackage, each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconflow.llm import oracles
from beaconflow.llm.bpe import Vocabulary, token_digests
from beaconflow.llm.maxent import language_scores
from beaconflow.llm.neardup import near_duplicates
from beaconflow.llm.neighbours import every_nearest
from beaconflow.llm.phrases import remove_repeated_words
from beaconflow.llm.pigeonhole import near_vectors
from beaconflow.llm.positions import contamination
from beaconflow.llm.quality import quality
from beaconflow.llm.repair import damage, repair_conversations
from beaconflow.llm.sharding import balanced_shards
from beaconflow.llm.toxicity import toxicity
from beaconflow.llm.trie import prefix_trie, rebuilt, turn_sequences
from beaconflow.llm.urls import filter_urls

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_minhash_near_duplicates", oracles.NEAR_DUPLICATES)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op4_positional_decontamination", oracles.CONTAMINATION)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    names = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", names, "contaminated")


@query("op5_repeated_phrase_automata", oracles.REPEATED_WORDS)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_bpe_round_trip")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), Vocabulary(public_tokenizers.path("byte_bpe_50k.json")), lists=False)


@query("op6_gru_toxicity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_quadratic_quality")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_minimax_shards")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = balanced_shards(table(spark, sf_dir, "documents"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


#: The listed rules of the contract.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@query("op1_url_association_rules")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op9_balanced_posting_lists")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return every_nearest(table(spark, sf_dir, "embeddings"))


@query("op2_class_factored_maxent")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(~F.col("learned") & F.col("doc_id").isNotNull(), F.lit(False)).alias("held_out")
    found = language_scores(table(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op11_ternary_prefix_trie", oracles.PREFIX_TRIE)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(turn_sequences(table(spark, sf_dir, "conversations"))))


@query("op12_pigeonhole_vectors", oracles.NEAR_VECTORS)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), 0.93)


@query("op13_structure_repair", oracles.REPAIRED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair_conversations(damage(table(spark, sf_dir, "conversations")))
    turns = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return found.withColumn("repaired_sha256", F.sha2(F.array_join(turns, "\n"), 256)).drop("repaired")

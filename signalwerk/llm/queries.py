"""The registered queries of this folder: each operator over its whole table, and SQL where SQL has the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, importance, language, lines, minhash, packing, quality, repeats, sentencepiece, sstable, trie, vectors, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(quality.ledger(table(spark, sf_dir, "documents")))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the latest policy does, from the failure bits of all documents."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents")))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encoded(table(spark, sf_dir, "documents"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    return chat.formatted(said.unionByName(more))


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.token_shards(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_line_dedup, op2_language_id, op3_quality_rules, op4_sentencepiece, op5_embedding_near_dedup, op6_warc, op7_minhash_near_dedup, op8_best_fit_packing, op9_chat_formatting, op10_token_shards, op11_prefix_trie, op12_importance_resampling, op13_suffix_dedup, quality_ablations)}

ORACLE_SQL: dict[str, str] = {"op1_line_dedup": lines.ORACLE, "op3_quality_rules": quality.ORACLE, "op11_prefix_trie": trie.ORACLE, "op12_importance_resampling": importance.ORACLE, "op13_suffix_dedup": repeats.ORACLE, "quality_ablations": quality.ABLATIONS_ORACLE}

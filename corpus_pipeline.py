"""From raw documents to packed sequences: quality rules, language, lines, near-duplicates, packing.

Every stage takes an empty table and gives one. Extra columns of any name pass through all but the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwerk.llm import language, lines, minhash, packing, quality
from signalwerk.scratch import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and policy v1. Null and empty texts have too few words and go; repeated rows are judged alike; texts are measured whole."""
    return quality.filtered(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told and not rejected. Their `lang` stays as it came. Texts that are null or without letters go, and all where no document has a language."""
    return language.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sources share but for their first place; n_chars is counted anew. Null text stays null; a null source is one source; of equal places the smaller doc_id, then text hash, then line is first."""
    cleaned = lines.deduplicated(docs)
    anew = {"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {}
    return cleaned.withColumns(anew).select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the smallest doc_id, null last, then text hash. Texts without words, null among them, are one class."""
    return minhash.distinct_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of at most 2048 tokens. Null text is one piece with the end id; repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("language_id", language_id), ("line_dedup", line_dedup), ("minhash_near_dedup", near_dedup), ("best_fit_packing", pack)]

ORACLE_SQL = None  # models, samples and bin completion have no SQL form; tests compare with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is a table in the scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing to target weights, SentencePiece encoding.

Every stage works on all rows that the stage before it kept.  All but the last
return the columns of documents.  The mix may hold a document twice (once for
each pass over its source), so ids repeat in the last two stages' results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import exact, minhash, mixing, pieces, quality
from kindred.llm.common import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("minhash near-dedup", near_dedup), ("mixing", mix_sources), ("sentencepiece", encode_pieces)]

#: SQL cannot express the mix's permutations nor the encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

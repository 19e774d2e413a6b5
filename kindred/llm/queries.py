"""The registered queries of this subpackage, and the SQL that DuckDB checks them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import exact, langid, linedup, minhash, mixing, pieces, quality, tokenbin, urlfilter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.report(_table(spark, sf_dir, "documents"), keep="max")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(_table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"))


def op8_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.report(_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.report(_table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_mixing, op2_url_filter, op3_sentencepiece, op4_exact_dedup, op5_warc, op6_language_id, op7_quality_rules, op8_token_binary, op9_line_dedup, op10_minhash)}

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": urlfilter.ORACLE_SQL,
    "op4_exact_dedup": exact.ORACLE_SQL,
    "op5_warc": warc.ORACLE_SQL,
    "op7_quality_rules": quality.ORACLE_SQL,
    "op9_line_dedup": linedup.ORACLE_SQL,
    "op10_minhash": minhash.ORACLE_SQL,
}

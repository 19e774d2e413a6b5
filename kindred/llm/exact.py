"""Exact dedup: group by a 128-bit content hash, keep one stable id, compare bytes inside groups.

Only (hash, id) pairs shuffle for the grouping.  Texts move only where a hash
occurs twice, through an aggregate keyed on (hash, text): it compares the bytes
and folds copies before they shuffle, so a hot group of copies costs one row a
task.  Hashes that turn out to hold different texts are split by their text.

Defined results.  Null text counts as the empty text, so null and empty texts
are one group.  Null ids sort below all others.  Of rows that repeat the
surviving id with the same text, one stays.  An empty table gives no rows.
Further columns, whatever their names, pass through `deduplicate` untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import materialize, sized_join, text_of


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def annotate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
             normalize: Callable[[Column], Column] | None = None, hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Rows of docs as struct `_row`, with _text, keep_id, group_size and kept.

    keep: "min" or "max" of the ids stays.  normalize: applied to texts before they are compared.
    """
    def value(c: Column) -> Column:
        return normalize(text_of(c)) if normalize else text_of(c)

    best = F.max if keep == "max" else F.min
    rows = docs.select(F.struct("*").alias("_row")).select("_row", F.col(f"_row.`{id_col}`").alias("_id"), value(F.col(f"_row.`{text_col}`")).alias("_text"))
    hashed = rows.withColumn("_h", hash_fn(F.col("_text")))

    def groups_of(df: DataFrame, *key: str) -> DataFrame:
        """n rows, the surviving id, and how many rows carry it, for each key that occurs twice."""
        by_id = df.groupBy(*key, "_id").agg(F.count("*").alias("c"))
        return by_id.groupBy(*key).agg(F.sum("c").alias("_n"), best("_id").alias("_keep"), best(F.struct("_id", "c"))["c"].alias("_copies")).where("_n > 1")

    groups = materialize(groups_of(hashed, "_h"), "dup-hashes")
    suspects = sized_join(hashed.select("_h", "_id", "_text"), groups.select("_h"), "_h", "left_semi")
    texts = suspects.groupBy("_h", "_text").agg(F.count("*").alias("n"))
    collided = materialize(texts.groupBy("_h").agg(F.count("*").alias("k")).where("k > 1").select("_h"), "collided")
    with_group = sized_join(hashed, groups, "_h", "left")
    if collided.head(1):
        hard = sized_join(hashed, collided, "_h", "left_semi")
        exact = materialize(groups_of(hard.select("_h", "_id", "_text"), "_h", "_text"), "dup-texts")
        with_group = sized_join(with_group, collided, "_h", "left_anti").unionByName(hard.join(exact, ["_h", "_text"], "left"))
        copies = max(groups.agg(F.max("_copies")).head()[0] or 1, exact.agg(F.max("_copies")).head()[0] or 1)
    else:
        copies = groups.agg(F.max("_copies")).head()[0] or 1
    out = with_group.select("_row", "_id", "_text", F.coalesce("_n", F.lit(1)).alias("group_size"), F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"), F.coalesce("_copies", F.lit(1)).alias("_copies"))
    out = out.withColumn("kept", F.col("_id").eqNullSafe(F.col("keep_id")))
    if copies > 1:  # rows that repeat the surviving id: one of them stays
        again = F.col("kept") & (F.col("_copies") > 1)
        order = Window.partitionBy("_id", F.sha2("_text", 256)).orderBy(F.to_json("_row"))
        one = out.where(again).withColumn("kept", F.row_number().over(order) == 1)
        out = out.where(~again).unionByName(one)
    return out.drop("_copies")


def deduplicate(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs that stay, with docs' own columns."""
    return annotate(docs, **how).where("kept").select("_row.*")


def report(docs: DataFrame, **how) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    return annotate(docs, **how).select(
        F.col("_id").alias("doc_id"), "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", F.sha2(F.col("_text"), 256).alias("text_sha256"))


#: Of equal texts the largest doc_id stays, as query op4 asks.  sha256 of DuckDB reads the UTF-8 bytes too.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""

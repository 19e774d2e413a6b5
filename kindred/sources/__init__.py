"""Readers of raw catalogue rows and the offers view over star-schema tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW = ("id", "prod_name", "brand", "category", "description", "specs", "img_links", "url", "created_at", "updated_at", "retailer", "price", "sku", "dimension")

#: One text for Spark and the oracle: every supplier-part pair of lineitem as an offer in raw rows; spelling varies by modulo, no row is left out.
OFFERS_SQL = """
SELECT cast(l_partkey * 100000 + l_suppkey AS varchar(20)) AS id,
  p_name || ' ' || p_type || ' ' || cast(p_size AS varchar(9)) || CASE WHEN l_suppkey % 4 = 0 THEN ' ml' ELSE 'ml' END || CASE WHEN l_suppkey % 7 = 0 THEN ' kit com 2 unidades' ELSE '' END AS prod_name,
  CASE WHEN l_suppkey % 11 = 0 THEN '' WHEN l_suppkey % 2 = 0 THEN upper(p_brand) ELSE p_brand END AS brand,
  'Casa > ' || p_type AS category, '' AS description,
  CASE WHEN l_suppkey % 3 = 0 THEN '{"EAN": "' || lpad(cast(l_partkey AS varchar(13)), 13, '0') || '"}' ELSE '{}' END AS specs,
  '' AS img_links, 'https://www.shop' || cast(l_suppkey % 5 AS varchar(2)) || '.test/produto/item-' || cast(l_partkey AS varchar(12)) || '/' AS url,
  '' AS created_at, '' AS updated_at, s_name AS retailer,
  cast(cast(round(p_retailprice * 100) AS bigint) + l_suppkey % 9 AS varchar(20)) AS price,
  CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE 'SKU' || cast(l_partkey AS varchar(12)) END AS sku,
  cast(p_size AS varchar(9)) || 'ml' AS dimension, l_partkey AS label
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) k
JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
"""


def read_csv(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Raw rows of a CSV file: every column a string, nulls empty, absent columns of the contract empty, cells beyond the header and a byte-order mark dropped."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"')
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    df = df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in RAW])
    return df if limit is None else df.limit(limit)


#: Keys of a task, at least and at most about.
FEW_KEYS, MANY_KEYS = 25_000, 250_000


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offers view: raw rows and a ground-truth label.

    Its keys are dealt by their number: they are small, and grouped by bytes
    a few tasks would get all the texts that are made of them.
    """
    for t in ("part", "supplier"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    keys = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", "l_suppkey")
    n = keys.count()
    tasks = min(n // FEW_KEYS + 1, max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // MANY_KEYS))
    keys.repartition(tasks, "l_partkey").createOrReplaceTempView("lineitem")
    return spark.sql(OFFERS_SQL)

"""The decision ladder over given inputs: columns of lineitem stand in for features and model scores, the same in both engines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators import decisions

#: Inputs by modulo of keys; they reach every branch of the ladder.
INPUTS = """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE l_partkey % 8 WHEN 0 THEN 'CERTAIN_MATCH' WHEN 1 THEN 'CERTAIN_BLOCK' WHEN 2 THEN 'STRONG_MATCH' WHEN 3 THEN 'STRONG_MATCH' WHEN 4 THEN 'LIKELY_MATCH' ELSE 'UNCERTAIN' END AS certainty,
  CASE WHEN l_partkey % 8 IN (2, 3) AND l_suppkey % 3 > 0 THEN 'same_retailer_sku' ELSE 'other' END AS reason,
  cast((l_orderkey * 7 + l_linenumber * 13) % 101 AS double) / 100 AS ml, cast(l_suppkey % 101 AS double) / 100 AS semantic_sim, cast(l_orderkey % 3 AS double) / 4 AS vector_sim,
  cast(CASE WHEN l_orderkey % 2 = 0 THEN 100 ELSE (l_orderkey + l_suppkey) % 101 END AS double) / 100 AS title_token_set, cast(CASE WHEN l_orderkey % 2 = 0 THEN 100 ELSE l_partkey % 101 END AS double) / 100 AS title_partial,
  cast(l_linenumber % 5 AS double) / 4 AS salient_token_jaccard, cast(l_linenumber % 2 AS double) AS exact_hit, cast(CASE WHEN l_linenumber % 2 = 1 THEN 88 ELSE 0 END AS double) / 100 AS exact_evidence_strength,
  cast(l_partkey % 101 AS double) / 100 AS lexical_sim, cast(l_suppkey % 11 AS double) / 10 AS trigram_sim, cast(l_linenumber % 2 AS double) AS identifier_any, cast(0 AS double) AS exact_global_id,
  cast(l_suppkey % 2 AS double) AS exact_retailer_sku, cast(0 AS double) AS exact_canonical_url, cast(l_orderkey % 2 AS double) AS brand_exact, cast(l_orderkey % 11 AS double) / 10 AS brand_fuzzy,
  cast(l_partkey % 2 AS double) AS size_match, cast(CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END AS double) AS size_conflict, cast(l_suppkey % 2 AS double) AS pack_match, cast(0 AS double) AS pack_conflict,
  cast(l_linenumber % 2 AS double) AS category_exact, cast(CASE WHEN l_partkey % 5 = 0 THEN 1 ELSE 0 END AS double) AS variant_conflict, cast(CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 0 END AS double) AS product_form_conflict,
  cast(l_orderkey % 4 AS double) AS contradiction_count, cast(1 AS double) AS exact_sku_same_retailer, cast(CASE WHEN l_orderkey % 19 = 0 THEN 1 ELSE 0 END AS double) AS variant_token_conflict
FROM lineitem
"""


def decision_policy(s: SparkSession, d: str) -> DataFrame:
    """Score, decision, reason, relation and retention of each input."""
    s.read.parquet(f"{d}/lineitem.parquet").createOrReplaceTempView("lineitem")
    df = s.sql(INPUTS)
    df = df.withColumns({c: F.lit(0.0) for c in decisions.HARD if c not in df.columns}).withColumn("model_score", F.col("ml"))
    df = decisions.verdict(df)
    kept = decisions.keeps()
    return df.select("l_orderkey", "l_linenumber", F.col("l_partkey"), F.round("ml_score", 6).alias("ml_score"), F.round("score", 6).alias("score"), "decision", "decision_reason", "relation", kept.alias("kept"))


ORACLE_SQL = f"""
WITH i AS ({INPUTS}),
h AS (SELECT *, size_conflict > 0 OR variant_token_conflict > 0 AS hard, greatest(title_token_set, title_partial, salient_token_jaccard) AS t, greatest(identifier_any, exact_retailer_sku) AS d, greatest(brand_exact, brand_fuzzy) AS b FROM i),
p AS (SELECT *, certainty = 'STRONG_MATCH' AND reason = 'same_retailer_sku' AND NOT hard AND (title_token_set >= 0.995 AND title_partial >= 0.995 OR title_token_set >= 0.985 AND title_partial >= 0.995 AND salient_token_jaccard >= 0.90) AS strong,
  certainty IN ('CERTAIN_MATCH', 'CERTAIN_BLOCK') AS settled FROM h),
m AS (SELECT *, CASE WHEN certainty = 'CERTAIN_MATCH' AND NOT hard THEN 1.0 WHEN settled THEN 0.0 ELSE ml END AS ml_score FROM p),
f AS (SELECT *, 0.28 * ml_score + 0.18 * greatest(exact_evidence_strength, exact_hit) + 0.17 * t + 0.11 * greatest(semantic_sim, vector_sim) + 0.10 * greatest(lexical_sim, trigram_sim) + 0.07 * d + 0.05 * b
  + 0.04 * greatest(size_match, pack_match, category_exact) + CASE WHEN certainty = 'STRONG_MATCH' THEN 0.04 ELSE 0 END AS f0 FROM m),
g AS (SELECT *, CASE WHEN strong THEN greatest(f0, least(0.88 + 0.05 * t + 0.03 * d + 0.02 * b, 0.985)) ELSE f0 END - CASE WHEN size_conflict > 0 THEN 0.18 ELSE 0 END - CASE WHEN variant_conflict > 0 THEN 0.12 ELSE 0 END
  - CASE WHEN product_form_conflict > 0 THEN 0.08 ELSE 0 END - CASE WHEN contradiction_count >= 2 THEN 0.08 ELSE 0 END AS f1 FROM f),
s AS (SELECT *, CASE WHEN settled THEN ml_score WHEN hard THEN least(ml_score, 0.49) ELSE greatest(0.0, least(1.0, f1)) END AS score FROM g),
r AS (SELECT *, CASE WHEN certainty = 'CERTAIN_MATCH' AND hard THEN 'hard_contradiction' WHEN certainty = 'CERTAIN_MATCH' THEN 'rule_certain_match' WHEN certainty = 'CERTAIN_BLOCK' THEN 'rule_certain_block'
  WHEN strong THEN 'strong_policy:same_retailer_sku_near_exact_title' WHEN hard THEN 'hard_contradiction' WHEN ml_score < 0.70 THEN 'below_near_miss_threshold' WHEN ml_score < 0.84 THEN 'below_merge_threshold'
  WHEN score < 0.78 THEN 'below_evidence_threshold' ELSE 'ml_score_above_threshold' END AS decision_reason FROM s),
z AS (SELECT *, CASE WHEN decision_reason IN ('rule_certain_match', 'ml_score_above_threshold') OR decision_reason LIKE 'strong_policy:%' THEN 'merge' ELSE 'no_merge' END AS decision FROM r)
SELECT l_orderkey, l_linenumber, l_partkey, round(ml_score, 6) AS ml_score, round(score, 6) AS score, decision, decision_reason,
  CASE decision_reason WHEN 'hard_contradiction' THEN 'same_parent_different_variant' WHEN 'rule_certain_match' THEN 'certain_match' WHEN 'rule_certain_block' THEN 'certain_block' WHEN 'below_near_miss_threshold' THEN 'no_match'
    WHEN 'below_merge_threshold' THEN 'similar_related_product' WHEN 'below_evidence_threshold' THEN 'similar_related_product' WHEN 'ml_score_above_threshold' THEN 'candidate_match' ELSE 'strong_exact_match' END AS relation,
  decision = 'merge' OR score >= 0.70 OR decision_reason = 'below_evidence_threshold' AND ml_score >= 0.84 AS kept FROM z
"""

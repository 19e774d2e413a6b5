"""A whole run: products, pairs, decisions, clusters and artifacts, each stage cached under a key of what it depends on."""

import json
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import functions
from kindred.caches import StageCache, code_hash, input_signature
from kindred.functions import json_text, rank, similarity
from kindred.operators import candidates, clusters, decisions, embeddings, features, products, reports, runs, training
from kindred.operators.storage import written
from kindred.sources import read_csv


@dataclass(frozen=True)
class Config:
    """Thresholds, fan-outs and caps of a run; caps leave out what lies behind them, as their caller asks, and None lifts them."""

    merge: float = 0.84
    evidence: float = 0.78
    near_miss: float = 0.70
    max_block: int | None = 500
    max_pairs: int | None = 500_000
    near_misses: int = 25_000
    fan_out: int = 25
    trigram_least: float = 0.55
    vectors: bool = True
    vector_least: float = 0.78
    model: str | None = None


def run(spark: SparkSession, rows: DataFrame | str, folder: str, config: Config = Config(), cache: StageCache | None = None) -> dict:
    """Dedupe raw rows (or a CSV file), write the run's artifacts into folder, and give back its summary."""
    began, seconds = time.time(), {}
    cache = cache or StageCache(spark, f"{folder.rstrip('/')}-stages")
    signature = input_signature(spark, rows) if isinstance(rows, str) else {"rows": repr(rows.schema), "run": folder}
    model = training.load(spark, config.model) if config.model else None

    def stage(name: str, make, parent: str, modules: tuple, **params) -> tuple[DataFrame, str]:
        at = time.time()
        out = cache.table(name, make, parent, code_hash(functions, json_text, rank, similarity, *modules), **params)
        seconds[name] = round(time.time() - at, 3)
        return out

    p, key = stage("normalization", lambda: products.products(read_csv(spark, rows) if isinstance(rows, str) else rows), "", (products,), **signature)

    def layer(name: str, make, parent: str, **params):
        return stage(f"retrieval-{name}", make, parent, (candidates, products), **params)

    exact, k1 = layer("exact", lambda: candidates.exact_pairs(p), key)
    lexical, k2 = layer("lexical", lambda: candidates.lexical_pairs(p, config.fan_out), key, k=config.fan_out)
    trigram, k3 = layer("trigram", lambda: candidates.trigram_pairs(p, config.fan_out, config.trigram_least, config.max_block), key, k=config.fan_out, least=config.trigram_least, block=config.max_block)
    layers, keys, vectors = [exact, candidates.evidence(lexical, "lexical:fts"), candidates.evidence(trigram, "trigram:title")], [k1, k2, k3], None
    if config.vectors:
        vectors, k4 = stage("embeddings", lambda: embeddings.embed(p), key, (embeddings, products))

        def near():
            profiles = candidates.retrieval_profiles(exact, lexical, trigram)
            gates = candidates.gated(p, profiles)
            pool = candidates.vector_pool(gates, lexical, trigram, profiles)
            return candidates.vector_pairs(vectors, config.fan_out, config.vector_least, gates.where("gate = 'anchor'").select(F.col("source_id").alias("vec_id")), pool)

        vector, k5 = layer("vector", near, json.dumps([*keys, k4]), k=config.fan_out, least=config.vector_least)
        layers.append(candidates.evidence(vector, "vector:cosine"))
        keys.append(k5)

    def judged():
        if config.max_pairs:
            pairs = candidates.pair_blocks(candidates.capped(layers, config.max_pairs))
        else:
            pairs = candidates.pair_blocks(*layers)
        pairs = embeddings.semantic_similarity(pairs, vectors) if vectors is not None else pairs
        df = written(features.pair_features(written(pairs), p, keep=True))
        df = training.apply(df, model) if model else df.withColumn("model_score", F.lit(0.0))
        least = max(config.merge, model["threshold"]) if model else config.merge
        return decisions.decide(df, least, config.evidence, config.near_miss)

    scored, key = stage("scoring", judged, json.dumps(keys), (features, decisions, training), spec=model, **asdict(config))
    kept = decisions.retained(scored, config.near_miss)
    order = F.when(F.contains("evidence", F.lit("exact:")), 0).when(F.contains("evidence", F.lit("lexical:")), 1).when(F.contains("evidence", F.lit("trigram:")), 2).otherwise(3)
    assigned, key = stage("clustering", lambda: clusters.guarded(p, kept.where("decision = 'merge'").select("i", "j", "score", order.alias("layer"), "explanation")), key, (clusters,))
    records, _ = stage("records", lambda: clusters.cluster_records(p, assigned), key, (clusters,))
    summary = reports.summary(p, kept, records, assigned, scored.count())
    runs.write(folder, p, decisions.candidate_records(kept), runs.assignments(p, records), runs.near_misses(p, kept, config.near_misses), records, summary)
    return {r["name"]: r["value"] for r in summary.collect()} | {"seconds": seconds, "elapsed_seconds": round(time.time() - began, 3), "caches": cache.status()}

"""Vectors of products: a pluggable embedder, a table of vectors keyed by text, similarity of pairs.

The default embedder hashes a text's character trigrams into signed counts and
needs no model; any function from texts to vectors of one length serves as
another.  Vectors are kept by (source_id, text hash, provider, dims), so a
product whose text changed is embedded anew, and nothing else is.

Defined results.  Null and empty texts give vectors of zeros, which have a
similarity of 0 with everything.  Missing vectors, and those of unlike length,
too.  Broken texts of vectors give empty ones.
"""

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred import functions as K
from kindred.operators.products import embedding_text

DIMS = 256
SCHEMA = "vec_id string, text_hash string, provider string, dims int, embedding array<float>"


def hashed_trigrams(texts: list[str], dims: int = DIMS) -> np.ndarray:
    """A unit vector of each text: trigrams of its lower-case characters, a hash telling place and sign."""
    out = np.zeros((len(texts), dims), np.float32)
    for k, text in enumerate(texts):
        low = f"  {text.lower()} ".encode() if text else b""
        for i in range(len(low) - 2):
            h = zlib.crc32(low[i : i + 3])
            out[k, h % dims] += 1 if h >> 31 else -1
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm == 0, 1, norm)


def embed(p: DataFrame, known: DataFrame | None = None, embedder: Callable[[list[str], int], np.ndarray] = hashed_trigrams, provider: str = "hashed-trigrams", dims: int = DIMS, batch: int = 128) -> DataFrame:
    """The vectors of products, those of `known` reused where id, text, provider and length agree."""
    texts = p.select(F.col("source_id").alias("vec_id"), embedding_text().alias("text")).dropDuplicates(["vec_id"]).withColumn("text_hash", F.sha2("text", 256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                m = np.asarray(embedder(part.column(1).to_pylist(), dims), np.float32)
                if m.shape != (part.num_rows, dims):
                    raise ValueError(f"the embedder gave {m.shape}, not {(part.num_rows, dims)}")
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * dims, pa.int32()), pa.array(m.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([provider] * part.num_rows), pa.array([dims] * part.num_rows, pa.int32()), lists], names=["vec_id", "text_hash", "provider", "dims", "embedding"])

    if known is None:
        return texts.mapInArrow(run, SCHEMA)
    fit = known.where((F.col("provider") == provider) & (F.col("dims") == dims) & (F.size("embedding") == dims))
    have = fit.join(texts.select("vec_id", "text_hash"), ["vec_id", "text_hash"], "left_semi").dropDuplicates(["vec_id"]).select("vec_id", "text_hash", "provider", "dims", "embedding")
    return have.unionByName(texts.join(have.select("vec_id"), "vec_id", "left_anti").mapInArrow(run, SCHEMA))


def vectors_of(vectors: DataFrame, ids: DataFrame) -> DataFrame:
    """The vectors of the ids in a table of vec_id."""
    return vectors.join(ids.select("vec_id").distinct(), "vec_id", "left_semi")


def parse_vector(text: Column) -> Column:
    """A text `[a,b]` as a vector, empty where it is none."""
    return F.coalesce(F.from_json(text, "array<float>"), F.array().cast("array<float>"))


def cosine(a: Column, b: Column) -> Column:
    """Within 0 and 1; 0 where a side is missing, of another length, or zero."""
    whole = F.coalesce((F.size(a) == F.size(b)) & (F.size(a) > 0), F.lit(False))
    value = F.try_divide(K.dot(a, b), F.sqrt(K.dot(a, a) * K.dot(b, b)))
    return F.when(whole, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value, F.lit(0.0))))).otherwise(0.0)


def semantic_similarity(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """pairs with semantic_sim: two equi-joins on the ids."""
    side = lambda c: vectors.select(F.col("vec_id").alias(c), F.col("embedding").alias(f"_{c}"))
    both = pairs.join(side("i"), "i", "left").join(side("j"), "j", "left")
    return both.withColumn("semantic_sim", cosine(F.col("_i"), F.col("_j"))).drop("_i", "_j")


def export(vectors: DataFrame, folder: str) -> None:
    """Vectors by id, and their count by provider and length."""
    vectors.orderBy("vec_id").write.mode("overwrite").parquet(f"{folder}/embeddings")
    vectors.groupBy("provider", "dims").agg(F.count("*").alias("vectors")).coalesce(1).write.mode("overwrite").json(f"{folder}/metrics")

"""Line dedup with two Bloom filters.

1. Each task marks the line hashes of its documents in two Bloom filters of the
   same shape: seen once, and seen twice.  Filters are merged by segments:
   once = a | b, twice = a2 | b2 | (a & b), which misses no hash seen in both.
2. Only lines whose hash the second filter holds are suspected.  They shuffle,
   by their full keys, to be confirmed: in how many documents, and the largest.
3. Documents are rewritten.  Where the confirmed keys are few, they are sent to
   all executors as 128-bit hashes; else they are joined to documents by id.

The filter grows with the number of documents up to MOST_BITS (128 MB): past
that more lines are suspected, and the result is still exact.

Defined results.  A null or empty text is one empty line.  Documents are told
apart by id: rows that repeat an id count as one document (so do all null ids,
which sort below others), and all of them keep the line if the id does.  A very
long text or line is read whole.  Further columns, whatever their names, pass
through untouched.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.arrow import column, slices
from kindred.llm.common import BROADCAST_ROWS, materialize, ship, sized_join, text_of

LEAST_CHARS, LEAST_DOCS = 20, 3
BITS_A_DOC, LEAST_BITS, MOST_BITS, SEGMENT_BITS, HASHES = 256, 1 << 20, 1 << 30, 1 << 16, 3
_SPACE = b" \t\n\x0b\x0c\r"


def key_of(line: bytes, least: int = LEAST_CHARS) -> bytes | None:
    """A line's key, or None where it is too short to count."""
    key = line.strip(_SPACE).lower()
    return key if len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least) else None


def keys_of(text: bytes, least: int) -> set[bytes]:
    return {k for x in text.split(b"\n") if (k := key_of(x, least)) is not None}


def places(keys: list[bytes], bits: int) -> np.ndarray:
    """HASHES bit numbers for each key, by double hashing."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))
    step = (h >> np.uint64(33)) | np.uint64(1)
    return ((h[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


class Blooms:
    """The two filters of one task, as bits."""

    def __init__(self, bits: int):
        self.bits, self.once, self.twice = bits, np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, keys: list[bytes]) -> None:
        """Mark distinct keys; those that are marked already are seen twice now."""
        at = places(keys, self.bits)
        seen = at[has(self.once, at)]
        for bits, which in ((self.twice, seen), (self.once, at)):
            np.bitwise_or.at(bits, which.ravel() >> 3, (1 << (which.ravel() & 7)).astype(np.uint8))


def has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def twice_seen(docs: DataFrame, text_col: str, least: int, bits: int) -> bytes:
    """The merged filter of keys seen in two texts or more; bits / 8 bytes, whatever the corpus's size."""
    schema = "segment int, once binary, twice binary"
    names = ["segment", "once", "twice"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blooms = None
        for batch in slices(batches, "text"):
            blooms = blooms or Blooms(bits)
            for text in column(batch, "text").cast(pa.large_binary()).to_pylist():
                if keys := keys_of(text, least):
                    blooms.add(list(keys))
        if blooms is None:
            return
        width = SEGMENT_BITS // 8
        once, twice = blooms.once.reshape(-1, width), blooms.twice.reshape(-1, width)
        z = zstandard.ZstdCompressor(level=1)
        for i in np.flatnonzero(once.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([z.compress(once[i].tobytes())]), pa.array([z.compress(twice[i].tobytes())])], names=names)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, width, held = zstandard.ZstdDecompressor(), SEGMENT_BITS // 8, None

        def done(x) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[0]], pa.int32()), pa.array([zstandard.compress(x[2].tobytes(), 3)])], names=["segment", "twice"])

        for batch in batches:
            for i, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                once, twice = (np.frombuffer(z.decompress(x, max_output_size=width), np.uint8) for x in (a, b))
                if held and held[0] == i:
                    held = (i, held[1] | once, held[2] | twice | (held[1] & once))
                else:
                    if held:
                        yield done(held)
                    held = (i, once, twice)
        if held:
            yield done(held)

    rows = docs.select(text_of(F.col(text_col)).alias("text")).mapInArrow(mark, schema)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = materialize(rows.repartition(parts, "segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, twice binary"), "bloom")
    out = np.zeros(bits // 8, np.uint8)
    for r in merged.toLocalIterator():
        out[r.segment * SEGMENT_BITS // 8 : (r.segment + 1) * SEGMENT_BITS // 8] = np.frombuffer(zstandard.decompress(bytes(r.twice)), np.uint8)
    return out.tobytes()


def suspects(docs: DataFrame, bloom, bits: int, id_col: str, text_col: str, least: int) -> DataFrame:
    """(key, id): the distinct keys of each row that the broadcast filter holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(bloom.value, np.uint8)
        for batch in slices(batches, "text"):
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), column(batch, "text").cast(pa.large_binary()).to_pylist()):
                if own := list(keys_of(text, least)):
                    found = np.flatnonzero(has(twice, places(own, bits))).tolist()
                    keys += [own[i] for i in found]
                    ids += [doc_id] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "id"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(F.col(text_col)).alias("text")).mapInArrow(run, "key binary, id long")


def rewrite(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, bits: int | None = None, few: int = BROADCAST_ROWS) -> DataFrame:
    """_row (a row of docs without its text), n_lines, n_dropped and kept_text for each row."""
    spark = docs.sparkSession
    ship(spark)
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << (docs.count() * BITS_A_DOC).bit_length()))
    bloom = spark.sparkContext.broadcast(twice_seen(docs, text_col, least, bits))
    found = suspects(docs, bloom, bits, id_col, text_col, least)
    repeated = found.distinct().groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("keep")).where(F.col("n") >= least_docs)
    repeated = materialize(repeated.select("key", "keep"), "repeated-lines")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_row"), F.col(id_col).cast("long").alias("id"), text_of(F.col(text_col)).alias("text"))
    number = repeated.limit(few + 1).count()

    if number <= few:
        known = spark.sparkContext.broadcast({xxhash.xxh3_128_digest(bytes(r.key)): r.keep for r in repeated.toLocalIterator()})
        rows = rows.withColumn("drop", F.lit(None).cast("array<binary>"))
    else:
        known = None
        gone = sized_join(found.distinct(), repeated, "key", "inner").where(~F.col("id").eqNullSafe(F.col("keep")))
        gone = materialize(gone.groupBy("id").agg(F.collect_list("key").alias("drop")), "dropped-lines")
        rows = rows.alias("a").join(gone.alias("b"), F.col("a.id").eqNullSafe(F.col("b.id")), "left").select("a.*", "b.drop")
    kind = rows.schema["_row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value if known else None
        for batch in slices(batches, "text"):
            lines, dropped, kept = [], [], []
            for doc_id, text, drop in zip(batch.column(1).to_pylist(), column(batch, "text").cast(pa.large_binary()).to_pylist(), batch.column(3).to_pylist()):
                parts, own = text.split(b"\n"), set(drop or ())
                stay = []
                for x in parts:
                    key = key_of(x, least)
                    if table is not None:
                        gone = key is not None and (d := xxhash.xxh3_128_digest(key)) in table and table[d] != doc_id
                    else:
                        gone = key in own
                    if not gone:
                        stay.append(x)
                lines.append(len(parts)), dropped.append(len(parts) - len(stay)), kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string())], names=["_row", "n_lines", "n_dropped", "kept_text"])

    return rows.mapInArrow(run, f"_row {kind}, n_lines long, n_dropped long, kept_text string")


def deduplicate(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """docs with repeated lines gone, and n_chars, where there is one, set anew."""
    new = {text_col: F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return rewrite(docs, text_col=text_col, **how).select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 for each row."""
    slim = docs.select("doc_id", "text")
    return rewrite(slim, **how).select("_row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, rid, unnest(x) AS line, unnest(range(len(x))) AS i FROM (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM (SELECT k.*, keep IS NOT NULL AND keep <> doc_id AS gone FROM k LEFT JOIN r USING (key)) GROUP BY rid, doc_id
"""

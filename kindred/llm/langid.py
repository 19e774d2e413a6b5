"""Language identification by compression.

Each language has a zstandard raw-content dictionary: labelled texts laid end
to end.  A text is compressed with every dictionary, and the language whose
dictionary gives the fewest bytes is its own.  A narrow margin over the next
language is flagged as rejected.

Learning uses a bounded sample: for each language, whole texts in the order of
a hash of their own, until DICT_BYTES bytes are full.  About SAMPLE_DOCS texts
a language are fetched for it, whatever the corpus's size.  Predictions see the
whole text and nothing else.

Defined results.  Null texts and texts without a letter are `und` with score 0.
With no labelled text, everything is `und`.  Ties go to the first language by
code point.  Rows that repeat get equal results.  A very long text is compressed
whole.  Only the id, text and language columns are read, so others may have any
name.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.arrow import column, slices
from kindred.llm.common import materialize, ship, text_of

DICT_BYTES, SAMPLE_DOCS, LEVEL, MARGIN = 96 << 10, 400, 6, 0.02


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; null ids do not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dict_bytes: int = DICT_BYTES, sample_docs: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """A dictionary for each language of the labelled docs: a bounded sample of their texts.

    The languages' counts set each one's sampling rate, so a sample holds about
    2 * sample_docs texts of each; a text over an eighth of the dictionary is left out of it.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), text_of(F.col(text_col)).alias("text")).where("lang IS NOT NULL")
    rows = rows.where((F.octet_length("text") <= dict_bytes // 8) & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    mark = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    limit = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1 << 40, (1 << 40) * 2 * sample_docs // n + 1))]), F.col("lang"))
    some = materialize(rows.withColumn("mark", mark).where(F.col("mark") < limit), "lang-sample")
    out: dict[str, list[str]] = {k: [] for k in counts}
    size = dict.fromkeys(counts, 0)
    # Equal texts count once: a group of copies must not fill a dictionary.
    for r in some.dropDuplicates(["lang", "text"]).orderBy("lang", "mark", "text").toLocalIterator():
        n = len(r.text.encode()) + 1
        if size[r.lang] + n <= dict_bytes:
            out[r.lang].append(r.text)
            size[r.lang] += n
    return {k: "\n".join(reversed(v)).lower().encode() for k, v in sorted(out.items()) if v}  # the best-ranked text nearest the end


def predict(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", level: int = LEVEL, margin: float = MARGIN) -> DataFrame:
    """doc_id, lang_pred, score, rejected for each row.  The dictionaries are as large as the languages' number times DICT_BYTES."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(sorted(dictionaries.items()))
    ready: list = []
    names = ["doc_id", "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not ready:
            for lang, content in sent.value:
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=level)
                ready.append((lang, zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)))
        for batch in slices(batches, "text"):
            source = column(batch, "text")
            letters = pc.match_substring_regex(source, r"\p{L}").to_pylist()
            lang, score, narrow = [], [], []
            for text, ok in zip(pc.utf8_lower(source).cast(pa.large_binary()).to_pylist(), letters):
                if not ok or not ready:
                    lang.append("und"), score.append(0.0), narrow.append(True)
                    continue
                sizes = sorted((len(z.compress(text)), i) for i, (_, z) in enumerate(ready))
                gain = 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
                lang.append(ready[sizes[0][1]][0]), score.append(gain), narrow.append(gain < margin)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(narrow, pa.bool_())], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def report(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out; predict all: doc_id, held_out, lang_pred, score, rejected."""
    found = predict(docs, learn(docs.where(~held_out(F.col("doc_id")))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")

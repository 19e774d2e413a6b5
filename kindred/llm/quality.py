"""Quality rules with adaptive thresholds, from mergeable quantile sketches per language and source.

Each metric is an integer.  A sketch is a table (group, metric, bucket, count)
over log-linear buckets whose lower ends are exact to 1 part in 128: merging
sketches adds counts, so any order of merging, and any engine, gives the same
numbers.  Fences lie `spread` interquartile ranges beyond the quartiles of a
document's language and source; groups of under `least` documents take their
language's fences, small languages the corpus's.  Sources and languages are
merged from the same sketch.

Rule base (fixed): too few words, or too many words in repeated 5-word windows.
Windows are compared by 64-bit hashes, twice over by different bits of them.

Filters on the result work on finished measures and are not pushed into the
scan of the documents.  The sketches' windows run over buckets, of which a
(language, source, metric) has some hundreds at most, whatever the number of
documents.

Defined results.  Null text has no words and fails the base.  Null languages
and sources form groups of their own.  Every row gets a verdict of its own, so
repeated rows get equal ones; ties at a fence are within it.  A very long text
is measured whole.  Further columns, whatever their names, pass through
`filter_documents` untouched.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import WORD, WS, materialize, sized_join, text_of, words

SYMBOLS = "[#*$%&|<>]"
#: metric: (side of the fence that rejects, least interquartile range that counts).
METRICS = {"symbols": ("above", 50), "word_length": ("both", 25), "dup_lines": ("above", 150)}


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _repeat_steps(df: DataFrame, width: int = 5) -> DataFrame:
    """From _words: n_repeat_words, the words that lie in a window of `width` words found twice or more.

    Windows are numbered from 0.  Only a text with two equal window hashes goes on: its hashes
    are packed with their numbers into longs and sorted, so that equal ones are neighbours.  A
    pack holds 36 bits of a hash; one with the low and one with the high bits must both agree.
    """
    n = F.size("_words")
    window = lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(width)])
    df = df.withColumn("_hash", F.when(n > width, F.transform(F.sequence(F.lit(0), n - width), window)))
    df = df.withColumn("_dup", F.size(F.array_distinct("_hash")) < F.size("_hash"))

    def packed(bits: Column) -> Column:
        return F.when(F.col("_dup"), F.sort_array(F.transform("_hash", lambda h, i: F.shiftleft(bits(h), 28).bitwiseOR(i.cast("long")))))

    df = df.withColumns({"_low": packed(lambda h: h), "_high": packed(lambda h: F.shiftrightunsigned(h, 28))})

    def paired(name: str) -> Column:
        same = lambda a, b: F.shiftrightunsigned(a, 28) == F.shiftrightunsigned(b, 28)
        kept = F.filter(name, lambda x, k: F.coalesce(same(x, F.get(name, k - 1)), F.lit(False)) | F.coalesce(same(x, F.get(name, k + 1)), F.lit(False)))
        return F.transform(kept, lambda x: x.bitwiseAND(F.lit((1 << 28) - 1)))

    df = df.withColumn("_at", F.when(F.col("_dup"), F.sort_array(F.array_intersect(paired("_low"), paired("_high")))))
    covered = F.aggregate("_at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).cast("long").alias("last")),
                          lambda a, x: F.struct((a["n"] + F.least(F.lit(width).cast("long"), x - a["last"])).alias("n"), x.alias("last")))["n"]
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_hash", "_dup", "_low", "_high", "_at")


def _measured(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Rows as `_row`, the group's columns, and what is cheap to measure."""
    text = F.col("_text")
    df = docs.select(F.struct("*").alias("_row")).select("_row", text_of(F.col(f"_row.`{text_col}`")).alias("_text"), F.col(f"_row.`{lang_col}`").alias("_lang"), F.col(f"_row.`{source_col}`").alias("_source"))
    df = df.withColumn("_words", words(text))
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.regexp_replace(text, f"[{WS}]+", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": n_dup_lines(text),
        "_lines": F.size(F.split(text, "\n")).cast("long"),
    })
    per = F.greatest(F.col("n_words"), F.lit(1))
    return df.withColumns({
        "symbols": F.expr("n_symbols * 1000 div greatest(n_words, 1)"),  # per 1,000 words
        "word_length": F.expr("word_chars * 100 div greatest(n_words, 1)"),  # hundredths of a character
        "dup_lines": F.expr("n_dup_lines * 1000 div _lines"),  # per 1,000 lines
    })


def bucket(v: Column) -> Column:
    """The lower end of v's bucket: v's 8 highest binary digits, then zeros."""
    shift = F.greatest(F.length(F.bin(v)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): mergeable by adding n."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in METRICS]))
    long = measured.where("n_words > 0").select("_lang", "_source", values.alias("x")).select("_lang", "_source", "x.metric", bucket(F.col("x.v")).alias("bucket"))
    return long.groupBy("_lang", "_source", "metric", "bucket").agg(F.count("*").alias("n"))


def fences(sketches: DataFrame, spread: float, least: int) -> DataFrame:
    """lo and hi of each metric for every (lang, source), from the smallest group around it that has `least` documents."""
    rows = None
    for level in (2, 1, 0):
        keys = ["_lang", "_source"][:level]
        merged = sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
        w = Window.partitionBy(*keys, "metric")
        run = merged.withColumns({"upto": F.sum("n").over(w.orderBy("bucket")), "total": F.sum("n").over(w)})
        at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("total") * q, F.col("bucket")))
        quart = run.groupBy(*keys, "metric").agg(at(25).alias("q1"), at(75).alias("q3"), F.max("total").alias("total"))
        floor = F.coalesce(*[F.when(F.col("metric") == m, F.lit(x)) for m, (_, x) in METRICS.items()])
        iqr = F.greatest(F.col("q3") - F.col("q1"), floor)
        quart = quart.select(*keys, "metric", F.struct("total", (F.col("q1") - spread * iqr).alias("lo"), (F.col("q3") + spread * iqr).alias("hi")).alias(f"f{level}"))
        if rows is None:
            rows = quart
        else:
            cond = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "metric"]]
            rows = rows.alias("a").join(quart.alias("b"), cond).select("a.*", f"b.f{level}")
    fence = F.when(F.col("f2.total") >= least, F.col("f2")).when(F.col("f1.total") >= least, F.col("f1")).otherwise(F.col("f0"))
    return rows.select("_lang", "_source", "metric", fence.alias("f")).groupBy("_lang", "_source").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("f"))).alias(f"f_{m}") for m in METRICS])


def _held(name: str) -> Column:
    """The column, such that no filter on it moves below this projection: there it would repeat all the steps that lead to it within each other."""
    return F.when(F.monotonically_increasing_id() >= 0, F.col(name)).alias(name)


def annotate(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", spread: float = 6.0, least: int = 100) -> DataFrame:
    """Rows of docs as struct `_row`, with the metrics, base_failed and kept.

    docs is read twice: once for the sketches, once for the verdicts.
    """
    measured = _measured(docs, text_col, lang_col, source_col)
    limits = materialize(fences(materialize(sketch(measured), "quality-sketches"), spread, least), "quality-fences")
    limits = limits.withColumnsRenamed({"_lang": "_l", "_source": "_s"})
    full = _repeat_steps(measured)
    full = full.select("_row", "_lang", "_source", *[_held(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *METRICS)])
    full = sized_join(full, limits, F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")), "left")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    within = F.lit(True)
    for m, (side, _) in METRICS.items():
        f = F.col(f"f_{m}")
        within = within & F.coalesce(F.col(m) <= f["hi"], F.lit(True))
        if side == "both":
            within = within & F.coalesce(F.col(m) >= f["lo"], F.lit(True))
    return full.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & within)


def report(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    return annotate(docs, **how).select(F.col(f"_row.`{id_col}`").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def filter_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs that are kept, with docs' own columns."""
    return annotate(docs, **how).where("kept").select("_row.*")


def _oracle(spread: float = 6.0, least: int = 100) -> str:
    ws = r"[\x20\x09-\x0D]+"

    def level(n: int) -> str:
        keys = ["lang", "source"][:n]
        k = "".join(f"{x}, " for x in keys)
        floors = " ".join(f"WHEN '{m}' THEN {x}" for m, (_, x) in METRICS.items())
        return f"""
r{n} AS (SELECT {k}metric, bucket, sum(sum(n)) OVER (PARTITION BY {k}metric ORDER BY bucket) AS upto, sum(sum(n)) OVER (PARTITION BY {k}metric) AS total FROM sk GROUP BY {k}metric, bucket),
q{n} AS (SELECT {k}metric, min(bucket) FILTER (upto * 100 >= total * 25) AS q1, min(bucket) FILTER (upto * 100 >= total * 75) AS q3, max(total) AS total FROM r{n} GROUP BY {k}metric),
f{n} AS (SELECT {k}metric, total, q1 - {spread} * greatest(q3 - q1, CASE metric {floors} END) AS lo, q3 + {spread} * greatest(q3 - q1, CASE metric {floors} END) AS hi FROM q{n})"""

    tests = " AND ".join(
        f"x.{m} <= (SELECT hi FROM f WHERE f.lang IS NOT DISTINCT FROM x.lang AND f.source IS NOT DISTINCT FROM x.source AND metric = '{m}')"
        + (f" AND x.{m} >= (SELECT lo FROM f WHERE f.lang IS NOT DISTINCT FROM x.lang AND f.source IS NOT DISTINCT FROM x.source AND metric = '{m}')" if side == "both" else "")
        for m, (side, _) in METRICS.items())
    return f"""
WITH a AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
b AS (SELECT *, list_filter(regexp_split_to_array(t, '{ws}'), lambda x: x <> '') AS w, string_split(t, chr(10)) AS li FROM a),
c AS (SELECT *, list_filter(li, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS wl, row_number() OVER () AS rid FROM b),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM (SELECT rid, i, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM c WHERE len(w) >= 5))),
e AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM g, range(5) AS z(k) WHERE n > 1 GROUP BY rid),
m AS (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{ws}', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols,
  (len(wl) - len(list_distinct(wl)))::BIGINT AS n_dup_lines, len(li) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM c LEFT JOIN e USING (rid)),
x AS (SELECT *, n_symbols * 1000 // greatest(n_words, 1) AS symbols, word_chars * 100 // greatest(n_words, 1) AS word_length, n_dup_lines * 1000 // n_lines AS dup_lines FROM m),
v AS (UNPIVOT (SELECT lang, source, symbols, word_length, dup_lines FROM x WHERE n_words > 0) ON symbols, word_length, dup_lines INTO NAME metric VALUE v),
sk AS (SELECT lang, source, metric, (v >> greatest(length(bin(v)) - 8, 0)) << greatest(length(bin(v)) - 8, 0) AS bucket, count(*) AS n FROM v GROUP BY ALL),
{level(2)},{level(1)},{level(0)},
f AS (SELECT f2.lang, f2.source, metric, CASE WHEN f2.total >= {least} THEN f2.lo WHEN f1.total >= {least} THEN f1.lo ELSE f0.lo END AS lo,
  CASE WHEN f2.total >= {least} THEN f2.hi WHEN f1.total >= {least} THEN f1.hi ELSE f0.hi END AS hi
  FROM f2 JOIN f1 ON f1.metric = f2.metric AND f1.lang IS NOT DISTINCT FROM f2.lang JOIN f0 ON f0.metric = f2.metric, (SELECT 1) AS o(one))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND ({tests}) AS kept FROM x
""".replace("metric, CASE WHEN f2.total", "f2.metric, CASE WHEN f2.total")


ORACLE_SQL = _oracle()

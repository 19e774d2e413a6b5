"""Candidate pairs: exact keys, words, trigrams and vectors, merged as evidence; the gate of the vector layer.

A pair is (i, j) with i < j by source id.  Ties go to the smaller j.

Words: the query's words must all occur in the document; distinct queries meet
distinct documents by their rarest word in the brand, so no brand is compared
as a whole.  Hits are ranked by cover density.  Of a document only the words
that are asked for count, and the places of the others.

Trigrams: titles of a brand are put in order of length and cut into blocks of
BLOCK_TITLES; two blocks meet only where their lengths can lie within `gap`.
A pair of blocks is one matrix product of gram incidences, which counts all
shared grams exactly.  Hits are between titles; products come in last.

Vectors: blocks of about BLOCK_ROWS rows, two at a time, as matrix products.

Defined results.  Products without a brand or a title have no pairs in the
layers that need one.  Null vectors and vectors of length 0 have no pairs.
Products that repeat an id are paired with others, never with each other.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred import functions as K
from kindred.functions.rank import cover_density
from kindred.operators.nearest import best, key, last_ids
from kindred.operators.products import exact_keys, search_text
from kindred.operators.storage import partitions, written


def exact_pairs(p: DataFrame, own: tuple = ()) -> DataFrame:
    """Pairs that share an exact key: an equi-join on (type, value); AQE splits hot keys.  Columns named in `own` come along as c_i and c_j."""
    a, b = exact_keys(p, own).alias("a"), exact_keys(p, own).alias("b")
    same = (F.col("a.key_type") == F.col("b.key_type")) & (F.col("a.key_value") == F.col("b.key_value")) & (F.col("a.source_id") < F.col("b.source_id"))
    return a.join(b, same).select(F.col("a.source_id").alias("i"), F.col("b.source_id").alias("j"), F.concat_ws(":", F.lit("exact"), "a.key_type", F.substring("a.key_value", 1, 80)).alias("evidence"), *[F.col(f"{x}.{c}").alias(f"{c}_{k}") for c in own for x, k in (("a", "i"), ("b", "j"))])


def exact_links(p: DataFrame) -> DataFrame:
    """(i, j): each product and the smallest id with a key of its own; what exact pairs connect, these do."""
    first = F.min("source_id").over(Window.partitionBy("key_type", "key_value"))
    return exact_keys(p).select(first.alias("i"), F.col("source_id").alias("j")).where("i <> j").distinct()


def _top(pairs: DataFrame, by: str, k: int) -> DataFrame:
    """The k best partners of each i, ties by j; planned as a group limit before and after the shuffle."""
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc(by), "j"))
    return pairs.withColumn("rn", rank).where(F.col("rn") <= k).drop("rn")


def _words(c: Column) -> Column:
    return F.filter(F.split(c, "[^a-z0-9]+"), lambda x: x != "")


def _asked(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """y of documents (brand_norm, y) told by the words that some query of the brand asks for: others count by their place alone, and behind the last asked one not at all.

    Texts that differ in what nobody asks for (a product's number, say) thus become one document.  Documents without asked words are gone.
    """
    lines = F.transform(F.split("y", "\n"), lambda line, n: F.transform(F.filter(F.split(line, r"\s+"), lambda w: w != ""), lambda w: F.struct(n.alias("line"), w.alias("w"))))
    placed = docs.select("brand_norm", "y", F.posexplode(F.flatten(lines)).alias("at", "x")).select("brand_norm", "y", "at", "x.*")
    words = placed.select("*", F.explode(_words(F.col("w"))).alias("word")).join(vocabulary, ["brand_norm", "word"], "left_semi")
    kept = words.groupBy("brand_norm", "y").agg(F.array_sort(F.collect_set(F.struct("at", "line", "w"))).alias("kept"))

    def step(told: Column, x: Column) -> Column:
        breaks, gap = F.repeat(F.lit("\n"), x["line"] - told["line"]), F.repeat(F.lit(" -"), x["at"] - told["at"] - 1)
        return F.struct(F.concat(told["text"], breaks, gap, F.lit(" "), x["w"]).alias("text"), x["at"].alias("at"), x["line"].alias("line"))

    none = F.struct(F.lit("").alias("text"), F.lit(-1).alias("at"), F.lit(0).alias("line"))
    return kept.select("brand_norm", "y", F.aggregate("kept", none, step)["text"].alias("told"))


def lexical_pairs(p: DataFrame, k: int = 25, own: tuple = ()) -> DataFrame:
    """Products of one brand whose words hold all of i's query words, by cover density; then the share of their words that match.

    The query is the search text; the document brand and title (of most weight), category, specs and description.
    Distinct queries meet distinct documents; their products meet in `nearest.best`, where columns named in `own` come along.
    """
    slim = p.where("brand_norm <> ''").select(
        "source_id", "brand_norm", F.array_sort(F.array_distinct(_words(K.folded(search_text())))).alias("q"),
        F.concat_ws("\n", "brand_norm", "name_norm", F.replace("category_norm", F.lit(">"), F.lit(" ")), "specs_text", "description_norm").alias("y"), *own)
    slim = written(slim.withColumn("x", F.array_join("q", " ")).where("x <> ''").drop("q"))
    asked = written(slim.select("brand_norm", "x").distinct())
    words = asked.select("brand_norm", "x", F.explode(F.split("x", " ")).alias("word"))
    texts = written(_asked(slim.select("brand_norm", "y").distinct(), words.select("brand_norm", "word").distinct()))
    docs = texts.select("brand_norm", "told").distinct().withColumn("d", F.array_distinct(_words(F.col("told"))))
    docs = written(docs.select("brand_norm", "told", "d", F.explode("d").alias("word")))
    found = docs.groupBy("brand_norm", "word").agg(F.count("*").alias("n"))
    rarest = words.join(found, ["brand_norm", "word"], "left").groupBy("brand_norm", "x").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word"))["word"].alias("word"))
    q = F.split("x", " ")
    hits = rarest.join(docs, ["brand_norm", "word"]).where(F.size(F.array_except(q, "d")) == 0)
    hits = hits.select(key("brand_norm", "x").alias("q"), key("brand_norm", "told").alias("d"), cover_density(q, F.col("told")).alias("score"))
    members = slim.select("source_id", key("brand_norm", "y").alias("y"), *own).join(texts.select(key("brand_norm", "y").alias("y"), key("brand_norm", "told").alias("d")), "y").drop("y")
    return best(slim.select(key("brand_norm", "x").alias("q"), "source_id", *own), members, hits, k, TITLE_IDS, own).withColumn("score", F.round("score", 4))


#: Titles of a block, about (two blocks are compared at a time), and products of a title that stay together.
BLOCK_TITLES, TITLE_IDS = 1024, 65_536


def _near_titles(k: int, least: float, gap: int):
    """Of two blocks of titles (or one twice): each title's near ones, best first, until k products behind its last one are sure."""

    def run(table: pa.Table) -> pa.Table:
        keys, grams, block, lens = table["key"].combine_chunks(), table["grams"].combine_chunks(), table["block"].to_numpy(), table["len"].to_numpy()
        last = table["last"].combine_chunks()
        rank = np.unique(np.asarray(last.flatten(), dtype=object), return_inverse=True)[1]
        ends = np.asarray(last.offsets) - last.offsets[0].as_py()
        n = np.diff(ends)
        ids = np.full((len(n), k), -1)
        ids[np.repeat(np.arange(len(n)), n), np.arange(len(rank)) - np.repeat(ends[:-1], n)] = rank
        terms = grams.flatten().dictionary_encode()
        codes, size = np.asarray(terms.indices), np.diff(np.asarray(grams.offsets))
        m = np.zeros((len(n), len(terms.dictionary)), np.float32)
        m[np.repeat(np.arange(len(n)), size), codes] = 1
        first, second = table["a"][0].as_py(), table["b"][0].as_py()
        out = []
        for x, y in {(first, second), (second, first)}:
            left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
            for at in range(0, len(left), 256):
                rows = left[at : at + 256]
                both = (m[rows] @ m[right].T).astype(np.float64)
                score = both / (size[rows][:, None] + size[right] - both)
                score[np.abs(lens[rows][:, None] - lens[right]) > gap] = 0
                for r in np.flatnonzero((score >= least).any(1)):
                    near = np.flatnonzero(score[r] >= least)
                    near = near[np.argsort(-score[r, near], kind="stable")]
                    s = score[r, near]
                    behind = np.r_[0, np.cumsum((ids[right[near]] > ids[rows[r], 0]).sum(1))]
                    near = near[behind[np.searchsorted(-s, -s, "left")] < k]
                    out.append((np.full(len(near), rows[r]), right[near], score[r, near]))
        q, d, s = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"q": keys.take(q), "d": keys.take(d), "score": pa.array(s, pa.float64())})

    return run


def _title_blocks(titles: DataFrame) -> DataFrame:
    """brand_norm, key, len, grams, last ids and block of each title: bands of lengths that hold about BLOCK_TITLES titles, large bands cut by hash."""
    titles = written(titles.withColumn("len", F.length("name_norm")))
    lens = titles.groupBy("brand_norm", "len").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("brand_norm").orderBy("len").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lens = lens.withColumn("band", F.floor((upto - F.col("n")) / BLOCK_TITLES))
    bands = lens.groupBy("brand_norm", "band").agg(F.ceil(F.sum("n") / BLOCK_TITLES).alias("cuts"))
    lens = lens.join(bands, ["brand_norm", "band"]).select("brand_norm", "len", "band", "cuts")
    block = F.shiftleft("band", 24) + F.pmod(F.xxhash64("name_norm"), F.col("cuts"))
    return titles.join(lens, ["brand_norm", "len"]).select("brand_norm", "len", key("brand_norm", "name_norm").alias("key"), K.trigrams(F.col("name_norm")).alias("grams"), "last", block.alias("block"))


def trigram_pairs(p: DataFrame, k: int = 25, least: float = 0.55, max_block: int | None = None, gap: int = 24, own: tuple = ()) -> DataFrame:
    """Top-k trigram neighbours j > i within a brand, titles differing by up to `gap` characters; brands of over max_block products are left out.

    Distinct titles are compared; their products meet in `nearest.best`, where columns named in `own` come along.
    """
    named = p.where("brand_norm <> '' AND name_norm <> ''").select("source_id", "brand_norm", "name_norm", *own)
    if max_block is not None:
        named = named.join(p.groupBy("brand_norm").agg(F.count("*").alias("n")).where(F.col("n") <= max_block).select("brand_norm"), "brand_norm", "left_semi")
    titles = written(_title_blocks(last_ids(named, k, "brand_norm", "name_norm")).where(F.size("grams") > 0))
    span = titles.groupBy("brand_norm", "block").agg(F.min("len").alias("lo"), F.max("len").alias("hi"))
    near = (F.col("a.brand_norm") == F.col("b.brand_norm")) & (F.col("a.block") <= F.col("b.block")) & (F.col("b.lo") - F.col("a.hi") <= gap)
    meet = span.alias("a").join(span.alias("b"), near).select("a.brand_norm", F.col("a.block").alias("a"), F.col("b.block").alias("b"))
    sides = written(meet.select("*", F.explode(F.array_distinct(F.array("a", "b"))).alias("block")))
    n = max(partitions(p.sparkSession), min(2000, sides.count()))
    dealt = titles.join(sides, ["brand_norm", "block"]).repartition(n, "brand_norm", "a", "b")
    hits = dealt.groupBy("brand_norm", "a", "b").applyInArrow(_near_titles(k, least, gap), "q binary, d binary, score double")
    titled = named.select(key("brand_norm", "name_norm").alias("q"), "source_id", *own)
    return best(titled, titled.withColumnRenamed("q", "d"), hits, k, TITLE_IDS, own).withColumn("score", F.round("score", 4))


#: Vectors of a block, at least and at most about; two blocks are compared at a time.  In between there are FEW_BLOCKS, so that the copies of a vector don't grow.
BLOCK_ROWS, MOST_ROWS, FEW_BLOCKS = 2048, 32_768, 36


def _near_vectors(k: int, least: float, kind: pa.DataType):
    """Of a pair of blocks (columns a, b, block, vec_id, embedding): the k best j of each i, both ways."""

    def run(table: pa.Table) -> pa.Table:
        ids, block = table["vec_id"].to_numpy(), table["block"].to_numpy()
        flat = table["embedding"].combine_chunks()
        m = np.asarray(flat.flatten(), dtype=np.float64).reshape(len(ids), -1)
        m /= np.sqrt((m * m).sum(1, keepdims=True))
        first, second = table["a"][0].as_py(), table["b"][0].as_py()
        out = []
        for x, y in {(first, second), (second, first)}:
            left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
            right = right[np.argsort(ids[right], kind="stable")]
            step = max(1, min(256, 2**21 // max(1, len(right))))
            for at in range(0, len(left), step):
                rows = left[at : at + step]
                s = (m[rows] @ m[right].T).round(12)  # what rounds alike is a tie, and goes by j
                s[ids[rows][:, None] == ids[right]] = -2
                hit = s >= least
                for r in np.flatnonzero(hit.any(1)):
                    js = np.flatnonzero(hit[r])
                    js = js[np.argsort(-s[r, js], kind="stable")[:k]]
                    out.append((np.full(len(js), ids[rows[r]]), ids[right[js]], s[r, js]))
        i, j, score = (np.concatenate(x) for x in zip(*out)) if out else (ids[:0], ids[:0], np.zeros(0))
        return pa.table({"i": pa.array(i, kind), "j": pa.array(j, kind), "score": pa.array(score, pa.float64())})

    return run


def vector_pairs(vectors: DataFrame, k: int = 25, least: float = 0.78, anchors: DataFrame | None = None, pool: DataFrame | None = None) -> DataFrame:
    """Exact cosine neighbours of vectors (vec_id, embedding): top k of each, unordered pairs by their best similarity.

    Rows are dealt to blocks by the hash of their id.  Each pair of blocks is a
    group of its own that keeps k partners of a vector; the k best of these
    are the k best of all.  anchors and pool, tables of vec_id, bound who asks
    and who is found; without them all vectors do both.
    """
    text = dict(vectors.dtypes)["vec_id"] == "string"
    v = vectors.where(K.dot(F.col("embedding"), F.col("embedding")) > 0).select(F.col("vec_id").cast("string" if text else "long").alias("vec_id"), "embedding")
    if pool is not None:
        v = v.join(pool.select("vec_id").distinct(), "vec_id", "left_semi")
    n = v.count()
    blocks = n // max(BLOCK_ROWS, min(MOST_ROWS, n // FEW_BLOCKS)) + 1
    v = v.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    dealt = v.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "vec_id", "embedding")
    n = max(partitions(v.sparkSession), min(200, blocks * (blocks + 1) // 2))
    kind = "string" if text else "long"
    scored = dealt.repartition(n, "a", "b").groupBy("a", "b").applyInArrow(_near_vectors(k, least, pa.string() if text else pa.int64()), f"i {kind}, j {kind}, score double")
    if anchors is not None:
        scored = scored.join(anchors.select(F.col("vec_id").alias("i")).distinct(), "i", "left_semi")
    best = _top(scored, "score", k)
    return best.groupBy(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).agg(F.round(F.max("score"), 4).alias("score"))


def evidence(pairs: DataFrame, layer: str) -> DataFrame:
    return pairs.withColumn("evidence", F.concat(F.lit(layer + ":"), F.format_string("%.4f", "score")))


def pair_blocks(*layers: DataFrame) -> DataFrame:
    """(i, j) with the sorted set of all layers' evidence."""
    out = layers[0].select("i", "j", "evidence")
    for x in layers[1:]:
        out = out.unionByName(x.select("i", "j", "evidence"))
    return out.groupBy("i", "j").agg(F.array_join(F.array_sort(F.collect_set("evidence")), "|").alias("evidence"))


def capped(layers: list[DataFrame], most: int) -> DataFrame:
    """The layers' evidence rows (layer, i, j, evidence) up to the one that brings in the most-th distinct pair, in the order of layer, i, j, evidence.

    A feature of its caller's choice: what lies behind the cap is left out.  A pair's first row counts it;
    the row numbers come from sums over ranges of i, so no task orders all rows.
    """
    rows = layers[0].select(F.lit(0).alias("layer"), "i", "j", "evidence")
    for n, x in enumerate(layers[1:], 1):
        rows = rows.unionByName(x.select(F.lit(n).alias("layer"), "i", "j", "evidence"))
    first = rows.groupBy("i", "j").agg(F.min(F.struct("layer", "evidence")).alias("first"))
    cut = first.select("first.layer", "i", "j", "first.evidence").orderBy("layer", "i", "j", "evidence").offset(most - 1).limit(1)
    end = cut.head()
    if end is None:
        return rows
    return rows.where(F.struct("layer", "i", "j", "evidence") <= F.struct(F.lit(end.layer), F.lit(end.i), F.lit(end.j), F.lit(end.evidence)))


def retrieval_profiles(exact: DataFrame, lexical: DataFrame, trigram: DataFrame) -> DataFrame:
    """For each product in some pair: has_exact, its hits by words and trigrams, the best rank and similarity, and how many neighbours these two gave."""
    def both(pairs: DataFrame, layer: str) -> DataFrame:
        score = F.col("score") if "score" in pairs.columns else F.lit(0.0)
        return pairs.select(F.explode(F.array(F.struct(F.col("i").alias("source_id"), F.col("j").alias("other")), F.struct(F.col("j").alias("source_id"), F.col("i").alias("other")))).alias("e"), score.alias("score")).select("e.*", F.lit(layer).alias("layer"), "score")

    rows = both(exact, "exact").unionByName(both(lexical, "lexical")).unionByName(both(trigram, "trigram"))
    of = lambda layer: F.col("layer") == layer
    return rows.groupBy("source_id").agg(
        F.bool_or(of("exact")).alias("has_exact"), F.count_if(of("lexical")).alias("fts_hits"), F.count_if(of("trigram")).alias("trigram_hits"),
        F.max(F.when(of("lexical"), F.col("score")).otherwise(0.0)).alias("max_fts_rank"), F.max(F.when(of("trigram"), F.col("score")).otherwise(0.0)).alias("max_trigram_similarity"),
        F.count_if(~of("exact")).alias("neighbour_rows"))


def gated(p: DataFrame, profiles: DataFrame, require_neighbour: bool = True, min_rank: float = 0.08, min_trigram: float = 0.60) -> DataFrame:
    """source_id and gate of each product: anchor, or why the vector layer skips it."""
    no_signal = F.col("has_exact").isNull()
    lonely = (F.col("neighbour_rows") == 0) if require_neighbour else F.lit(False)
    strong = (F.col("max_fts_rank") >= min_rank) | (F.col("max_trigram_similarity") >= min_trigram) | ((F.col("fts_hits") > 0) & (F.col("trigram_hits") > 0))
    gate = F.when(no_signal, "no_signal").when(F.col("has_exact"), "exact").when(lonely, "no_signal").when(~strong, "weak_signal").otherwise("anchor")
    return p.select("source_id").join(profiles, "source_id", "left").select("source_id", gate.alias("gate"))


def vector_pool(gates: DataFrame, lexical: DataFrame, trigram: DataFrame, profiles: DataFrame, include_neighbours: bool = True) -> DataFrame:
    """vec_id of the products that vectors may find: anchors, and their neighbours without an exact pair."""
    anchors = gates.where("gate = 'anchor'").select("source_id")
    if not include_neighbours:
        return anchors.withColumnRenamed("source_id", "vec_id")
    edges = lexical.select("i", "j").unionByName(trigram.select("i", "j"))
    ways = edges.select(F.col("i").alias("source_id"), F.col("j").alias("vec_id")).unionByName(edges.select(F.col("j").alias("source_id"), F.col("i").alias("vec_id")))
    near = ways.join(anchors, "source_id", "left_semi").select("vec_id").distinct()
    near = near.join(profiles.where("has_exact").select(F.col("source_id").alias("vec_id")), "vec_id", "left_anti")
    return anchors.withColumnRenamed("source_id", "vec_id").unionByName(near).distinct()


def gate_stats(gates: DataFrame, pool: DataFrame) -> DataFrame:
    """(stat, n): the five counters of the vector gate."""
    names = {"no_signal": "skipped_no_signal", "exact": "skipped_exact", "weak_signal": "skipped_weak_signal", "anchor": "anchors"}
    counts = gates.agg(*[F.count_if(F.col("gate") == k).alias(v) for k, v in names.items()]).join(pool.agg(F.count("*").alias("pool")))
    return counts.unpivot([], [*names.values(), "pool"], "stat", "n")


def layer_stats(*layers: tuple[str, DataFrame]) -> DataFrame:
    """(layer, n): the evidence rows of each layer."""
    out = None
    for name, df in layers:
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("layer"), "n")
        out = one if out is None else out.unionByName(one)
    return out

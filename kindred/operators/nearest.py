"""The k best partners of each product, from hits between classes of products.

Products with one text are a class: they ask alike, and are found alike.  A
layer scores classes (q asks, d is found); what follows is the same for words
and trigrams.  Products of q's best level count whole.  Of the lower levels
only ids behind the bound are looked at: whoever asks from ahead of the bound,
the k-th last id of the best level, has k partners in that level.

Work is dealt by q to groups of about GROUP_ROWS askers; a class of more
askers is cut.  No pair is shuffled: each asker's partners end where they are
made.  A pair is (i, j) with i < j; ties go to the smaller j.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from kindred.operators.storage import partitions, written

#: Askers of a group, about.
GROUP_ROWS = 30_000


def key(*texts: Column | str) -> Column:
    """128 bits that stand for texts."""
    return F.unhex(F.md5(F.concat_ws("\u0000", *texts)))


def last_ids(members: DataFrame, k: int, *by: str) -> DataFrame:
    """`last`, the k largest ids of each class, largest first."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("source_id")))
    top = members.select(*by, "source_id").withColumn("rn", rank).where(F.col("rn") <= k)
    return top.groupBy(*by).agg(F.reverse(F.array_sort(F.collect_list("source_id"))).alias("last"))


def _ranked(k: int, own: tuple):
    """Of a group's rows (q, part, id, score; a null score asks): each asker's k best ids behind its own."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table["id"].combine_chunks().dictionary_encode()
        order = pc.sort_indices(ids.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        rank = rank[ids.indices.to_numpy()]
        part = table["part"].to_numpy().astype(np.int64)  # parts of a class may meet in a group
        q = table["q"].combine_chunks().dictionary_encode().indices.to_numpy() * (part.max() + 1) + part
        asks = np.flatnonzero(table["score"].is_null().to_numpy())
        found = np.flatnonzero(table["score"].is_valid().to_numpy())
        score = table["score"].combine_chunks().fill_null(0.0).to_numpy()
        found = found[np.lexsort((rank[found], -score[found], q[found]))]
        left, right = [], []
        if len(found) and len(asks):
            fq, fs = q[found], score[found]
            begins = np.flatnonzero(np.r_[True, (fq[1:] != fq[:-1]) | (fs[1:] != fs[:-1])])  # the levels of each class, best first
            ends, level_q = np.r_[begins[1:], len(found)], fq[begins]
            level = np.repeat(np.arange(len(begins)), ends - begins)
            wide = np.int64(len(order) + 1)
            place = level * wide + rank[found]
            at, stop = np.searchsorted(level_q, q[asks], "left"), np.searchsorted(level_q, q[asks], "right")
            need = np.full(len(asks), k)
            active = np.flatnonzero(at < stop)
            while len(active):
                start = np.searchsorted(place, at[active] * wide + rank[asks[active]], "right")
                n = np.minimum(need[active], ends[at[active]] - start)
                left.append(np.repeat(asks[active], n))
                right.append(np.repeat(start - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()))
                need[active] -= n
                at[active] += 1
                active = active[(need[active] > 0) & (at[active] < stop[active])]
        i = np.concatenate(left) if left else np.zeros(0, np.int64)
        j = found[np.concatenate(right)] if right else np.zeros(0, np.int64)
        out = {"i": table["id"].take(i), "j": table["id"].take(j), "score": pa.array(score[j], pa.float64())}
        for c in own:
            out |= {f"{c}_i": table[c].take(i), f"{c}_j": table[c].take(j)}
        return pa.table(out)

    return run


def best(askers: DataFrame, members: DataFrame, hits: DataFrame, k: int, cut: int = 65_536, own: tuple = ()) -> DataFrame:
    """(i, j, score) of the k best partners j > i of each asker.

    askers (q, source_id, own) ask, members (d, source_id, own) are found,
    hits (q, d, score) tell where.  Columns named in `own` come along for both
    sides, as c_i and c_j.
    """
    spark = askers.sparkSession
    hits = written(hits)
    top = hits.groupBy("q").agg(F.max("score").alias("best"))
    hits = written(hits.join(top, "q"))
    last = hits.where("score = best").select("q", "d").join(last_ids(members, k, "d"), "d")
    bound = last.groupBy("q").agg(F.get(F.reverse(F.array_sort(F.flatten(F.collect_list("last")))), F.lit(k - 1)).alias("bound"))
    sizes = written(askers.groupBy("q").agg(F.count("*").alias("n")))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    hot = F.broadcast(sizes.where(F.col("n") > cut).select("q", F.ceil(F.col("n") / cut).cast("int").alias("parts")))  # at most a row for each `cut` products
    groups = max(partitions(spark), total // GROUP_ROWS + 1)
    wanted = hits.join(bound, "q").join(hot, "q", "left").select("q", "d", "score", F.when(F.col("score") < F.col("best"), F.col("bound")).alias("bound"), F.coalesce("parts", F.lit(1)).alias("parts"))
    found = wanted.join(members, "d").where("bound IS NULL OR source_id > bound")
    found = found.select("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("source_id").alias("id"), "score", *own)
    asked = askers.join(hot, "q", "left").select("q", F.pmod(F.xxhash64("source_id"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"), F.col("source_id").alias("id"), F.lit(None).cast("double").alias("score"), *own)
    rows = asked.unionByName(found).withColumn("bucket", F.pmod(F.xxhash64("q", "part"), F.lit(groups)).cast("int"))
    schema = StructType([StructField("i", StringType()), StructField("j", StringType()), StructField("score", DoubleType()), *[StructField(f"{c}_{s}", askers.schema[c].dataType) for c in own for s in "ij"]])
    pairs = rows.groupBy("bucket").applyInArrow(_ranked(k, own), schema)
    return _once(pairs, askers, k)


def _once(pairs: DataFrame, askers: DataFrame, k: int) -> DataFrame:
    """The pairs; products that repeat an id share their k partners, by an order over their pairs alone."""
    again = written(askers.groupBy("source_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("source_id").alias("i")))
    if not again.head(1):
        return pairs
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score"), "j"))
    some = pairs.join(again, "i", "left_semi").withColumn("rn", rank).where(F.col("rn") <= k).drop("rn")
    return pairs.join(again, "i", "left_anti").unionByName(some)

"""Mixing sources to target weights.

Each source's words are packed into blocks of `block` words: its documents are
laid end to end in a pseudorandom order, by prefix sums over small groups that
are summed in turn, so no source is ever gathered in one task.  The output is
cut into shards of `shard` slots.  Every slot draws its source, which makes the
counts of each shard multinomial; counts are then trimmed and refilled in shard
order until each source has exactly the slots its target needs.  A source's
k-th slot maps to a block through that source's pseudorandom permutation (a
swap-or-not shuffle on its number of blocks, a new one for every pass over it),
and slots meet blocks in a join by index.

Targets: sources by code point, null last, weigh `weights`, repeating; together
they get `share` times all words.  A target stops at `most` times its source's
words and the excess is reshared by weight.  Whole passes take every block; the
last pass takes blocks until the target is met, the last of them in part.

In `report`, tables that grow with the input meet in sort-merge joins alone; in
`mixed` Spark picks the joins, which carry texts, by the sizes it finds.

Defined results.  Null and empty texts have size 0 and are never taken.  Rows
that repeat are laid one after another and are taken each on its own account;
so are rows that tie in all but their text.  A very long text is cut into as
many blocks as it fills.  Further columns, whatever their names, pass through
`mixed` untouched.
The table of sources is as long as the weights' table and is held by the
driver; everything else is distributed.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import materialize, text_of, word_count, words

WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
BLOCK, SHARD, SEED = 256, 8192, 20
ROUNDS, GROUP, SLOTS_A_TASK = 24, 256, 200_000


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words for each source: `share` of all by weight, none over `most` times its size, the excess reshared."""
    total, out, free = share * sum(sizes), [0.0] * len(sizes), [i for i, n in enumerate(sizes) if n]
    while free:
        unit = (total - sum(out)) / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * unit > most * sizes[i]]
        for i in full or free:
            out[i] = most * sizes[i] if full else weights[i] * unit
        free = [i for i in free if i not in full] if full else []
    return out


def permuted(x: Column, n: Column, seed: Column, inverse: bool = False) -> Column:
    """The image of x under a pseudorandom permutation of 0 .. n-1: a swap-or-not shuffle.

    Each round pairs x with k - x (mod n) and swaps them where a hash of the larger says so.
    A round is its own inverse, so the inverse runs the rounds backwards.
    """
    rounds = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)

    def swap(v: Column, r: Column) -> Column:
        k = F.pmod(F.xxhash64(seed, r), n)
        other = F.pmod(k - v, n)
        return F.when(F.xxhash64(seed, r, F.greatest(v, other), F.lit("s")).bitwiseAND(F.lit(1)) == 1, other).otherwise(v)

    return F.aggregate(F.array(*[F.lit(r) for r in rounds]), x.cast("long"), swap)


def _before(df: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """name for each row: the sum of value over the rows of its keys with a smaller order, a number without gaps to speak of.

    Spans of GROUP numbers are summed on their own, then spans of spans: a task gets a
    GROUP-squared part of a key's rows at most, and the last level one row for each such part.
    """
    span, large = F.expr(f"{order} div {GROUP}"), F.expr(f"_span div {GROUP}")
    df = df.withColumn("_span", span)
    small = df.groupBy(*keys, "_span").agg(F.sum(value).alias("_w")).withColumn("_large", large)
    whole = small.groupBy(*keys, "_large").agg(F.sum("_w").alias("_w"))
    frame = lambda k, o: Window.partitionBy(*k).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = whole.select(*keys, "_large", (F.sum("_w").over(frame(keys, "_large")) - F.col("_w")).alias("_b2"))
    small = small.withColumn("_b1", F.sum("_w").over(frame([*keys, "_large"], "_span")) - F.col("_w"))
    small = small.join(whole.hint("merge"), [*keys, "_large"]).select(*keys, "_span", (F.col("_b1") + F.col("_b2")).alias("_b"))
    inner = F.sum(value).over(frame([*keys, "_span"], order)) - F.col(value)
    return df.withColumn("_b0", inner).join(small.hint("merge"), [*keys, "_span"]).withColumn(name, F.col("_b0") + F.col("_b")).drop("_span", "_b", "_b0")


def _offsets(df: DataFrame) -> DataFrame:
    """_start for each row: the words of its source before it, its documents taken by groups of about GROUP and by rank within them."""
    df = df.withColumn("_g", F.pmod(F.xxhash64("_id", F.lit(SEED)), F.greatest(F.lit(1), F.expr(f"n_docs div {GROUP}"))))
    groups = _before(df.groupBy("sid", "_g").agg(F.sum("size").alias("_w")), ["sid"], "_g", "_w", "_before")
    within = Window.partitionBy("sid", "_g").orderBy("_rank", "_id", "size", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn("_b0", F.sum("size").over(within) - F.col("size"))
    return rows.join(groups.select("sid", "_g", "_before").hint("merge"), ["sid", "_g"]).withColumn("_start", F.col("_b0") + F.col("_before")).drop("_g", "_b0", "_before")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: float = MOST,
         block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows, slots).

    rows: a row for each of docs: _id, _tie (a hash of text and source), size, sid, source_size, target, _start.
    slots: shard, slot, sid, pass, block, words (all of the block's, or fewer from its start).
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    sized = materialize(docs.select(F.col(id_col).alias("_id"), _tie(text, F.col(source_col)).alias("_tie"), F.col(source_col).alias("_source"), word_count(text).alias("size")), "mix-sizes")
    stats = sized.groupBy("_source").agg(F.sum("size").alias("words"), F.count("*").alias("docs")).orderBy(F.col("_source").asc_nulls_last()).collect()
    sizes = [r.words for r in stats]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(stats))], share, most)
    want = [round(t) for t in goal]
    blocks = [-(-n // block) for n in sizes]
    whole = [min(t // n, int(most)) if n else 0 for t, n in zip(want, sizes)]
    rest = [t - e * n for t, e, n in zip(want, whole, sizes)]

    def per(values: list, kind: str) -> Column:
        """An array constant by sid."""
        return F.lit(list(values)).cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")

    at = lambda values, kind, i="sid": F.element_at(per(values, kind), F.col(i).cast("int") + 1)
    order = {r._source: i for i, r in enumerate(stats)}
    names = F.lit([s for s in order if s is not None]).cast("array<string>") if any(s is not None for s in order) else F.array().cast("array<string>")
    sid = F.when(F.col("_source").isNull(), F.lit(order.get(None, -1))).otherwise(F.array_position(names, F.col("_source").cast("string")).cast("int") - 1)
    rows = sized.select("_id", "_tie", "size", sid.alias("sid"))
    rows = rows.withColumns({"n_docs": at([r.docs for r in stats], "long"), "_rank": F.xxhash64("_id", F.lit(seed + 1))})
    rows = _offsets(rows).withColumns({"source_size": at(sizes, "long"), "target": at(goal, "double")}).drop("n_docs", "_rank")

    # The rank of each source's short last block in the permutation of its last pass, and so the slots that pass needs.
    ranks = [0] * len(stats)
    if stats:
        last = spark.range(len(stats)).select(F.col("id"), at(blocks, "long", "id").alias("n"), at(whole, "long", "id").alias("e"))
        for r in last.where("n > 0").select("id", permuted(F.col("n") - 1, F.col("n"), F.xxhash64(F.col("id"), F.col("e"), F.lit(seed)), True).alias("p")).collect():
            ranks[r.id] = r.p
    short = [n * block - w for n, w in zip(blocks, sizes)]  # words the last block lacks
    needs = []
    for p, lack, left, e, n in zip(ranks, short, rest, whole, blocks):
        k = -(-left // block)
        if k > p:  # the short block is among them
            k = max(p + 1, -(-(left + lack) // block))
        needs.append(e * n + k)

    total = sum(needs)
    drawn = [x / total for x in needs] if total else []
    upto = [sum(drawn[: i + 1]) for i in range(len(drawn))]
    u = (F.shiftrightunsigned(F.xxhash64(F.col("id"), F.lit(seed)), 11)) / F.lit(float(1 << 53))
    source = F.least(F.size(F.filter(per(upto, "double"), lambda c: c <= u)), F.lit(max(0, len(needs) - 1)))
    draws = spark.range(total).select(F.expr(f"id div {shard}").alias("shard"), source.alias("sid"))
    counts = materialize(draws.groupBy("shard", "sid").agg(F.count("*").alias("n")), "mix-draws")
    got = {r.sid: r.n for r in counts.groupBy("sid").agg(F.sum("n").alias("n")).collect()}
    counts = _before(counts, ["sid"], "shard", "n", "first")
    counts = counts.withColumn("keep", F.greatest(F.lit(0), F.least(F.col("n"), at(needs, "long") - F.col("first"))))
    # Slots over a source's need go, in shard order, to the sources that drew too few.
    gaps, low = [], 0
    for i, x in enumerate(needs):
        if (lack := x - got.get(i, 0)) > 0:
            gaps.append((i, low, low + lack, got.get(i, 0)))
            low += lack
    free = counts.groupBy("shard").agg(F.sum(F.col("n") - F.col("keep")).alias("free")).where("free > 0")
    free = _before(free, [], "shard", "free", "lo")
    table = F.lit([list(g) for g in gaps]).cast("array<array<long>>") if gaps else F.array().cast("array<array<long>>")
    part = F.transform(table, lambda g: F.struct(g[0].cast("int").alias("sid"), F.greatest(F.col("lo"), g[1]).alias("a"), F.least(F.col("lo") + F.col("free"), g[2]).alias("b"), (g[3] - g[1]).alias("by")))
    refill = free.select("shard", F.explode(F.filter(part, lambda x: x["a"] < x["b"])).alias("x")).select("shard", "x.sid", (F.col("x.a") + F.col("x.by")).alias("first"), (F.col("x.b") - F.col("x.a")).alias("keep"))
    taken = counts.select("shard", "sid", "first", "keep").where("keep > 0").unionByName(refill)
    # A row stands for up to a shard of slots: rows are dealt evenly before they are expanded.
    taken = taken.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SLOTS_A_TASK)), "shard", "sid")
    slots = taken.select("shard", "sid", F.explode(F.expr("sequence(first, first + keep - 1)")).alias("k"))
    slots = slots.withColumn("n", at(blocks, "long")).withColumns({"pass": F.expr("k div n"), "rank": F.expr("k % n")})
    slots = slots.withColumn("block", permuted(F.col("rank"), F.col("n"), F.xxhash64(F.col("sid").cast("long"), F.col("pass"), F.lit(seed))))
    length = F.lit(block) - F.when(F.col("block") == F.col("n") - 1, at(short, "long")).otherwise(0)
    before = F.col("rank") * block - F.when(F.col("rank") > at(ranks, "long"), at(short, "long")).otherwise(0)
    some = F.greatest(F.lit(0), F.least(length, at(rest, "long") - before))
    slots = slots.select("shard", "sid", "pass", "block", F.when(F.col("pass") < at(whole, "long"), length).otherwise(some).alias("words"))
    return rows, slots


def spans(docs: DataFrame, block: int = BLOCK, **how) -> DataFrame:
    """What the mix takes of each row in each slot: _id, _tie, shard, pass, and words from_word up to to_word of the text."""
    rows, slots = plan(docs, block=block, **how)
    pieces = _pieces(rows, block)
    return pieces.join(slots.where("words > 0"), ["sid", "block"]).where("words > piece_at").select(
        "_id", "_tie", "size", "sid", "_start", "shard", "pass", "block", "from_word", (F.col("from_word") + F.least(F.col("n"), F.col("words") - F.col("piece_at"))).alias("to_word"))


def _pieces(rows: DataFrame, block: int) -> DataFrame:
    """Each row's words by block: n of them, from word from_word of the text, at piece_at in the block."""
    cut = rows.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(_start div {block}, (_start + size - 1) div {block})")))
    lo, hi = F.greatest(F.col("_start"), F.col("block") * block), F.least(F.col("_start") + F.col("size"), (F.col("block") + 1) * block)
    return cut.withColumns({"from_word": lo - F.col("_start"), "piece_at": lo - F.col("block") * block, "n": hi - lo})


def report(docs: DataFrame, block: int = BLOCK, **how) -> DataFrame:
    """One row for each row of docs: doc_id, size, source_size, target, taken."""
    rows, slots = plan(docs, block=block, **how)
    rows = materialize(rows, "mix-rows")
    used = slots.groupBy("sid", "block").agg(F.collect_list("words").alias("uses"))
    taken = F.aggregate("uses", F.lit(0).cast("long"), lambda a, w: a + F.greatest(F.lit(0), F.least(F.col("n"), w - F.col("piece_at"))))
    # (sid, _start) is a row's own: rows with words never share a start.
    per_row = _pieces(rows, block).join(used.hint("merge"), ["sid", "block"]).groupBy("sid", "_start").agg(F.sum(taken).alias("taken"))
    none = F.lit(0).cast("long")
    shown = lambda df, t: df.select(F.col("_id").alias("doc_id"), "size", "source_size", "target", t.alias("taken"))
    return shown(rows.where("size > 0").join(per_row.hint("merge"), ["sid", "_start"], "left"), F.coalesce("taken", none)).unionByName(shown(rows.where("size = 0"), none))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The mix as rows of docs: for each pass over a row's words, the row with the words that pass takes.

    A pass that takes the whole text leaves it as it is; one that takes parts joins their words
    by single blanks, in the text's order.  n_chars, where docs has it, is set anew.
    """
    got = spans(docs, id_col=id_col, text_col=text_col, **how)
    per_pass = got.groupBy("_id", "_tie", "sid", "_start", "size", "pass").agg(
        F.sum(F.col("to_word") - F.col("from_word")).alias("_taken"), F.array_sort(F.collect_list(F.struct("from_word", "to_word"))).alias("_spans"))
    per_pass = materialize(per_pass.withColumn("_spans", F.when(F.col("_taken") < F.col("size"), F.col("_spans"))), "mix-passes")
    # Rows with one id, text and source are interchangeable: the i-th of them gets the i-th's passes.
    nth = F.dense_rank().over(Window.partitionBy("_id", "_tie").orderBy("_start"))
    per_pass = per_pass.select("_id", "_tie", "_spans", nth.alias("_nth"))
    rows = docs.select(F.struct("*").alias("_row")).withColumns({"_id": F.col(f"_row.`{id_col}`"), "_tie": _tie(F.col(f"_row.`{text_col}`"), F.col(f"_row.`{how.get('source_col', 'source')}`"))})
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_id", "_tie").orderBy("_tie")))
    same = F.col("a._id").eqNullSafe(F.col("b._id")) & (F.col("a._tie") == F.col("b._tie")) & (F.col("a._nth") == F.col("b._nth"))
    both = rows.alias("a").join(per_pass.alias("b"), same).select("a._row", "b._spans")
    text = text_of(F.col(f"_row.`{text_col}`"))
    cut = F.transform(F.array(words(text)), lambda w: F.array_join(F.flatten(F.transform("_spans", lambda s: F.slice(w, (s["from_word"] + 1).cast("int"), (s["to_word"] - s["from_word"]).cast("int")))), " "))[0]
    both = both.withColumn("_new", F.when(F.col("_spans").isNull(), F.col(f"_row.`{text_col}`")).otherwise(cut))
    changed = {text_col: F.col("_new"), "n_chars": F.length("_new").cast("long")}
    return both.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def _tie(text: Column, source: Column) -> Column:
    return F.xxhash64(text_of(text), source)

"""Augmented training rows: variants of labelled offers that stay the same product, and near copies that are another one.

Every choice comes from a hash of (seed, number of the new row, purpose), so
reruns agree at any partitioning.  Base rows are drawn by weight: 1, and 1 more
for each of sku, description and dimension that is there.

Defined results.  A variant that would change the size or the pack count tries
the next mutation, and at last is a plain copy.  Without labelled rows there is
nothing to draw from, which is an error.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred import functions as K
from kindred.sources import RAW

# Fields, words and shares of the mutations.
MUTATIONS = ("mutate_description_light", "mutate_missing_field", "mutate_title_order", "mutate_price_and_retailer", "mutate_identifier_presence", "mutate_brand_case")
FIELDS = ("brand", "description", "specs", "dimension", "img_links", "sku", "price")
SUMMARY = '["Produto original com detalhes resumidos pelo varejista."]'
SHADES = ("Azul", "Rosa", "Vermelho", "Preto", "Bege", "Nude")
START = 500_000


def _u(seed: int, purpose: str) -> Column:
    """A number in [0, 1) for the new row and purpose."""
    return F.pmod(F.xxhash64("n", F.lit(seed), F.lit(purpose)), F.lit(1 << 30)) / float(1 << 30)


def _signature(row: Column) -> Column:
    text = F.concat_ws(" ", row["prod_name"], row["dimension"], row["specs"])
    hit = F.get(K.size_hits(text), F.lit(0))
    return F.struct(hit["value"].alias("size"), hit["unit"].alias("unit"), K.pack_count(K.normalize_text(text)).alias("pack"))


def _with(row: Column, **new: Column) -> Column:
    for name, value in new.items():
        row = row.withField(name, value)
    return row


def _description(row: Column, seed: int) -> Column:
    text = F.replace(F.replace(row["description"], F.lit("COMPRE AGORA"), F.lit("Disponivel para compra")), F.lit("Descubra"), F.lit("Conheca"))
    return _with(row, description=F.when(row["description"] == "", SUMMARY).otherwise(text))


def _missing(row: Column, seed: int) -> Column:
    there = F.filter(F.array(*[F.when(row[f] != "", F.lit(f)) for f in FIELDS]), lambda x: x.isNotNull())
    gone = F.get(there, F.floor(_u(seed, "field") * F.size(there)).cast("int"))
    return _with(row, **{f: F.when(gone == f, "").otherwise(row[f]) for f in FIELDS})


def _title(row: Column, seed: int) -> Column:
    pieces = F.filter(F.transform(F.split(row["prod_name"], "[,|-]"), F.trim), lambda x: x != "")
    shuffled = F.transform(F.array_sort(F.transform(pieces, lambda x, k: F.struct(F.xxhash64("n", F.lit(seed), k).alias("h"), x.alias("x")))), lambda s: s["x"])
    plain = F.trim(F.regexp_replace(F.replace(row["prod_name"], F.lit(" com "), F.lit(" c/ ")), r"\s+", " "))
    return _with(row, prod_name=F.when(F.size(pieces) >= 2, F.array_join(shuffled, " - ")).otherwise(plain))


def _price(row: Column, seed: int) -> Column:
    cents = K.price_cents(F.replace(row["price"], F.lit(","), F.lit(".")))
    price = F.greatest(F.lit(1), F.round(cents * (1 + (_u(seed, "price") * 0.24 - 0.12))).cast("long")).cast("string")
    return _with(row, price=F.when(cents.isNull(), row["price"]).otherwise(price), retailer=F.when(_u(seed, "retailer") < 0.35, F.replace(row["retailer"], F.lit("_"), F.lit("-"))).otherwise(row["retailer"]))


def _sku(row: Column, seed: int) -> Column:
    return _with(row, sku=F.when(_u(seed, "sku") < 0.6, "").otherwise(row["sku"]))


def _brand(row: Column, seed: int) -> Column:
    return _with(row, brand=F.when(_u(seed, "brand") < 0.5, F.upper(row["brand"])).otherwise(F.initcap(row["brand"])))


def augmented(raw: DataFrame, truth: DataFrame, positives: int, negatives: int | None = None, seed: int = 7) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw rows, truth rows, manifest) of the new rows alone; truth has source_id and label."""
    negatives = positives // 5 if negatives is None else negatives
    rows = raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in RAW]).join(truth.select(F.col("source_id").alias("id"), "label"), "id")
    weight = 1 + (F.col("sku") != "").cast("int") + (F.col("description") != "").cast("int") + (F.col("dimension") != "").cast("int")
    pool = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), weight))).withColumn("h", F.xxhash64("id", "copy", F.lit(seed)))
    size = pool.count()
    if not size:
        raise ValueError("no row has a label")
    # The pool's order is needed only as far as rows are drawn: the first positives + negatives of it.
    drawn = min(size, positives + negatives)
    first = pool.orderBy("h", "id", "copy").limit(drawn).withColumn("k", F.row_number().over(Window.orderBy("h", "id", "copy")) - 1)
    spark = raw.sparkSession
    new = spark.range(positives + negatives).withColumnRenamed("id", "n").withColumn("k", F.col("n") % drawn)
    top = lambda t, c: t.agg(F.max(F.when(F.col(c).rlike("^[0-9]{1,15}$"), F.col(c).cast("long")))).head()[0] or 0
    at, label_at = max(START, top(raw, "id") + 1), max(START, top(truth, "label") + 1)
    base = new.join(first, "k").select("n", "label", F.struct(*RAW).alias("row"))
    order = [F.pmod(F.col("n") + i, F.lit(len(MUTATIONS))) for i in range(len(MUTATIONS))]
    made = F.array(*[f(F.col("row"), seed) for f in (_description, _missing, _title, _price, _sku, _brand)])
    good = base.where(F.col("n") < positives).withColumn("made", made).withColumn("was", _signature(F.col("row")))
    tries = F.array(*[F.struct(o.cast("int").alias("m"), F.get("made", o.cast("int")).alias("row")) for o in order])

    def same(t: Column) -> Column:
        now = _signature(t["row"])
        return F.coalesce((F.col("was.size").isNull() | ((now["size"] == F.col("was.size")) & (now["unit"] == F.col("was.unit")))) & (F.col("was.pack").isNull() | (now["pack"] == F.col("was.pack"))), F.lit(False))

    good = good.withColumn("pick", F.get(F.filter(tries, same), F.lit(0)))
    names = F.array(*map(F.lit, MUTATIONS))
    good = good.select("n", "label", F.col("row.id").alias("base"), F.coalesce("pick.row", "row").alias("row"), F.lit("positive_duplicate_variant").alias("kind"), F.coalesce(F.get(names, F.col("pick.m")), F.lit("copy")).alias("augmentation"),
                       F.when(F.col("pick").isNull(), "fallback_exact_copy_after_variant_guard_rejections").otherwise("").alias("detail"))
    r = F.col("row")
    text = F.concat_ws(" ", r["prod_name"], r["dimension"])
    value = F.replace(F.regexp_extract(text, K.SIZE, 1), F.lit(","), F.lit(".")).try_cast("double")
    bigger = F.greatest(F.lit(1.0), F.round(value * F.get(F.array(F.lit(0.5), F.lit(2.0), F.lit(3.0)), F.floor(_u(seed, "size") * 3).cast("int")), 2))
    shown = F.concat(F.when(bigger == F.floor(bigger), F.floor(bigger).cast("string")).otherwise(F.replace(bigger.cast("string"), F.lit("."), F.lit(","))), F.lower(F.regexp_extract(text, K.SIZE, 2)))
    shade = F.get(F.array(*map(F.lit, SHADES)), F.floor(_u(seed, "shade") * len(SHADES)).cast("int"))
    bad = base.where(F.col("n") >= positives).withColumns({"shown": F.when(value.isNotNull(), shown), "shade": shade})
    title = F.when(F.col("shown").isNull(), F.concat_ws(" ", F.nullif(r["prod_name"], F.lit("")), F.lit("Cor"), "shade")).when(r["prod_name"].rlike(K.SIZE), F.regexp_replace(r["prod_name"], K.SIZE, F.col("shown"))).otherwise(F.concat_ws(" ", F.nullif(r["prod_name"], F.lit("")), "shown"))
    sku = F.when(r["sku"] != "", r["sku"]).otherwise(F.concat(F.substring(F.regexp_replace(F.upper(r["brand"]), r"\W+", ""), 1, 8), F.lit("-SHARED")))
    other = _with(r, prod_name=title, dimension=F.coalesce("shown", r["dimension"]), sku=sku)
    other = F.when(_u(seed, "rewrite") < 0.5, _description(other, seed)).otherwise(other)
    bad = bad.select("n", (F.col("n") - positives + label_at).cast("string").alias("label"), F.col("row.id").alias("base"), other.alias("row"), F.lit("hard_negative_dirty_identifier").alias("kind"), F.lit("shared_identifier_variant_conflict").alias("augmentation"),
                     F.coalesce(F.concat(F.lit("size:"), "shown"), F.concat(F.lit("shade:"), "shade")).alias("detail"))
    out = good.unionByName(bad).withColumn("id", (F.col("n") + at).cast("string"))
    rows = out.select("id", *[F.col(f"row.{c}") for c in RAW if c != "id"])
    return rows, out.select(F.col("id").alias("source_id"), "label"), out.select(F.col("id").alias("source_id"), F.col("label").alias("deduped_id"), F.col("base").alias("base_source_id"), F.col("kind").alias("label_type"), "augmentation", "detail")

"""Normalised products of raw rows, their quality flags and exact keys.

Defined results.  Raw nulls count as empty texts.  Repeated rows and repeated
ids give a product each.  Broken JSON is flagged and read as plain text.  Rows
with further columns keep none of them but `label`.  No rows give no products.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred import functions as K
from kindred.functions.json_text import json_text


RAW = {"id": "source_id", "retailer": "retailer", "prod_name": "name_raw", "brand": "brand_raw", "category": "category_raw", "description": "description", "specs": "specs", "url": "url", "price": "_price", "sku": "source_sku", "dimension": "dimension"}


def products(raw: DataFrame) -> DataFrame:
    """The normalised products, by steps that each take a text apart once; JSON alone leaves the JVM."""
    label = F.col("label") if "label" in raw.columns else F.lit(None).cast("string")
    df = raw.select(*[(F.coalesce(F.col(c), F.lit("")) if c in raw.columns else F.lit("")).alias(name) for c, name in RAW.items()], label.alias("label"))
    df = df.withColumns({"_d": json_text("description"), "_s": json_text("specs")})
    host, path = K.url_parts(F.col("url"))
    df = df.withColumns({"_host": host, "_path": path})
    text = {"_name": F.col("name_raw"), "_brand": F.col("brand_raw"), "_category": F.col("category_raw"), "_dimension": F.col("dimension"), "_sku": F.col("source_sku"), "_host": F.col("_host"), "_path": F.col("_path"),
            "_description": F.coalesce("_d.flat", "description"), "_specs": F.coalesce("_s.flat", "specs")}
    df = df.withColumns({k: K.folded(v) for k, v in text.items()})
    df = df.withColumns({"name_norm": K.squeezed(F.col("_name")), "brand_norm": K.compact(K.squeezed(F.col("_brand"))), "description_norm": K.squeezed(F.col("_description")), "specs_text": K.squeezed(F.col("_specs")),
                         "_parts": K.category_path(F.col("_category")), "sku": K.squeezed(F.col("_sku")), "_entries": F.transform("_s.entries", lambda e: F.struct(K.normalize_text(e["k"]).alias("k"), K.normalize_text(e["v"]).alias("v")))})
    full = lambda *c: F.concat_ws(" ", *[F.nullif(x, F.lit("")) for x in c])
    df = df.withColumns({"_attributes": full("name_raw", "dimension", "specs_text", "description_norm"), "_norm": K.squeezed(full("_name", "_dimension", "specs_text", "description_norm"))})
    df = df.withColumns({"_hits": K.size_hits(F.col("_attributes")), "_haystack": F.concat_ws(" ", "source_sku", "url", "_attributes")})
    first = F.get("_hits", F.lit(0))
    distinct = F.size(F.array_distinct(F.transform("_hits", lambda h: F.struct(F.round(h["value"], 2), h["unit"]))))
    return df.select(
        "source_id", "retailer", "source_sku", "url", "name_raw", "brand_raw", "category_raw", "description", "specs", "dimension", "label", "name_norm", "brand_norm", "description_norm", "specs_text",
        F.array_join("_parts", ">").alias("category_norm"), F.coalesce(F.try_element_at("_parts", F.lit(-1)), F.lit("")).alias("category_leaf"), K.price_cents(F.col("_price")).alias("price_cents"),
        K.pack_count(F.col("_norm")).alias("pack_count"), K.model_tokens(F.col("_norm")).alias("model_tokens"), "sku", *[K.identifier(k, F.col("_entries"), F.col("_haystack")).alias(k) for k in K.SPEC_KEYS],
        K.canonical_url(F.col("_host"), F.col("_path")).alias("canonical_url"), F.col("_d.bad").alias("bad_description"), F.col("_s.bad").alias("bad_specs"),
        first["value"].alias("size_value"), first["unit"].alias("size_unit"), (distinct > 1).alias("size_ambiguous"))


def flags() -> Column:
    """The ordered quality flags of a product."""
    flag = lambda name, cond: F.when(cond, F.lit(name))
    return F.array_compact(F.array(
        flag("missing_brand", F.col("brand_norm") == ""), flag("generic_brand", F.col("brand_norm").isin(*K.GENERIC_BRANDS) & (F.col("brand_norm") != "")),
        flag("missing_category", F.col("category_norm") == ""), flag("missing_description", F.col("description_norm") == ""), flag("missing_specs", F.col("specs_text") == ""),
        flag("missing_price", F.col("price_cents").isNull()), flag("suspicious_price", F.col("price_cents") <= 0),
        flag("title_too_short", F.size(F.split("name_norm", " ")) <= 1), flag("invalid_description_json", F.col("bad_description")),
        flag("invalid_specs_json", F.col("bad_specs")), flag("missing_identifier", F.concat("sku", *K.SPEC_KEYS) == "")))


def quality_flags(p: DataFrame) -> DataFrame:
    """source_id and the ordered flags of each product."""
    return p.select("source_id", flags().alias("flags"))


def search_text() -> Column:
    """Brand, first eight telling title words, category leaf and the raw dimension."""
    title = F.array_join(K.informative_tokens(F.col("name_norm"), 8), " ")
    return F.concat_ws(" ", *[F.nullif(x, F.lit("")) for x in (F.col("brand_norm"), title, F.col("category_leaf"), F.col("dimension"))])


def embedding_text() -> Column:
    """What an embedding model gets of a product."""
    return K.embedding_text(brand=F.col("brand_raw"), title=F.col("name_raw"), category=F.col("category_raw"), description=F.col("description_norm"), specs=F.col("specs_text"), dimension=F.col("dimension"))


def _keys() -> Column:
    """A product's exact keys (key_type, key_value): global ids, the retailer's sku, the canonical url."""
    key = lambda t, v: F.struct(t.alias("key_type"), v.alias("key_value"))
    keys = F.array(*[key(F.lit(k), F.col(k)) for k in ("ean", "gtin", "upc", "asin")], key(F.concat(F.lit("retailer_sku:"), "retailer"), F.when(F.col("retailer") != "", F.col("sku")).otherwise("")), key(F.lit("canonical_url"), F.col("canonical_url")))
    return F.filter(keys, lambda k: k["key_value"] != "")


def key_texts() -> Column:
    """A product's exact keys as texts."""
    return F.transform(_keys(), lambda k: F.concat_ws(":", k["key_type"], k["key_value"]))


def exact_keys(p: DataFrame, own: tuple = ()) -> DataFrame:
    """(source_id, key_type, key_value), and the columns named in `own`, for each exact key."""
    return p.select("source_id", *own, F.explode(_keys()).alias("k")).select("source_id", "k.*", *own)

"""Pair features and the rule chain: projections over pairs joined with both sides' products.

What depends on one product alone (its token sets and flags) is computed once
by `profile`; a pair then only intersects arrays.  All but the four string
scores stay in the JVM.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred import functions as K
from kindred.functions.similarity import pair_scores
from kindred.operators.storage import written

# The vocabularies that results depend on.
KIT_MARKERS = ("kit", "combo", "conjunto", "duo", "dupla", "trio")
KIT_COMPONENTS = (
    "ativador", "balm", "condicionador", "creme", "finalizador", "fluido", "gel", "geleia", "leave", "leite", "mascara", "mask",
    "oleo", "oil", "pomada", "protetor", "refil", "serum", "shampoo", "spray", "tonico")
FORMS = (
    "ampola", "batom", "blush", "condicionador", "corretivo", "creme", "deo", "desodorante", "edp", "edt", "gel", "gloss", "hidratante",
    "leave", "locao", "mascara", "mask", "oleo", "parfum", "perfume", "po", "refil", "sabonete", "serum", "shampoo", "spray")
VARIANT_PREFIXES = ("cor", "shade", "tom", "tone", "tono")
PORTUGUESE_COLOURS = (
    "abobora", "amarelo", "ameixa", "areia", "azul", "baunilha", "bege", "bordo", "branco", "bronze", "canela", "caramelo", "castanho",
    "champagne", "chumbo", "ciano", "cinza", "claro", "cobre", "coral", "creme", "dourado", "escuro", "fucsia", "grafite", "laranja",
    "lilas", "loiro", "magenta", "marfim", "marrom", "marsala", "mel", "menta", "natural", "neon", "nude", "oliva", "perola", "pessego",
    "prata", "prateado", "preto", "roxo", "rosa", "rose", "rubi", "salmao", "terracota", "translucido", "turquesa", "uva", "verde",
    "vermelho", "vinho", "violeta")
ENGLISH_COLOURS = (
    "amber", "ash", "auburn", "beige", "black", "blond", "blonde", "blue", "bronze", "brown", "burgundy", "caramel", "champagne",
    "charcoal", "clear", "copper", "coral", "cream", "dark", "deep", "fair", "gold", "golden", "gray", "green", "grey", "honey", "ivory",
    "lavender", "light", "lilac", "medium", "mocha", "natural", "navy", "neutral", "nude", "olive", "orange", "peach", "pearl", "pink",
    "platinum", "purple", "red", "rose", "ruby", "salmon", "sand", "silver", "tan", "taupe", "terracotta", "translucent", "turquoise",
    "violet", "white", "wine", "yellow")
SHADE = r"\b(?:[a-z]{1,3}\d{1,3}[a-z]?|\d{1,3}[a-z]{1,3})\b"
SIZE_LIKE = r"^\d+(?:ml|g|kg|l|oz)?$"
GLOBAL_IDS, IDS = ("ean", "gtin", "upc"), ("ean", "gtin", "upc", "asin", "sku")
#: The order of a model's input.
COLUMNS = (
    "same_retailer", "brand_exact", "brand_fuzzy", "title_token_set", "title_partial", "category_exact", "model_token_jaccard", "salient_token_jaccard",
    "size_match", "size_conflict", "pack_match", "pack_conflict", "price_ratio_diff", "price_both_present", "identifier_any", "exact_global_id",
    "exact_ean", "exact_gtin", "exact_upc", "exact_asin", "exact_retailer_sku", "exact_canonical_url", "exact_key_count", "exact_evidence_strength",
    "exact_sku_same_retailer", "exact_sku_cross_retailer", "rule_certain_match", "rule_strong_match", "rule_likely_match", "rule_certain_block",
    "lexical_sim", "trigram_sim", "semantic_sim", "retrieval_layer_count", "variant_conflict", "variant_token_conflict",
    "variant_token_presence_mismatch", "kit_standalone_conflict", "kit_count_conflict", "kit_component_conflict", "product_form_conflict",
    "weak_exact_contradiction", "contradiction_count", "contradiction_strength", "feature_coverage_count")
COVERAGE = (
    "brand_exact", "exact_global_id", "exact_asin", "exact_retailer_sku", "exact_canonical_url", "size_match", "pack_match",
    "model_token_jaccard", "salient_token_jaccard", "rule_certain_match", "rule_strong_match", "rule_likely_match")
HARD = (
    "size_conflict", "pack_conflict", "variant_token_conflict", "variant_token_presence_mismatch", "kit_standalone_conflict",
    "kit_count_conflict", "kit_component_conflict")


def _tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda t: t != ""))


def _among(tokens: Column, terms: tuple) -> Column:
    return F.array_intersect(tokens, F.array(*map(F.lit, terms)))


def profile(p: DataFrame) -> DataFrame:
    """The products with their salient, variant, component and form tokens and the kit flag."""
    brand = F.when(F.col("brand_raw") != "", K.normalize_text(F.col("brand_raw"))).otherwise(F.col("brand_norm"))
    category = F.coalesce(F.nullif("category_leaf", F.lit("")), F.replace("category_norm", F.lit(">"), F.lit(" ")))
    p = p.withColumns({"_brand": brand, "_dimension": K.normalize_text(F.col("dimension"))})
    known = F.concat(F.split("_brand", " "), F.split(category, " "), F.array(*map(F.lit, K.STOPWORDS)))
    p = p.withColumns({"_title": F.col("name_norm"), "_identity": _tokens(F.concat_ws(" ", "name_norm", "category_leaf", "_dimension"))})
    words = F.split("_title", " ")
    after = F.filter(F.transform(words, lambda w, k: F.when((k > 0) & F.get(words, k - 1).isin(*VARIANT_PREFIXES) & ~w.isin(*K.STOPWORDS), w)), lambda w: w.isNotNull())
    shades = F.filter(F.concat(F.regexp_extract_all("_title", F.lit(SHADE), F.lit(0)), after), lambda w: ~w.rlike(SIZE_LIKE))
    return p.withColumns({
        "salient": F.array_except(F.filter(_tokens(F.col("_title")), lambda t: (F.length(t) > 2) & ~t.rlike(r"\d")), known),
        "variants": F.array_distinct(F.concat(_among(F.col("_identity"), PORTUGUESE_COLOURS + ENGLISH_COLOURS), shades)),
        "parts": _among(F.col("_identity"), KIT_COMPONENTS), "forms": _among(F.col("_identity"), FORMS), "name_tokens": _tokens(F.col("name_norm")),
        "is_kit": F.coalesce(F.col("pack_count") > 1, F.lit(False)) | F.arrays_overlap("_identity", F.array(*map(F.lit, KIT_MARKERS)))
        | (F.contains("name_raw", F.lit("+")) & (F.size(_among(F.col("_identity"), KIT_COMPONENTS)) >= 2)),
    }).drop("_title", "_identity", "_brand", "_dimension")


#: What of a side is a product's own; the rest is shared by its class, the products that agree in all of it.
_OWN = ("retailer", "specs_text", "description_norm", "price_cents", "canonical_url", *IDS)
_SHARED = ("category_norm", "brand_norm", "name_norm", "category_leaf", "model_tokens", "salient", "variants", "parts", "forms", "name_tokens", "is_kit", "size_value", "size_unit", "size_ambiguous", "pack_count")


def sides(pairs: DataFrame, p: DataFrame) -> DataFrame:
    """pairs (i, j, ...) with both profiles as structs l and r, and the string scores s.

    Two equi-joins on the id bring what is a product's own and its class; what
    classes share, and their scores, is looked up once for each pair of
    classes, so no wide row goes along with every pair.
    """
    one = profile(p).select("source_id", *_OWN, *_SHARED)
    one = written(one.withColumn("class", F.unhex(F.md5(F.to_json(F.struct(*_SHARED))))))
    own = lambda k, c: one.select(F.col("source_id").alias(k), *[F.col(x).alias(f"{c}_{x}") for x in ("class", *_OWN)])
    both = pairs.join(own("i", "l"), "i").join(own("j", "r"), "j")
    shared = one.select("class", F.struct(*_SHARED).alias("shared")).dropDuplicates(["class"])
    met = pairs.select("i", "j").join(one.select(F.col("source_id").alias("i"), F.col("class").alias("l_class")), "i").join(one.select(F.col("source_id").alias("j"), F.col("class").alias("r_class")), "j").select("l_class", "r_class").distinct()
    met = met.join(shared.select(F.col("class").alias("l_class"), F.col("shared").alias("a")), "l_class").join(shared.select(F.col("class").alias("r_class"), F.col("shared").alias("b")), "r_class")
    met = written(met.withColumn("s", pair_scores("a.brand_norm", "b.brand_norm", "a.name_norm", "b.name_norm")))
    side = lambda c, x: F.struct(*[F.col(f"{c}_{k}").alias(k) for k in _OWN], *[F.col(f"{x}.{k}").alias(k) for k in _SHARED])
    whole = both.join(met, ["l_class", "r_class"])
    return whole.select(*pairs.columns, side("l", "a").alias("l"), side("r", "b").alias("r"), "s")


def apart(df: DataFrame) -> DataFrame:
    """df as it is, its columns computed once: later projections refer to them and are not merged with what made them."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _l(name: str) -> Column:
    return F.col(f"l.{name}")


def _r(name: str) -> Column:
    return F.col(f"r.{name}")


def _known(name: str) -> Column:
    return _l(name).isNotNull() & _r(name).isNotNull()


def _same(name: str) -> Column:
    """Equal and not empty."""
    return F.coalesce((_l(name) != "") & (_l(name) == _r(name)), F.lit(False))


def _any(*conditions: Column) -> Column:
    return reduce(lambda x, y: x | y, conditions)


def sizes_equivalent() -> Column:
    """Both sizes known, of one unit, not 0 and within 8 % (ml, g) or 5 %, or 1 unit."""
    a, b = _l("size_value"), _r("size_value")
    rel = F.when(_l("size_unit").isin("ml", "g"), 0.08).otherwise(0.05)
    return F.coalesce((_l("size_unit") == _r("size_unit")) & (a != 0) & (b != 0) & (F.abs(a - b) <= F.greatest(rel * F.greatest(F.abs(a), F.abs(b)), F.lit(1.0))), F.lit(False))


def rule() -> Column:
    """Struct (certainty, reason) of the first rule that holds, over the columns of `sides`."""
    unit = _known("size_value") & F.coalesce(_l("size_unit") == _r("size_unit"), F.lit(False))
    brand, title = _same("brand_norm"), F.col("s.title_token_set")
    strong = lambda side: ~side("brand_norm").isin(*K.GENERIC_BRANDS)
    models = F.arrays_overlap("l.model_tokens", "r.model_tokens")
    absent = (F.size("l.model_tokens") == 0) | (F.size("r.model_tokens") == 0)
    packs = _known("pack_count") & (_l("pack_count") != _r("pack_count"))
    chain = [("CERTAIN_BLOCK", f"conflicting_global_id:{k}", (_l(k) != "") & (_r(k) != "") & (_l(k) != _r(k))) for k in GLOBAL_IDS]
    chain += [
        ("CERTAIN_BLOCK", "conflicting_strong_brand", strong(_l) & strong(_r) & (_l("brand_norm") != _r("brand_norm")) & (F.col("s.brand_set") < 0.88)),
        ("CERTAIN_BLOCK", "conflicting_unambiguous_size", unit & ~_l("size_ambiguous") & ~_r("size_ambiguous") & ~sizes_equivalent()),
        ("CERTAIN_BLOCK", "conflicting_pack_count", packs)]
    chain += [("CERTAIN_MATCH", f"exact_global_id:{k}", _same(k)) for k in GLOBAL_IDS]
    chain += [
        ("CERTAIN_MATCH", "exact_asin", _same("asin")),
        ("CERTAIN_MATCH", "exact_canonical_url", _same("canonical_url")),
        ("STRONG_MATCH", "same_retailer_sku", _same("retailer") & _same("sku")),
        ("STRONG_MATCH", "brand_title95_model_overlap", brand & (title >= 0.95) & models),
        ("STRONG_MATCH", "brand_title97_no_model", brand & (title >= 0.97) & absent),
        ("LIKELY_MATCH", "brand_title85_size_match", brand & (title >= 0.85) & sizes_equivalent() & ~packs),
        ("LIKELY_MATCH", "brand_model_overlap_title70", brand & models & (title >= 0.70))]
    out = None
    for certainty, reason, holds in chain:
        value = F.struct(F.lit(certainty).alias("certainty"), F.lit(reason).alias("reason"))
        out = F.when(holds, value) if out is None else out.when(holds, value)
    return out.otherwise(F.struct(F.lit("UNCERTAIN").alias("certainty"), F.lit("uncertain").alias("reason")))


def _jaccard(a: str, b: str, empty: float) -> Column:
    return F.when((F.size(a) == 0) & (F.size(b) == 0), empty).otherwise(K.jaccard(F.col(a), F.col(b)))


def retrieval() -> dict[str, Column]:
    """exact_hit, lexical_sim, trigram_sim and vector_sim from parts_, the list of a pair's evidence; a layer's value that is no number counts as its default."""
    def layer(prefix: str, default: float) -> Column:
        values = F.transform(F.filter("parts_", lambda e: e.startswith(prefix)), lambda e: F.coalesce(F.element_at(F.split(e, ":"), -1).try_cast("double"), F.lit(default)))
        return F.coalesce(F.array_max(values), F.lit(0.0))

    # The prefixes, their defaults and the lexical factor.
    return {"exact_hit": F.exists("parts_", lambda e: e.startswith("exact:")).cast("double"), "lexical_sim": F.least(F.lit(1.0), 1.4 * layer("lexical:fts:", 0.70)),
            "trigram_sim": F.least(F.lit(1.0), layer("trigram:title:", 0.45)), "vector_sim": F.least(F.lit(1.0), layer("vector:cosine:", 0.78))}


def pair_features(pairs: DataFrame, p: DataFrame, keep: bool = False) -> DataFrame:
    """i, j, certainty, reason and the 45 features of pairs (i, j, evidence).

    evidence is the text of `pair_blocks`, parts joined by |.  A column named
    semantic_sim gives the vectors' cosine; it counts as 0 where it is absent.
    With `keep`, evidence, the retrieval values, both sides and their string scores stay.
    """
    semantic = F.nanvl(F.coalesce(F.col("semantic_sim"), F.lit(0.0)), F.lit(0.0)) if "semantic_sim" in pairs.columns else F.lit(0.0)
    df = sides(pairs, p).withColumns({"rule": rule(), "semantic_sim": F.greatest(F.lit(0.0), F.least(F.lit(1.0), semantic)), "parts_": F.split("evidence", r"\|")})
    df = df.withColumns({"types": F.array_distinct(F.transform(F.filter("parts_", lambda e: e.rlike("^exact:[^:]*:")), lambda e: F.get(F.split(e, ":"), F.lit(1)))), **retrieval()})

    shared, retailer, brand = {k: _same(k) for k in IDS}, _l("retailer") == _r("retailer"), _same("brand_norm")
    has = lambda *ts: F.arrays_overlap("types", F.array(*map(F.lit, ts)))
    sku = F.exists("types", lambda t: t.startswith("retailer_sku"))
    size = _known("size_value") & F.coalesce(_l("size_unit") == _r("size_unit"), F.lit(False))
    pack, packs = _known("pack_count"), F.coalesce(_l("pack_count") == _r("pack_count"), F.lit(False))
    priced = F.coalesce((_l("price_cents") > 0) & (_r("price_cents") > 0), F.lit(False))
    some = lambda name: (F.size(f"l.{name}") > 0) & (F.size(f"r.{name}") > 0)
    apart = lambda name: some(name) & ~F.arrays_overlap(f"l.{name}", f"r.{name}")
    identifier, smaller = _any(*shared.values()), F.least(F.size("l.name_tokens"), F.size("r.name_tokens"))
    contained = F.coalesce((smaller > 0) & (F.size(F.array_intersect("l.name_tokens", "r.name_tokens")) >= 0.8 * smaller), F.lit(False))
    kin, kits = brand | identifier, _l("is_kit") & _r("is_kit")
    conflict = {
        "variant_conflict": (_l("brand_norm") == _r("brand_norm")) & apart("salient"),
        "variant_token_conflict": kin & apart("variants"),
        "variant_token_presence_mismatch": kin & ((F.size("l.variants") > 0) != (F.size("r.variants") > 0)) & contained,
        "kit_standalone_conflict": (_l("is_kit") != _r("is_kit")) & ((F.size("l.parts") > 0) | (F.size("r.parts") > 0)),
        "kit_count_conflict": kits & pack & ~packs,
        "kit_component_conflict": kits & apart("parts"),
        "product_form_conflict": ~_l("is_kit") & ~_r("is_kit") & apart("forms")}
    weak = _any(*[conflict[k] for k in HARD[2:]], conflict["product_form_conflict"] & conflict["variant_conflict"])
    conflict["weak_exact_contradiction"] = identifier & weak
    # Each group of columns is projected before the next one refers to it.
    df = df.withColumns({k: v.cast("double") for k, v in conflict.items()} | {
        "same_retailer": retailer.cast("double"), "brand_exact": brand.cast("double"), "category_exact": _same("category_leaf").cast("double"),
        "brand_fuzzy": F.col("s.brand_fuzzy"), "title_token_set": F.col("s.title_token_set"), "title_partial": F.col("s.title_partial"),
        "model_token_jaccard": _jaccard("l.model_tokens", "r.model_tokens", 0.4), "salient_token_jaccard": _jaccard("l.salient", "r.salient", 0.45),
        "size_match": sizes_equivalent().cast("double"), "size_conflict": (size & ~sizes_equivalent()).cast("double"),
        "pack_match": (pack & packs).cast("double"), "pack_conflict": (pack & ~packs).cast("double"),
        "price_both_present": priced.cast("double"),
        "price_ratio_diff": F.when(priced, F.abs(_l("price_cents") - _r("price_cents")) / F.greatest(_l("price_cents"), _r("price_cents"))).otherwise(1.0),
        "identifier_any": (identifier | (F.size("types") > 0)).cast("double"), "exact_global_id": has(*GLOBAL_IDS).cast("double"),
        "exact_ean": shared["ean"].cast("double"), "exact_gtin": shared["gtin"].cast("double"), "exact_upc": shared["upc"].cast("double"),
        "exact_asin": (shared["asin"] | has("asin")).cast("double"), "exact_retailer_sku": sku.cast("double"), "exact_canonical_url": has("canonical_url").cast("double"),
        "exact_key_count": F.size("types").cast("double"),
        "exact_evidence_strength": F.when(has(*GLOBAL_IDS), 1.0).when(has("asin"), 0.92).when(sku, 0.88).when(has("canonical_url"), 0.86).otherwise(0.0),
        "exact_sku_same_retailer": ((shared["sku"] & retailer) | sku).cast("double"), "exact_sku_cross_retailer": (shared["sku"] & ~retailer).cast("double"),
        "retrieval_layer_count": (identifier.cast("int") + (F.col("lexical_sim") > 0).cast("int") + (F.col("trigram_sim") > 0).cast("int") + (F.col("semantic_sim") > 0).cast("int")).cast("double"),
    } | {f"rule_{k}": (F.col("rule.certainty") == k.upper()).cast("double") for k in ("certain_match", "strong_match", "likely_match", "certain_block")})
    df = df.withColumns({
        "contradiction_count": reduce(lambda a, b: a + b, (F.col(k) for k in conflict)), "contradiction_strength": F.greatest(*conflict),
        "feature_coverage_count": reduce(lambda a, b: a + b, ((F.col(k) > 0).cast("double") for k in COVERAGE))})
    return df.select("i", "j", "rule.certainty", "rule.reason", *COLUMNS, *(["evidence", "exact_hit", "vector_sim", "l", "r", "s"] if keep else []))


def hard_contradiction() -> Column:
    """Whether a pair's features forbid a merge whatever else agrees."""
    return _any(*[F.col(k) >= 1 for k in HARD])

import random
from itertools import combinations, permutations

import numpy as np
from pyspark.sql import functions as F

from kindred.functions.rank import density
from kindred.operators import candidates as C
from kindred.operators.products import exact_keys, products, quality_flags, search_text
from kindred.sources import offers


def test_every_supplier_part_pair_is_an_offer(spark, tmp_path):
    pairs = [(p, s) for p in range(1, 8) for s in range(1, 5)]
    spark.createDataFrame(pairs + pairs[:5], "l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(p, "blue tin", "SMALL BOX", 7, "Brand#1", 9.5) for p in range(1, 8)], "p_partkey long, p_name string, p_type string, p_size int, p_brand string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(s, f"s{s}") for s in range(1, 5)], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    assert sorted(r.id for r in offers(spark, str(tmp_path)).collect()) == sorted(str(p * 100000 + s) for p, s in pairs)


def test_products_of_odd_rows(spark, offers_of):
    rows = [
        {"id": "1", "prod_name": "Óleo de Coco 30ml", "brand": "Coco & Cia", "category": "Beleza > Óleos", "specs": '{"Código EAN": "789", "Cor": {"tom": "Azul"}}', "description": "{broken", "price": "10", "sku": "A-1", "url": "https://www.loja.com/oleo-de-coco-puro/", "retailer": "Loja", "dimension": "30 ml"},
        {"id": "2", "prod_name": "Base", "price": "-1", "specs": "[1"}, {"id": "2", "prod_name": None, "description": "ASIN b0ABCDEF12 e 1234567890123"}]
    p = products(offers_of(*rows).withColumn("_name", F.lit("clash")))
    got = sorted((r.asDict() for r in p.collect()), key=lambda r: (r["source_id"], r["name_norm"]))
    one, three, two = got
    assert (one["name_norm"], one["brand_norm"], one["category_norm"], one["category_leaf"]) == ("oleo de coco 30ml", "cocoecia", "beleza>oleos", "oleos")
    assert (one["ean"], one["sku"], one["specs_text"], one["size_value"], one["size_ambiguous"], one["canonical_url"]) == ("789", "a 1", "codigo ean 789 cor tom azul", 30.0, False, "loja/com/oleo/de/coco/puro")
    assert (three["asin"], three["ean"], three["name_norm"]) == ("b0abcdef12", "1234567890123", "") and two["label"] is None
    flags = {(r.source_id, tuple(r.flags)) for r in quality_flags(p).collect()}
    assert ("2", ("missing_brand", "missing_category", "missing_description", "suspicious_price", "title_too_short", "invalid_specs_json", "missing_identifier")) in flags
    assert ("1", ("invalid_description_json",)) in flags
    keys = {tuple(r) for r in exact_keys(p.where("source_id = '1'")).collect()}
    assert keys == {("1", "ean", "789"), ("1", "retailer_sku:Loja", "a 1"), ("1", "canonical_url", "loja/com/oleo/de/coco/puro")}
    assert p.where("source_id = '1'").select(search_text().alias("t")).head().t == "cocoecia oleo coco 30ml oleos 30 ml"
    assert products(offers_of(*rows).limit(0)).count() == 0


def grams(text):
    return {f"  {w} "[k:k + 3] for w in text.split() for k in range(len(w) + 1)}


def test_trigram_pairs_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_TITLES", 3)  # several blocks in a brand, and titles that are cut up
    monkeypatch.setattr(C, "TITLE_IDS", 5)
    rng = random.Random(7)
    names = [" ".join(rng.choices(("azul", "verde", "creme", "gel", "hidratante"), k=rng.randint(1, 5))) for _ in range(14)] + ["%"]
    rows = [(f"{k:03d}", rng.choice(("x", "y", "")), rng.choice(names)) for k in range(150)]
    p = spark.createDataFrame(rows, "source_id string, brand_norm string, name_norm string")
    best = {}
    for (i, b, m), (j, c, n) in combinations(rows, 2):
        if b == c != "" and "%" not in (m, n):
            both = len(grams(m) & grams(n)) / len(grams(m) | grams(n))
            if both >= 0.55 and abs(len(m) - len(n)) <= 24:
                best.setdefault(i, []).append((-both, j))
    want = {(i, j, round(-s + 1e-12, 4)) for i, x in best.items() for s, j in sorted(x)[:4]}
    assert {(r.i, r.j, r.score) for r in C.trigram_pairs(p, k=4).collect()} == want
    again = p.unionByName(p.where("source_id = '007'"))  # a repeated id is paired with others, never with itself
    assert C.trigram_pairs(again, k=4).where("i = j").count() == 0 and C.trigram_pairs(p, max_block=10).count() == 0


def test_lexical_pairs_against_all_pairs(spark):
    rows = [
        ("a", "x", "oleo de coco para cabelo 30 ml", "casa>oleo", "oleo", "30ml", "", ""), ("b", "x", "oleo coco cabelo seco 30ml", "casa>oleo", "oleo", "30ml", "", ""),
        ("c", "x", "oleo coco", "casa>oleo", "oleo", "30ml", "tamanho 30ml", "para cabelo"), ("d", "x", "um dois tres quatro cinco seis sete oito nove dez onze", "casa>oleo", "oleo", "", "", ""),
        ("e", "x", "dois tres quatro cinco seis sete oito nove dez um", "casa>oleo", "oleo", "", "", ""), ("f", "x", "oleo coco cabelo 30ml", "casa>oleo", "oleo", "30ml", "", ""),
        ("g", "y", "oleo coco cabelo 30ml", "casa>oleo", "oleo", "30ml", "", ""), ("h", "", "oleo coco cabelo 30ml", "casa>oleo", "oleo", "30ml", "", ""), ("i", "x", "oleo coco cabelo 30ml", "casa>oleo", "oleo", "30ml", "", "")]
    p = spark.createDataFrame(rows, "source_id string, brand_norm string, name_norm string, category_norm string, category_leaf string, dimension string, specs_text string, description_norm string")
    stop = {"a", "as", "com", "da", "das", "de", "do", "dos", "e", "em", "for", "of", "o", "os", "para", "the", "with"}
    query = lambda r: {r[1], *[t for t in r[2].split() if len(t) > 2 and t not in stop][:8], r[4], r[5]} - {""}
    document = lambda r: "\n".join((r[1], r[2], r[3].replace(">", " "), r[6], r[7]))
    want = {}
    for m, n in permutations(rows, 2):
        if m[0] < n[0] and m[1] == n[1] != "" and query(m) <= set(document(n).split()):
            want.setdefault(m[0], []).append((-density(sorted(query(m)), document(n)), n[0]))
    want = {(i, j, round(-s, 4)) for i, x in want.items() for s, j in sorted(x)[:2]}
    assert {x[:2] for x in want} >= {("a", "f"), ("d", "e")}
    assert {(r.i, r.j, r.score) for r in C.lexical_pairs(p, k=2).collect()} == want
    assert {("a", "b"), ("a", "c"), ("a", "f")} <= {(r.i, r.j) for r in C.lexical_pairs(p).collect()}


def test_vector_pairs_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 40)  # several blocks
    m = np.random.default_rng(5).normal(size=(150, 6)).astype("float32")
    m[100:130] = m[3]  # copies: more than k ties
    m[140] = 0
    rows = [(k, [float(x) for x in m[k]]) for k in range(150)] + [(150, None)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    d = m.astype("float64")
    with np.errstate(invalid="ignore"):
        s = ((d @ d.T) / np.outer(np.linalg.norm(d, axis=1), np.linalg.norm(d, axis=1))).round(12)
    want = {}
    for i in range(150):
        near = sorted((-s[i, j], j) for j in range(150) if j != i and s[i, j] >= 0.3)[:5]
        want |= {(min(i, j), max(i, j)): round(-x, 4) for x, j in near}
    got = {(r.i, r.j): r.score for r in C.vector_pairs(v, k=5, least=0.3).collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    few = spark.createDataFrame([(k,) for k in range(5)], "vec_id long")
    some = C.vector_pairs(v.withColumn("vec_id", F.col("vec_id").cast("string")), k=5, least=-1.0, anchors=few, pool=spark.createDataFrame([(k,) for k in range(10)], "vec_id long"))
    assert {x for r in some.collect() for x in (r.i, r.j)} <= {str(k) for k in range(10)}


def test_gate_profiles_and_cap(spark):
    pairs = lambda *rows: spark.createDataFrame(rows, "i string, j string, score double")
    exact = spark.createDataFrame([("a", "b", "exact:ean:1")], "i string, j string, evidence string")
    lexical, trigram = pairs(("b", "c", 0.05), ("c", "d", 0.05), ("e", "f", 0.09)), pairs(("c", "d", 0.56), ("f", "g", 0.57), ("h", "i", 0.61))
    profiles = C.retrieval_profiles(exact, lexical, trigram)
    p = spark.createDataFrame([(x,) for x in "abcdefghij"], "source_id string")
    gates = C.gated(p, profiles)
    assert {r.source_id: r.gate for r in gates.collect()} == {"a": "exact", "b": "exact", "c": "anchor", "d": "anchor", "e": "anchor", "f": "anchor", "g": "weak_signal", "h": "anchor", "i": "anchor", "j": "no_signal"}
    pool = C.vector_pool(gates, lexical, trigram, profiles)
    assert {r.vec_id for r in pool.collect()} == set("cdefghi")
    assert {r.stat: r.n for r in C.gate_stats(gates, pool).collect()} == {"skipped_no_signal": 1, "skipped_exact": 2, "skipped_weak_signal": 1, "anchors": 6, "pool": 7}
    layers = [exact, C.evidence(lexical, "lexical:fts"), C.evidence(trigram, "trigram:title")]
    assert [(r.layer, r.i, r.j) for r in C.capped(layers, 3).orderBy("layer", "i").collect()] == [(0, "a", "b"), (1, "b", "c"), (1, "c", "d")]
    assert C.capped(layers, 99).count() == 7
    assert {(r.i, r.j): r.evidence for r in C.pair_blocks(*layers).collect()}["c", "d"] == "lexical:fts:0.0500|trigram:title:0.5600"

"""Work that must not grow with copies, and steps that must not be left out."""

import json
import random

import pytest
from pyspark.sql import functions as F

from kindred.operators import candidates as C
from kindred.operators import clusters, nearest
from kindred.operators.products import products
from kindred.plans.queries import QUERIES
from kindred.sources import offers


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(p, s) for p in range(1, 9) for s in range(1, 13)], "l_partkey long, l_suppkey long").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(p, ("blue tin", "red tin")[p % 2], "SMALL BOX", 7 + p // 5, "Brand#1", 9.5) for p in range(1, 9)], "p_partkey long, p_name string, p_type string, p_size int, p_brand string, p_retailprice double").write.parquet(f"{d}/part.parquet")
    spark.createDataFrame([(s, f"s{s}") for s in range(1, 13)], "s_suppkey long, s_name string").write.parquet(f"{d}/supplier.parquet")
    return d


def test_profiles_have_hits_by_words(spark, tables):
    got = QUERIES["retrieval_profiles"](spark, tables).agg(F.sum("fts_hits"), F.max("max_fts_rank")).head()
    want = C.lexical_pairs(products(offers(spark, tables))).agg(F.count("*"), F.max("score")).head()
    assert want[0] > 0 and tuple(got) == (2 * want[0], want[1])


def test_summary_is_whole(spark, tables):
    rows = {r.name: r.value for r in QUERIES["run_summary"](spark, tables).collect()}
    assert int(rows["candidate_pairs_scored"]) == QUERIES["pair_merge"](spark, tables).count() > 0
    flags = {r["flag"]: r["n"] for r in json.loads(rows["top_quality_flags"])}
    assert flags["missing_description"] == 96 and {r["layer"] for r in json.loads(rows["blocking"])} == {"exact", "lexical", "trigram", "vector"}
    assert {"threshold_sensitivity", "ml_threshold_sensitivity", "confidence_distribution", "ml_score_distribution", "decision_reason_counts", "largest_groups", "lowest_confidence_accepted_merges"} <= rows.keys()


@pytest.mark.parametrize("cut", [7, 1000])
def test_best_against_all(spark, cut):
    rng = random.Random(11)
    ask, members = [(rng.choice("abc"), f"{k:03d}") for k in range(90)], [(rng.choice("uvwxy"), f"{k:03d}") for k in range(90)]
    hits = [(q, d, rng.choice((1.0, 0.5, 0.25))) for q in "abc" for d in "uvwxy" if rng.random() < 0.8]
    scores, want = {(q, d): s for q, d, s in hits}, set()
    for q, i in ask:
        near = sorted((-scores[q, d], j) for d, j in members if (q, d) in scores and j > i)[:4]
        want |= {(i, j, -s) for s, j in near}
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = nearest.best(frame([(q.encode(), i, i) for q, i in ask], "q binary, source_id string, tag string"), frame([(d.encode(), j, j) for d, j in members], "d binary, source_id string, tag string"),
                       frame([(q.encode(), d.encode(), s) for q, d, s in hits], "q binary, d binary, score double"), 4, cut, ("tag",)).collect()
    assert {(r.i, r.j, r.score) for r in got} == want and len(got) == len(want) and all((r.i, r.j) == (r.tag_i, r.tag_j) for r in got)


def test_documents_that_differ_in_what_nobody_asks_are_one(spark):
    rows = [("x", f"x\nazul gel\ncasa\nean {k}") for k in range(50)] + [("x", "x\nazul novo gel\ncasa\nean 1")]
    told = C._asked(spark.createDataFrame(rows, "brand_norm string, y string"), spark.createDataFrame([("x", "azul"), ("x", "gel"), ("y", "casa")], "brand_norm string, word string"))
    assert {r.told for r in told.select("told").distinct().collect()} == {"\n - azul gel", "\n - azul - gel"}


def test_links_connect_what_pairs_connect(spark, tables):
    p = products(offers(spark, tables))
    links = C.exact_links(p)
    whole = {tuple(r) for r in clusters.components(C.exact_pairs(p)).collect()}
    assert {tuple(r) for r in clusters.components(links).collect()} == whole and links.count() < C.exact_pairs(p).count()


def test_components_of_a_chain(spark):
    got = clusters.components(spark.createDataFrame([(f"{k:03d}", f"{k + 1:03d}") for k in range(60)], "i string, j string")).collect()
    assert len(got) == 61 and {r.root for r in got} == {"000"}

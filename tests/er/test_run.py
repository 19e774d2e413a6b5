import json

from pyspark.sql import functions as F

from kindred import caches, cli
from kindred.operators import augment, embeddings
from kindred.operators.products import products
from kindred.pipeline import Config, run
from kindred.sources import read_csv

HEAD = "id,prod_name,brand,category,description,specs,img_links,url,created_at,updated_at,retailer,price,sku,dimension\n"


def lines(n):
    return "".join(f'{k},"Oleo {"azul" if k % 2 else "verde"} de coco {100 * (k % 3 + 1)}ml",Marca,Casa > Oleo,"linha\n""dois""","{{""EAN"": ""78900000000{k // 2:02d}""}}",,,,,loja{k % 2},{1000 + k},S{k // 2},{100 * (k % 3 + 1)}ml\n' for k in range(n))


def test_csv_of_odd_lines(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text("﻿id,prod_name,more\n1,\"a\n\"\"b\"\"\",x\n2,,y,ragged\n3\n", encoding="utf-8")
    rows = {r.id: r for r in read_csv(spark, str(f)).collect()}
    assert rows["1"].prod_name == 'a\n"b"' and rows["2"].prod_name == rows["3"].prod_name == rows["3"].sku == "" and len(rows) == 3
    assert read_csv(spark, str(f), limit=2).count() == 2


def test_a_run_and_its_commands(spark, tmp_path, capsys):
    f, folder, truth = tmp_path / "in.csv", str(tmp_path / "run"), tmp_path / "truth.csv"
    f.write_text(HEAD + lines(8))
    truth.write_text("source_id,deduped_id\n" + "".join(f"{k},{k // 2}\n" for k in range(8)))
    cache = caches.StageCache(spark, str(tmp_path / "stages"))
    first = run(spark, str(f), folder, Config(max_block=None), cache)
    again = run(spark, str(f), folder, Config(max_block=None), cache)
    assert not any(s["used"] for s in first["caches"].values()) or first["caches"] is again["caches"]
    assert all(s["used"] for s in again["caches"].values()) and {k: v for k, v in first.items() if k[:6] == "merged"} == {k: v for k, v in again.items() if k[:6] == "merged"}
    assert first["input_records"] == "8"
    changed = run(spark, str(f), folder, Config(max_block=None, near_miss=0.1), cache)
    assert changed["caches"]["normalization"]["used"] and not changed["caches"]["scoring"]["used"]
    capsys.readouterr()
    assert cli.main(["search", folder, "oleo azul"], spark) == 0 and len(json.loads(capsys.readouterr().out)) == 8
    assert cli.main(["index", folder], spark) == 0 and cli.main(["search-index", folder, "oleo", "--type", "group"], spark) == 0
    assert cli.main(["group", folder, "none"], spark) == 1 and cli.main(["explain", folder, "0", "1"], spark) == 0
    assert cli.main(["evaluate", folder, str(truth), "--min-recall", "1.1"], spark) == 1
    assert cli.main(["augment", str(f), str(truth), str(tmp_path / "more"), "--positives", "5"], spark) == 0


def test_cache_keys():
    assert caches.stable_key({"a": 1, "b": 2}) == caches.stable_key({"b": 2, "a": 1}) != caches.stable_key({"a": 1})
    assert [caches.enabled(x) for x in (None, " On", "0", "no")] == [True, True, False, False]
    assert cli.optional_int("uncapped") is None and cli.optional_int("5") == 5


def test_embeddings(spark, offers_of):
    p = products(offers_of({"id": "a", "prod_name": "oleo de coco"}, {"id": "b", "prod_name": "oleo de coco!"}, {"id": "c", "prod_name": "tinta"}))
    v = embeddings.embed(p)
    got = {r.vec_id: r for r in v.collect()}
    assert {len(r.embedding) for r in got.values()} == {256} and abs(sum(x * x for x in got["a"].embedding) - 1) < 1e-5
    old = v.where("vec_id = 'a'").withColumn("embedding", F.transform("embedding", lambda x: (x * 0 + 1).cast("float")))
    new = {r.vec_id: r.embedding[0] for r in embeddings.embed(p, old).collect()}
    assert new["a"] == 1.0 and set(new) == {"a", "b", "c"}
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "zz")], "i string, j string")
    sims = {r.j: r.semantic_sim for r in embeddings.semantic_similarity(pairs, v).collect()}
    assert sims["b"] > 0.8 > sims["c"] and sims["zz"] == 0
    texts = spark.createDataFrame([("[1, 2.5]",), ("x",), (None,)], "v string").select(embeddings.parse_vector(F.col("v")).alias("r")).collect()
    assert [r.r for r in texts] == [[1.0, 2.5], [], []]
    zero = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 0.0]), (None, [1.0])], "a array<double>, b array<double>").select(embeddings.cosine(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r.r for r in zero] == [0.0, 0.0, 0.0]


def test_augmented_rows_keep_or_change_the_variant(spark, offers_of):
    rows = offers_of(*[{"id": str(k), "prod_name": f"Base - azul {k}0ml, un", "brand": "marca", "price": "100", "retailer": "a_b", "dimension": f"{k}0ml", "sku": "" if k % 2 else "s"} for k in range(1, 7)], {"id": "9", "prod_name": "Batom", "brand": "m"})
    truth = spark.createDataFrame([(str(k), f"L{k}") for k in (1, 2, 3, 4, 5, 6, 9)], "source_id string, label string")
    new, labels, manifest = augment.augmented(rows, truth, 30, 10)
    assert new.count() == labels.count() == manifest.count() == 40 and new.collect() == augment.augmented(rows, truth, 30, 10)[0].collect()
    base = {r.source_id: r for r in products(rows).collect()}
    made = {r.source_id: r for r in products(new).collect()}
    label = {r.source_id: r.label for r in labels.collect()}
    for m in manifest.collect():
        a, b = base[m.base_source_id], made[m.source_id]
        if m.label_type == "positive_duplicate_variant":
            assert (a.size_value, a.pack_count) == (b.size_value, b.pack_count) and label[m.source_id] == f"L{m.base_source_id}"
        else:
            assert b.sku and label[m.source_id].isdigit() and (m.detail.startswith("shade:") and "Cor" in b.name_raw or b.size_value != a.size_value)
    assert len({m.augmentation for m in manifest.collect()}) > 4

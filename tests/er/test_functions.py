import json
import random
import re
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from kindred import functions as K
from kindred.functions import json_text, rank
from kindred.functions import similarity as S


def many(spark, values, column):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.r for r in df.select("k", column(F.col("v")).alias("r")).orderBy("k").collect()]


def plain(text):
    text = unicodedata.normalize("NFKD", (text or "").lower())
    text = "".join(c for c in text if not unicodedata.combining(c)).replace("&", " e ")
    return " ".join(re.sub("[^a-z0-9%]+", " ", re.sub("['`]", "", text)).split())


def test_marks_are_looked_up_in_a_table(spark):
    """The same as by ranges of characters, in half their time at most where a text is full of marks."""
    by_ranges = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.replace(c, F.lit("&"), F.lit(" e ")), "['`]", ""), "[^a-z0-9%]+", " "))
    rng = random.Random(2)
    texts = ["".join(map(chr, range(1, 256))), "\0a\0\0b\0", "a\r\n\tb\\c\"d$1", "a '` b", "'", " ", "", None, "é", "éé a", " é", "é a é", "a日b 日 c", "😀a"] + ["".join(rng.choice("ab %&'`-_.:;é日 \n\0A") for _ in range(40)) for _ in range(2000)]
    assert many(spark, texts, K.squeezed) == many(spark, texts, by_ranges)
    scores = spark.range(0, 8000, 1, 4).select(F.repeat(F.concat(F.lit("ml_price_ratio:0."), F.col("id").cast("string"), F.lit(";")), 80).alias("t"))
    seconds = {}
    for name, fn in (("table", K.squeezed), ("ranges", by_ranges)) * 2:  # the first round warms up
        begin = time.perf_counter()
        scores.select(F.sum(F.length(fn(F.col("t"))))).collect()
        seconds[name] = time.perf_counter() - begin
    assert seconds["table"] < seconds["ranges"] / 2, seconds


def test_normalize_text_against_decomposition(spark):
    rng = random.Random(1)
    letters = [chr(c) for c in range(32, 0x2FFF)] + list("ﬁ㎖™½Łª１ａ😀가")
    texts = ["Óleo Wella - 30ml!", None, "", "A&B", "Škoda Łódź", "ﬁm ½ ㎖ ™", "L'Oréal & Co´s"] + ["".join(rng.choice(letters) if rng.random() < 0.5 else rng.choice("ab 1'&%") for _ in range(30)) for _ in range(400)]
    assert many(spark, texts, K.normalize_text) == [plain(t) for t in texts]
    assert many(spark, ["L'Oréal Paris", "L OREAL-PARIS"], K.normalize_brand) == ["lorealparis"] * 2


def test_stop_words_and_tokens(spark):
    assert set(K.STOPWORDS) == {"a", "as", "com", "da", "das", "de", "do", "dos", "e", "em", "for", "of", "o", "os", "para", "the", "with"}
    assert many(spark, ["oleo de coco para um cabelo", ""], lambda c: K.informative_tokens(c, 3)) == [["oleo", "coco", "cabelo"], []]


def test_category(spark):
    assert many(spark, ["beleza›pele/rosto|hidratantes", " > ", ""], K.category_path) == [["beleza", "pele", "rosto", "hidratantes"], [], []]


def test_sizes(spark):
    got = many(spark, ["Shampoo 1L", "16 fl oz", "100ml + tester 30ml", "x12ml", "12mlx", "1,5 kg", "", None, "2 OZ"], K.size_hits)
    assert [[(round(h.value, 3), h.unit) for h in x] if x else [] for x in got] == [[(1000.0, "ml")], [(473.176, "ml")], [(100.0, "ml"), (30.0, "ml")], [], [], [(1500.0, "g")], [], [], [(56.699, "g")]]


def test_packs_models_prices(spark):
    texts = ["kit com 2 unidades 100ml", "3x", "3 pcs", "2 produto", "4 items", "1 un", "com 12 pecas", "nada", "5unidades", "pack of 6 x"]
    assert many(spark, texts, K.pack_count) == [2, 3, 3, 2, 4, None, 12, None, 5, 6]
    assert many(spark, ["base 24h d3 claro", "ab12c x9y zz123 30ml 12ab3", ""], K.model_tokens) == [[], ["12ab3", "ab12c", "zz123"], []]
    assert many(spark, ["6790", "67.90", "", "nan", "inf", "a", None, " 12 "], K.price_cents) == [6790, 67, None, None, None, None, None, 12]


def test_urls(spark):
    urls = ["https://www.Loja.com/Produto/item-1234/", "https://go.test/redirect?u=1", "https://loja.com/", "nada", None, "//loja.com/oleo-de-coco-puro;v=2?x", "https://loja.com/ab/cd", "https://x.com/uploads/item-1234"]
    url = lambda c: K.canonical_url(*[K.folded(x) for x in K.url_parts(c)])
    assert many(spark, urls, url) == ["loja/com/produto/item/1234", "", "", "", "", "loja/com/oleo/de/coco/puro", "", ""]


def test_trigrams_and_empty_sets(spark):
    assert sorted(many(spark, ["abc"], K.trigrams)[0]) == ["  a", " ab", "abc", "bc "]
    assert many(spark, ["%", "ab"], lambda c: K.jaccard(K.trigrams(c), K.trigrams(F.lit("%")))) == [None, 0.0]


def test_json_text(spark):
    texts = ['{"b": {"c": [1, true, null, 1.50]}, "EAN": "12"}', "[]", "null", "{bad", "", None, "só", '"x"', '{"EAN": 0, "upc": 7}']
    got = [(r.flat, r.bad, [tuple(e) for e in r.entries]) for r in many(spark, texts, json_text.json_text)]
    assert got == [("b c 1 True 1.5 EAN 12", False, [("b", str(json.loads(texts[0])["b"])), ("EAN", "12")]), ("", False, []), (None, False, []), (None, True, []), (None, False, []), (None, False, []), (None, True, []), ("x", False, []), ("EAN 0 upc 7", False, [("upc", "7")])]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def test_string_scores_against_plain_windows():
    rng = random.Random(3)

    def best(short, long):
        n = len(short)
        return max(2 * lcs(short, w) / (n + len(w)) for w in {long[max(0, e - n):e] for e in range(1, len(long) + n)})

    for _ in range(400):
        a, b = ("".join(rng.choices("abcé ", k=rng.randint(0, n))) for n in (9, 15))
        assert S.common(a, b) == lcs(a, b)
        if a and b:
            want = max(best(a, b), best(b, a)) if len(a) == len(b) else best(*sorted((a, b), key=len))
            assert S.partial(a, b) == pytest.approx(want)
    assert S.ratio("", "a") == S.partial("", "a") == S.token_set("", "a") == 0 and S.ratio("abc", "abc") == 1
    assert S.token_set("fuzzy was a bear", "fuzzy fuzzy was a bear") == 1 and S.token_set("a b", "c d") == pytest.approx(1 - (6 - 2) / 6)


def test_cover_density():
    assert rank.density(["a"], "a\nb") == 1.0
    assert rank.density(["a", "b"], "a x b") == pytest.approx(1 / 2)
    assert rank.density(["a", "b"], "a b\n\n\nb") == pytest.approx(1.0 + 0)
    assert rank.density(["a"], "\n\na a") == pytest.approx(0.8)
    assert rank.density([], "a") == rank.density(["z"], "a") == 0.0

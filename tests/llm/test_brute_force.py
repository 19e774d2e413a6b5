"""Whole operators and the pipeline against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import zstandard

import corpus_pipeline
from kindred.llm import exact, langid, linedup, minhash, pieces, quality, tokenbin, urlfilter, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_language_by_a_plain_loop(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = langid.learn(docs.where(~langid.held_out(docs.doc_id)))
    texts = defaultdict(set)
    for r in docs.collect():
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and r.text:
            texts[r.lang].add(r.text.lower())
    for lang, content in dictionaries.items():
        assert len(content) <= langid.DICT_BYTES and texts[lang] and any(t in content.decode() for t in texts[lang])
    coders = {}
    for lang, content in sorted(dictionaries.items()):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=langid.LEVEL)
        coders[lang] = zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
    want = {}
    for r in docs.collect():
        t = r.text or ""
        if not any(c.isalpha() for c in t):
            want[r.doc_id] = ("und", 0.0)
            continue
        sizes = {lang: len(z.compress(pa.compute.utf8_lower(pa.scalar(t)).as_py().encode())) for lang, z in coders.items()}
        first, second = sorted(sizes.values())[:2]
        want[r.doc_id] = (next(k for k, n in sizes.items() if n == first), 1 - first / second)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.report(docs).collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1]) for k in want)


def test_languages_tie_by_name(spark):
    docs = spark.createDataFrame([(1, "abc abc")], "doc_id long, text string")
    rows = langid.predict(docs, {"b": b"same words", "a": b"same words"}).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in rows] == [("a", 0.0, True)]
    assert [(r.lang_pred, r.score) for r in langid.predict(docs, {}).collect()] == [("und", 0.0)]


def shingles(text, width):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def kept_by_rules(rows):
    """Ids that the quality rules keep: the base, and fences from bucketed quartiles by language and source."""
    measures = {}
    for r in rows:
        t = r.text or ""
        w, lines = WORD.findall(t), t.split("\n")
        named = [x for x in lines if WORD.search(x)]
        at = defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i : i + 5])].append(i)
        repeated = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
        n = max(len(w), 1)
        values = {"symbols": len(re.findall(r"[#*$%&|<>]", t)) * 1000 // n, "word_length": sum(map(len, w)) * 100 // n, "dup_lines": (len(named) - len(set(named))) * 1000 // len(lines)}
        measures[r.doc_id] = (r, len(w), len(w) < 10 or 100 * len(repeated) > 20 * len(w), values)

    def fence(metric, chosen):
        shift = lambda v: max(len(bin(v)) - 2 - 8, 0)
        v = sorted(x[3][metric] >> shift(x[3][metric]) << shift(x[3][metric]) for x in chosen)
        at = lambda q: v[-(-len(v) * q // 100) - 1]
        iqr = max(at(75) - at(25), quality.METRICS[metric][1])
        return at(25) - 6 * iqr, at(75) + 6 * iqr

    full = [x for x in measures.values() if x[1]]
    out = set()
    for doc_id, (r, _, failed, values) in measures.items():
        groups = [[x for x in full if x[0].lang == r.lang and x[0].source == r.source], [x for x in full if x[0].lang == r.lang], full]
        group = groups[0] if len(groups[0]) >= 100 else groups[1] if len(groups[1]) >= 100 else full
        fine = all(values[m] <= fence(m, group)[1] and (side == "above" or values[m] >= fence(m, group)[0]) for m, (side, _) in quality.METRICS.items()) if group else True
        if not failed and fine:
            out.add(doc_id)
    return out


def near_components(texts, width, percent):
    sets, root = {k: shingles(t, width) for k, t in texts.items()}, {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and sets[a] and len(n := sets[a] & sets[b]) and 100 * len(n) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}


def test_pipeline_stage_by_stage(spark):
    import sentencepiece

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    now, at = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        at[name] = now.collect()
        now = stage(spark, now, SF).cache()
    at["end"] = now.collect()
    assert list(stages) == ["quality rules", "exact dedup", "minhash near-dedup", "mixing", "sentencepiece"]
    assert {r.doc_id for r in at["exact dedup"]} == kept_by_rules(at["quality rules"])
    first = {}
    for r in sorted(at["exact dedup"], key=lambda r: r.doc_id):
        first.setdefault(r.text or "", r.doc_id)
    assert {r.doc_id for r in at["minhash near-dedup"]} == set(first.values())
    texts = {r.doc_id: r.text for r in at["minhash near-dedup"]}
    roots = near_components(texts, 5, 80)
    assert {r.doc_id for r in at["mixing"]} == {k for k in texts if roots[k] == k}
    size, got = Counter(), Counter()
    own = {r.doc_id: WORD.findall(r.text or "") for r in at["mixing"]}
    source = {r.doc_id: r.source for r in at["mixing"]}
    for k, w in own.items():
        size[source[k]] += len(w)
    for r in at["sentencepiece"]:
        w = WORD.findall(r.text)
        got[source[r.doc_id]] += len(w)
        assert not Counter(w) - Counter(own[r.doc_id]) and r.n_chars == len(r.text)
    assert abs(sum(got.values()) - 1.5 * sum(size.values())) <= len(size) and all(got[s] <= 2 * size[s] for s in size)
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    assert sorted((r.doc_id, tuple(r.ids)) for r in at["end"]) == sorted((r.doc_id, tuple(sp.encode(r.text))) for r in at["sentencepiece"])
    assert all(r.exact for r in at["end"])


def test_odd_rows_have_their_results(spark, odd_docs):
    """Nulls, ties, repeats and clashing columns: the values, not only the counts."""
    lines = {(r.doc_id, r.n_lines, r.n_dropped): r.kept_sha256 for r in linedup.report(odd_docs).collect()}
    assert lines[3, 1, 0] == lines[4, 1, 0] == hashlib.sha256(b"").hexdigest() and (5, 2, 0) in lines
    near = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id, r.kept) for r in minhash.report(odd_docs).collect())
    assert near[0][:3] == (-1, 1, None) and [x for x in near if x[0] in (1, 2)] == [(1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False)]
    assert [x[1:] for x in near if x[0] in (3, 4, 5)] == [(0, 3, True), (0, 4, True), (0, 5, True)] and [x[2] for x in near if x[0] in (6, 7)] == [6, 6]
    rules = {r.doc_id: (r.n_words, r.base_failed) for r in quality.report(odd_docs).collect()}
    assert rules[3] == rules[4] == rules[5] == (0, True) and rules[9] == (12, False) and rules[6][0] == 24_000
    dup = {(r.doc_id, r.keep_id, r.group_size) for r in exact.report(odd_docs, keep="max").collect()}
    assert {(1, 2, 3), (2, 2, 3), (3, 4, 2), (4, 4, 2), (None, None, 1)} <= dup
    langs = {r.doc_id: (r.lang_pred, r.score) for r in langid.report(odd_docs).collect()}
    assert langs[3] == langs[4] == langs[5] == ("und", 0.0)
    ids = {r.doc_id: (r.n_tokens, r.exact) for r in pieces.encode(odd_docs).collect()}
    assert ids[3] == ids[4] == (0, True) and ids[8][1] is False  # the mark in the text comes back as a blank
    tokens = sorted((r.start, r.n_tokens) for r in tokenbin.report(odd_docs).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(tokens, tokens[1:])) and tokens[0][0] == 0


def test_pages_of_odd_rows(spark):
    pages = spark.createDataFrame([(1, "http://u:p@a.co.uk:80/x", "h", "c"), (1, "http://u:p@a.co.uk:80/x", "h", "c"), (2, None, None, "c"), (3, "http://" + "a" * 9000 + ".org/fr/", "x" * 200_000, None)], "page_id long, url string, html string, verdict string")
    labels = spark.createDataFrame([(1, 0, 1), (1, None, None), (3, 1, 0)], "doc_id long, quality int, toxic int")
    rows = sorted((r.page_id, r.host[:12], r.rule, r.verdict) for r in urlfilter.judge(pages, labels).collect())
    assert len(rows) == 4 and rows[0][1] == "u:p@a.co.uk:" and rows[2][1:3] == ("", None) and rows[3][2:] == ("org/fr/", "allow")
    assert pages.select(urlfilter.domain_of(urlfilter.host_of(pages.url)).alias("d")).head().d == "a.co.uk"
    assert urlfilter.judge(pages.limit(0), labels).count() == 0 and urlfilter.filter_pages(pages, labels).columns == pages.columns
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.report(pages).collect())
    assert got == [(1, 1, "response", None), (1, 1, "response", None), (2, 0, "response", None), (3, 200_000, "response", None)]

"""Every operator on odd rows and on no rows, and against brute force."""

import hashlib
import json
import re
import struct
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kindred.llm import arrow, exact, langid, linedup, minhash, mixing, pieces, quality, shingles, tokenbin, urlfilter, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


REPORTS = {"mixing": mixing.report, "exact": lambda d: exact.report(d, keep="max"), "language": langid.report, "quality": quality.report, "tokens": tokenbin.report, "lines": linedup.report, "minhash": minhash.report, "pieces": pieces.encode}


@pytest.mark.parametrize("name", REPORTS)
def test_a_row_for_each_row(name, odd_docs, no_docs):
    assert REPORTS[name](odd_docs).count() == odd_docs.count()
    assert REPORTS[name](no_docs).count() == 0


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES[:-1]], ids=lambda s: s[0])
def test_stages_keep_columns(stage, spark, odd_docs, no_docs):
    assert stage[1](spark, no_docs, SF).columns == no_docs.columns
    out = stage[1](spark, odd_docs, SF)
    assert out.columns == odd_docs.columns
    out.collect()


def test_exact_keeps_one_and_splits_collisions(odd_docs):
    weak = lambda t: F.length(t) % 3
    for fn in (exact.content_hash, weak):
        rows = exact.report(odd_docs, keep="max", hash_fn=fn).collect()
        by_text = defaultdict(list)
        for r in rows:
            by_text[r.text_sha256].append(r)
        assert len(by_text) == 8
        for group in by_text.values():
            assert sum(r.kept for r in group) == 1 and {r.group_size for r in group} == {len(group)}
            assert len({r.keep_id for r in group}) == 1
    assert exact.deduplicate(odd_docs).count() == 8


def test_mixing_meets_its_targets(docs):
    rows = mixing.report(docs).collect()
    again = mixing.report(docs).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    text = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        words, source = WORD.findall(text[r.doc_id][0] or ""), text[r.doc_id][1]
        assert r.size == len(words) and r.taken <= 2 * r.size
        size[source] += r.size
        taken[source] += r.taken
        target[source] = r.target
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size))}
    goal, free = {}, set(size)
    while True:
        left = 1.5 * sum(size.values()) - sum(goal.values())
        unit = left / sum(weights[s] for s in free)
        full = {s for s in free if weights[s] * unit > 2 * size[s]}
        if not full:
            break
        goal |= {s: 2.0 * size[s] for s in full}
        free -= full
    goal |= {s: weights[s] * unit for s in free}
    for s in size:
        assert target[s] == pytest.approx(goal[s]) and abs(taken[s] - goal[s]) <= 1


def test_mixing_replays_its_slots(spark, docs):
    """taken of every document against a plain walk over the slots, and the slots against the multinomial draw's promises."""
    block, shard = 64, 128
    rows, slots = mixing.plan(docs, block=block, shard=shard)
    rows, slots = rows.collect(), slots.collect()
    words = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sid, r._start, r.size)):
        assert r.size == 0 or r._start == len(words[r.sid])
        words[r.sid] += [r._id] * r.size
    assert Counter(Counter(s.shard for s in slots).values()).keys() <= {shard, len(slots) % shard}
    taken, seen = Counter(), defaultdict(set)
    for s in slots:
        assert s.block not in seen[s.sid, s["pass"]]
        seen[s.sid, s["pass"]].add(s.block)
        taken.update(words[s.sid][s.block * block : s.block * block + s.words])
    for (sid, k), blocks in seen.items():
        assert k == max(p for q, p in seen if q == sid) or blocks == set(range(-(-len(words[sid]) // block)))
    got = {r.doc_id: r.taken for r in mixing.report(docs, block=block, shard=shard).collect()}
    assert got == {r._id: taken[r._id] for r in rows} and any(taken.values())


def test_mixed_texts_hold_the_words_taken(docs):
    want = {r.doc_id: r.taken for r in mixing.report(docs).collect()}
    got = Counter()
    for r in mixing.mixed(docs).collect():
        got[r.doc_id] += len(WORD.findall(r.text))
    assert got == {k: v for k, v in want.items() if v}


def test_swap_or_not_is_a_permutation(spark):
    df = spark.range(1000).withColumn("y", mixing.permuted(F.col("id"), F.lit(1000).cast("long"), F.lit(5)))
    df = df.withColumn("back", mixing.permuted(F.col("y"), F.lit(1000).cast("long"), F.lit(5), inverse=True))
    rows = df.collect()
    assert sorted(r.y for r in rows) == list(range(1000)) and all(r.back == r.id for r in rows)


def test_url_rules_and_odd_urls(spark):
    urls = ["http://Example.NET/en/1", "http://a.example.net/de/1", "http://net/", "http://net", "http://x.org/fr/?a", "http://www.example.com/de/x#y", "nothing", None, "a://b://c/d", "http://h?q/x"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = {r.page_id: r for r in urlfilter.judge(pages, labels).collect()}
    assert [rows[i].rule for i in range(10)] == ["example.net/en/", "net/", "net/", None, "org/fr/", "example.com/de/", None, None, None, None]
    assert rows[0].host == "example.net" and rows[3].path == "" and rows[7].host == "" and rows[8].host == "b:" and rows[9].host == "h"
    assert urlfilter.filter_pages(pages, labels).columns == pages.columns


def test_url_reputation_blocks_bad_hosts(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'good'}.site{i % 2}.test/p", None) for i in range(400)] + [(900, "http://other.site1.test/", None)], "page_id long, url string, html string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    rows = {r.page_id: r.verdict for r in urlfilter.judge(pages, labels).collect()}
    assert rows[1] == rows[399] == "block" and rows[0] == rows[398] == "allow"


def test_pieces_equal_the_library(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = {r.doc_id: r.text or "" for r in docs.collect()} | {10**6 + i: t for i, t in enumerate(["a  b", " a", "\n", "\t x\n\n", "日本 ☃", "a" * 300, "▁▁a ▁", "<s> <0x41>"])}
    m = pieces.Model(pieces.default_model())
    ids, ends = m.encode(pa.array(list(texts.values()), pa.large_string()))
    for a, b, t in zip(ends[:-1], ends[1:], texts.values()):
        assert ids[a:b].tolist() == sp.encode(t)
    back = m.decode(ids, ends)
    assert all(x.decode() == t.replace("▁", " ") for x, t in zip(back, texts.values()))
    rows = pieces.encode(docs).collect()
    assert all(r.exact and r.ids == sp.encode(texts[r.doc_id]) for r in rows)


def _message(*fields):
    """A protocol buffer message of (number, value): integers, floats, texts and messages."""
    out = b""
    for k, v in fields:
        if isinstance(v, float):
            out += bytes([k << 3 | 5]) + struct.pack("<f", v)
        elif isinstance(v, int):
            out += bytes(pieces_varint(k << 3)) + bytes(pieces_varint(v))
        else:
            v = v.encode() if isinstance(v, str) else v
            out += bytes(pieces_varint(k << 3 | 2)) + bytes(pieces_varint(len(v))) + v
    return out


def pieces_varint(n):
    out = []
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return [*out, n]


def test_unigram_pieces_equal_the_library(tmp_path):
    import sentencepiece

    table = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(p, s, 1) for p, s in {"▁": -2.1, "a": -3.3, "b": -3.7, "c": -4.1, "ab": -5.2, "bc": -5.9, "abc": -8.7, "▁a": -4.9, "▁abc": -11.3, "cab": -7.2, "bb": -9.1, "▁▁": -3.5}.items()]]
    spec = lambda kind: _message(*[(1, _message((1, p), (2, s), (3, t))) for p, s, t in table], (2, _message((3, kind))), (3, _message((3, 1), (4, 0), (5, 1))))
    path = tmp_path / "toy.model"
    path.write_bytes(spec(1))
    sp, m = sentencepiece.SentencePieceProcessor(model_file=str(path)), pieces.Model(str(path))
    texts = ["abc", "abcabc cab  bb", "xx abxyc a", "", " ", "aabbcc" * 40 + " abcc", "ab\nabc\n", "日本 abc日"]
    ids, ends = m.encode(pa.array(texts, pa.large_string()))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [sp.encode(t) for t in texts]
    assert m.decode(ids, ends)[:2] == [b"abc", b"abcabc cab  bb"]
    path.write_bytes(spec(4))
    with pytest.raises(ValueError):
        pieces.Model(str(path))


def test_token_files_round_trip(docs, odd_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for df in (docs, odd_docs):
        rows = sorted(df.select("doc_id", "text").collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id)
        start, want = 0, []
        for r in rows:
            ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
            want.append((r.doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
            start += len(ids)
        got = sorted(map(tuple, tokenbin.report(df).collect()), key=lambda r: (-1 if r[0] is None else r[0], r[1]))
        assert got == want


def test_words_of_letters_go_to_the_model_alone(monkeypatch, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    seen, ids_of = [], tokenbin.WordEncoder._ids
    monkeypatch.setattr(tokenbin.WordEncoder, "_ids", lambda self, texts: seen.extend(texts) or ids_of(self, texts))
    latin = "".join(map(chr, range(0xC0, 0x100)))
    texts = [" ".join(latin), latin.replace("×", "").replace("÷", ""), "Één straße àíß don't it's NAÏVE, x" + "y" * 3000, "a1b 12 µm ªº Ÿ İstanbul \u212aelvin ŉ ΣΑΣ дом 日本", "e\u0301a Abc", "x <|endoftext|> É<|startoftext|>é", "a\u00a0b a\u2028b", ""]
    path = public_tokenizers.path("word_bpe_49k.json")

    def check(path):
        encode, tokenizer = tokenbin.WordEncoder(str(path)), Tokenizer.from_file(str(path))
        ids, ends = encode(pa.array(texts, pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
        return encode

    assert check(path).wordwise and seen and not any(re.fullmatch("[a-zÀ-ÖØ-öø-ÿ]+", w) for w in seen)
    spec = json.loads(open(path, encoding="utf-8").read())
    spec["added_tokens"].append(spec["added_tokens"][0] | {"id": 49408, "content": "aïv"})  # inside words: texts are encoded whole
    (tmp_path / "t.json").write_text(json.dumps(spec))
    texts.append("naïve NAÏVE")
    assert not check(tmp_path / "t.json").wordwise


def test_warc_round_trip_and_revisits(spark, pages):
    body = "<p>" + "x" * 200
    rows = [(1, "http://a/ b", body), (2, None, body), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (None, "u", body), (6, "u", "é" * 60)]
    odd = spark.createDataFrame(rows, pages.schema)
    got = {r.page_id: r for r in warc.read(warc.write(odd)).collect()}
    assert got[1].record_type == "response" and got[2].refers_to == 1 and got[2].payload_bytes == 203 and got[None].refers_to == 1 and got[5].record_type == "response" and got[3].payload_bytes == 0
    assert bytes(got[6].payload).decode() == "é" * 60 and got[2].payload_digest == hashlib.sha256(body.encode()).hexdigest()
    assert warc.report(odd.limit(0)).count() == 0


def test_ranges_join_neighbours():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 100, 5), ("b", 0, 5), ("b", 90, 5)]
    assert list(warc.ranges(rows, gap=20, most=1000)) == [("a", 0, 20, [0, 1]), ("a", 100, 105, [2]), ("b", 0, 5, [3]), ("b", 90, 95, [4])]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.report(docs).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_quality_counts_by_brute_force(spark, docs):
    extra = spark.createDataFrame([(10**6, "a b c d e f a b c d e g", "en", "s", 0), (10**6 + 1, "x " * 40, "en", "s", 0), (10**6 + 2, "l1 a\nl1 a\n\n#%\n", "en", "s", 0)], docs.schema)
    both = docs.unionByName(extra)
    texts = {r.doc_id: r.text or "" for r in both.collect()}
    for r in quality.report(both).collect():
        t, w = texts[r.doc_id], WORD.findall(texts[r.doc_id])
        at = defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i : i + 5])].append(i)
        repeated = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(w) < 10 or 100 * len(repeated) > 20 * len(w))


def test_filters_on_every_column_of_quality(odd_docs):
    every = quality.report(odd_docs).collect()
    for c in ("doc_id", "n_words", "n_repeat_words", "base_failed", "kept"):
        value = every[0][c]
        got = quality.report(odd_docs).where(F.col(c) == F.lit(value)).collect()
        assert sorted(map(str, got)) == sorted(str(r) for r in every if r[c] is not None and r[c] == value)


def test_quality_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.report(docs).where("NOT base_failed").join(labels, "doc_id").collect()
    clean = [r for r in rows if r.quality == 1]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)


def test_line_dedup_both_ways(spark):
    line = "A line that is long enough "
    rows = [(i, f"own {i}\n{line if i % 2 else line.lower()}\nshort\n{line}", "m") for i in range(5)] + [(7, None, "m"), (8, "short", "m"), (2, f"again\n{line}", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_text string")
    for few in (1000, 0):
        got = linedup.rewrite(docs, few=few).select("_row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
        drops = sorted((r.doc_id, r.n_lines, r.n_dropped) for r in got)
        assert drops == [(0, 4, 2), (1, 4, 2), (2, 2, 1), (2, 4, 2), (3, 4, 2), (4, 4, 0), (7, 1, 0), (8, 1, 0)]


def test_minhash_components_by_brute_force(spark, docs):
    base = [f"w{i}" for i in range(300)]
    rows = [(10**6 + i, " ".join(base[:i] + ["edit"] + base[i + 1 :])) for i in range(0, 300, 3)] + [(2 * 10**6, "a b"), (2 * 10**6 + 1, "A  b"), (2 * 10**6 + 2, None), (None, "a b")]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = [(r.doc_id, r.text or "") for r in both.collect()]
    sets = {}
    for i, t in texts:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
    ids = sorted(i for i in sets if i is not None)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: r for r in minhash.report(both).collect()}
    assert {i: got[i].component_id for i in ids} == {i: find(i) for i in ids}
    assert got[None].kept and got[None].component_id is None and got[2 * 10**6 + 2].n_shingles == 0


def test_slices_are_whole():
    texts = [f"wört{i} à Å é" * 50 for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    names, count = Counter(), 0
    for part in arrow.slices(iter([batch]), "text", 5000):
        words, codes, ends = arrow.word_codes(pa.compute.ascii_lower(arrow.column(part, "text")))
        names.update(words[c] for c in codes)
        count += len(ends) - 1
    assert count == 500 and names == Counter(w for t in texts for w in t.split())


def test_bands_reach_their_recall():
    for s in (0.8, 0.85):
        assert (1 - s**4) ** shingles.bands_for(s) <= 1e-7

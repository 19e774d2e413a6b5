"""DuckDB SQL that the queries are checked with; common table expressions of one text, BASE."""

from kindred import functions as K
from kindred.sources import OFFERS_SQL

UP, LOW = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ", "aaaaaaeeeeiiiiooooouuuucnyy"
NORM = f"trim(regexp_replace(regexp_replace(replace(translate(lower({{0}}), '{UP}', '{LOW}'), '&', ' e '), '[''`´]', '', 'g'), '[^a-z0-9%]+', ' ', 'g'))"
#: The size pattern without look-behind, which this engine lacks.
SIZE = r"(?i)(?:^|[^a-z0-9])(\d+(?:[,.]\d+)?)\s*(fl\s*oz|floz|ml|l|g|kg|oz)(?:[^a-z]|$)"
STEPS = "(0.90::DOUBLE), (0.88), (0.86), (0.84), (0.82), (0.80), (0.78), (0.75), (0.70)"
BASE = f"""
WITH RECURSIVE o AS ({OFFERS_SQL}),
u AS (SELECT *, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www[.]', '') AS host, lower(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '')) AS path,
  CASE WHEN specs = '{{}}' THEN '' ELSE 'ean ' || json_extract_string(specs, '$.EAN') END AS specs_text FROM o),
w AS (SELECT *, list_filter(string_split({NORM.format('path')}, ' '), lambda t: length(t) >= 3) AS path_words, concat_ws(' ', prod_name, nullif(dimension, ''), nullif(specs_text, '')) AS attribute_text FROM u),
n AS (SELECT id AS source_id, retailer, {NORM.format('prod_name')} AS name_norm, regexp_replace({NORM.format('brand')}, '[^a-z0-9]', '', 'g') AS brand_norm,
  {NORM.format('sku')} AS sku, coalesce(json_extract_string(specs, '$.EAN'), '') AS ean, price::BIGINT AS price_cents, label, category, dimension, specs_text,
  nullif(regexp_extract(attribute_text, '{SIZE}', 1), '')::DOUBLE AS size_value, lower(nullif(regexp_extract(attribute_text, '{SIZE}', 2), '')) AS size_unit,
  try_cast(nullif(regexp_extract({NORM.format('attribute_text')}, '{K.PACK}', 1), '') AS INTEGER) AS pack,
  CASE WHEN NOT regexp_matches(host || '/' || path, '{"|".join(K.REDIRECTS)}') AND (len(list_filter(path_words, lambda t: regexp_matches(t, '[0-9]'))) > 0 OR len(path_words) >= 2 AND length(array_to_string(path_words, '')) >= 12)
    THEN replace({NORM.format("host || ' ' || path")}, ' ', '/') ELSE '' END AS canonical_url FROM w),
k AS (SELECT source_id, 'ean' AS key_type, ean AS key_value FROM n WHERE ean <> '' UNION ALL SELECT source_id, 'retailer_sku:' || retailer, sku FROM n WHERE sku <> ''
  UNION ALL SELECT source_id, 'canonical_url', canonical_url FROM n WHERE canonical_url <> ''),
xp AS (SELECT a.source_id AS i, b.source_id AS j, 'exact:' || a.key_type || ':' || substr(a.key_value, 1, 80) AS evidence FROM k a JOIN k b ON a.key_type = b.key_type AND a.key_value = b.key_value AND a.source_id < b.source_id),
g AS MATERIALIZED (SELECT brand_norm, name_norm, list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(name_norm, '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, len(w) + 2), lambda q: substr('  ' || w || ' ', q::BIGINT, 3))))) AS grams
  FROM (SELECT DISTINCT brand_norm, name_norm FROM n WHERE brand_norm <> '' AND name_norm <> '')),
gs AS (SELECT brand_norm, x, y, c / (p + q - c) AS s FROM (SELECT a.brand_norm, a.name_norm AS x, b.name_norm AS y, len(list_intersect(a.grams, b.grams))::DOUBLE AS c, len(a.grams) AS p, len(b.grams) AS q
  FROM g a JOIN g b ON a.brand_norm = b.brand_norm AND a.name_norm <= b.name_norm AND abs(length(a.name_norm) - length(b.name_norm)) <= 24) WHERE c / (p + q - c) >= 0.55),
gt AS (SELECT * FROM gs UNION SELECT brand_norm, y, x, s FROM gs),
tp AS MATERIALIZED (SELECT i, j, round(s, 4) AS score FROM (SELECT a.source_id AS i, b.source_id AS j, s FROM gt JOIN n a ON a.brand_norm = gt.brand_norm AND a.name_norm = x JOIN n b ON b.brand_norm = gt.brand_norm AND b.name_norm = y AND a.source_id < b.source_id)
  QUALIFY row_number() OVER (PARTITION BY i ORDER BY s DESC, j) <= 25)
"""

FLAGS = BASE + """, f AS (SELECT unnest(list_filter([CASE WHEN brand_norm = '' THEN 'missing_brand' END, CASE WHEN brand_norm IN ('generic', 'generico') THEN 'generic_brand' END, 'missing_description',
  CASE WHEN specs_text = '' THEN 'missing_specs' END, CASE WHEN price_cents IS NULL THEN 'missing_price' WHEN price_cents <= 0 THEN 'suspicious_price' END, CASE WHEN len(string_split(name_norm, ' ')) <= 1 THEN 'title_too_short' END,
  CASE WHEN sku = '' AND ean = '' THEN 'missing_identifier' END], lambda x: x IS NOT NULL)) AS flag FROM n)
SELECT flag, count(*) AS n FROM f GROUP BY flag ORDER BY n DESC, flag LIMIT 20"""

BUCKET = "CASE WHEN score >= 0.95 THEN '0.95-1.00' WHEN score >= 0.90 THEN '0.90-0.95' WHEN score >= 0.86 THEN '0.86-0.90' WHEN score >= 0.70 THEN '0.70-0.86' ELSE '<0.70' END"
HISTOGRAM = BASE + f"SELECT bucket, (SELECT count(*) FROM tp WHERE {BUCKET} = bucket) AS n FROM (VALUES ('0.95-1.00'), ('0.90-0.95'), ('0.86-0.90'), ('0.70-0.86'), ('<0.70')) v(bucket)"
SENSITIVITY = BASE + f"SELECT printf('%.2f', t) AS threshold, (SELECT count(*) FROM tp WHERE score >= t) AS n FROM (VALUES {STEPS}) v(t)"

VECTORS = """
WITH s AS (SELECT a.vec_id AS i, b.vec_id AS j, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 12) AS s FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY i ORDER BY s DESC, j) <= 25)
SELECT least(i, j) AS i, greatest(i, j) AS j, round(max(s), 4) AS score FROM t WHERE s >= 0.30 GROUP BY 1, 2"""

PLAIN = BASE + """, t AS (
SELECT i, j, count(DISTINCT split_part(evidence, ':', 2)) AS k, bool_or(evidence LIKE 'exact:ean:%') AS e, bool_or(evidence LIKE 'exact:retailer_sku%') AS s FROM xp GROUP BY i, j),
f AS (SELECT i, j, k, e, s, a.retailer = b.retailer AS sr, a.brand_norm <> '' AND a.brand_norm = b.brand_norm AS be, a.price_cents AS x, b.price_cents AS y, a.ean <> '' AND a.ean = b.ean AS ee, a.sku <> '' AND a.sku = b.sku AND a.retailer <> b.retailer AS sx,
  a.size_value AS u, b.size_value AS v, a.size_unit = b.size_unit AS w, a.pack AS p, b.pack AS q FROM t JOIN n a ON a.source_id = i JOIN n b ON b.source_id = j)
SELECT i, j, sr::INT::DOUBLE AS same_retailer, be::INT::DOUBLE AS brand_exact, coalesce(w AND abs(u - v) <= greatest(0.08 * greatest(u, v), 1), false)::INT::DOUBLE AS size_match,
  coalesce(w AND abs(u - v) > greatest(0.08 * greatest(u, v), 1), false)::INT::DOUBLE AS size_conflict, coalesce(p = q, false)::INT::DOUBLE AS pack_match, coalesce(p <> q, false)::INT::DOUBLE AS pack_conflict,
  round(CASE WHEN x > 0 AND y > 0 THEN abs(x - y)::DOUBLE / greatest(x, y) ELSE 1 END, 6) AS price_ratio_diff, ee::INT::DOUBLE AS exact_ean, k::DOUBLE AS exact_key_count,
  CASE WHEN e THEN 1.0 WHEN s THEN 0.88 ELSE 0.86 END::DOUBLE AS exact_evidence_strength, sx::INT::DOUBLE AS exact_sku_cross_retailer FROM f"""

COMPONENTS = BASE + """, d AS (SELECT DISTINCT i, j FROM xp UNION SELECT j, i FROM xp), r(node, other) AS (SELECT i, i FROM d UNION SELECT r.node, d.j FROM r JOIN d ON r.other = d.i)
SELECT node, min(other) AS root FROM r GROUP BY node"""

#: Pairs of the exact and trigram layers with a decision by one rule: those with an ean, or of a similarity of 0.84, merge.
JUDGED = BASE + """, b AS (SELECT i, j, array_to_string(list_sort(list_distinct(list(evidence))), '|') AS keys, max(score) AS score FROM (SELECT i, j, evidence, 0.0::DOUBLE AS score FROM xp UNION ALL SELECT i, j, 'trigram:title:' || printf('%.4f', score), score FROM tp) GROUP BY i, j),
e AS (SELECT keys, (contains(keys, 'exact:ean:') OR score >= 0.84) AS p, a.label = c.label AS t FROM b JOIN n a ON a.source_id = i JOIN n c ON c.source_id = j)"""
METRICS = """count(*) AS pairs, count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (t AND NOT p) AS fn, count(*) FILTER (NOT t AND NOT p) AS tn"""
RATIOS = """pairs, tp, fp, fn, tn, tp + fn AS truth_positive_pairs, fp + tn AS truth_negative_pairs, tp + fp AS predicted_merge_pairs, fn + tn AS predicted_no_merge_pairs, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
  round(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 6) AS f1"""
CONFUSION = JUDGED + f", c AS (SELECT {METRICS} FROM e) SELECT {RATIOS} FROM c"
SLICES = JUDGED + f""", s AS (SELECT p, t, unnest(list_filter(['all_labeled', 'layers:' || concat_ws('+', CASE WHEN contains(keys, 'exact:') THEN 'exact' END, CASE WHEN contains(keys, 'trigram:') THEN 'trigram' END),
  CASE WHEN contains(keys, 'exact:') THEN 'evidence:exact' END, CASE WHEN contains(keys, 'trigram:') THEN 'evidence:trigram' END], lambda x: x IS NOT NULL)) AS slice FROM e),
c AS (SELECT slice, {METRICS} FROM s GROUP BY slice) SELECT slice, {RATIOS} FROM c"""

POSITIVES = BASE + """SELECT a.source_id AS i, b.source_id AS j FROM n a JOIN n b ON a.label = b.label AND a.source_id < b.source_id ORDER BY md5('13|' || a.source_id || '|' || b.source_id), i, j LIMIT 50000"""
CURVE = BASE + """, q AS (SELECT score, (a.label = b.label)::INT AS y FROM tp JOIN n a ON a.source_id = i JOIN n b ON b.source_id = j),
c AS (SELECT threshold, (SELECT sum(y) FROM q WHERE score >= threshold) AS tp, (SELECT count(*) - sum(y) FROM q WHERE score >= threshold) AS fp, (SELECT sum(y) FROM q) AS y FROM (SELECT round((0.05 + 0.01 * k)::DOUBLE, 2) AS threshold FROM range(95) r(k))),
v AS (SELECT threshold, coalesce(tp, 0)::BIGINT AS tp, coalesce(fp, 0)::BIGINT AS fp, (y - coalesce(tp, 0))::BIGINT AS fn FROM c),
z AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall FROM v)"""
THRESHOLDS = CURVE + " SELECT threshold, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0), 6) AS f1 FROM z"
AVERAGE_PRECISION = CURVE + """, a AS (SELECT score, sum(y) AS y, count(*) AS m FROM q GROUP BY score), h AS (SELECT y, sum(y) OVER (ORDER BY score DESC) AS t, sum(m) OVER (ORDER BY score DESC) AS m FROM a)
SELECT round(sum(y * (t / m)) / sum(y), 6) AS average_precision FROM h"""

PROFILES = BASE + """, x AS (SELECT i, j, 'exact' AS layer, 0.0::DOUBLE AS s FROM xp UNION ALL SELECT i, j, 'trigram', score FROM tp), z AS (SELECT i AS source_id, layer, s FROM x UNION ALL SELECT j, layer, s FROM x),
pr AS (SELECT source_id, bool_or(layer = 'exact') AS has_exact, 0::BIGINT AS fts_hits, count(*) FILTER (layer = 'trigram') AS trigram_hits, 0.0::DOUBLE AS max_fts_rank, max(CASE WHEN layer = 'trigram' THEN s ELSE 0 END)::DOUBLE AS max_trigram_similarity, count(*) FILTER (layer <> 'exact') AS neighbour_rows FROM z GROUP BY 1)"""
GATE = PROFILES + """ SELECT n.source_id, CASE WHEN has_exact IS NULL THEN 'no_signal' WHEN has_exact THEN 'exact' WHEN neighbour_rows = 0 THEN 'no_signal' WHEN max_trigram_similarity < 0.60 THEN 'weak_signal' ELSE 'anchor' END AS gate FROM n LEFT JOIN pr USING (source_id)"""

#: The layer of words: queries q and documents (lines) of a brand; ws are the shortest spans of a document that hold all words of a query.
LEXICAL = f"""
ls AS (SELECT source_id, brand_norm, list_filter(list_transform(regexp_split_to_array(category, '[>›/|]+'), lambda x: {NORM.format('x')}), lambda x: x <> '') AS parts, dimension, name_norm, specs_text FROM n WHERE brand_norm <> ''),
lt AS (SELECT source_id, brand_norm, list_sort(list_distinct(list_filter(regexp_split_to_array(translate(lower(concat_ws(' ', brand_norm, nullif(array_to_string(list_filter(string_split(name_norm, ' '), lambda t: length(t) > 2 AND t NOT IN {K.STOPWORDS})[1:8], ' '), ''), parts[-1], nullif(dimension, ''))), '{UP}', '{LOW}'), '[^a-z0-9]+'), lambda w: w <> ''))) AS q,
  [brand_norm, name_norm, array_to_string(parts, ' '), specs_text] AS y FROM ls),
lq AS MATERIALIZED (SELECT brand_norm, q, row_number() OVER () AS x FROM (SELECT DISTINCT brand_norm, q FROM lt WHERE len(q) > 0)),
ly AS MATERIALIZED (SELECT brand_norm, y, row_number() OVER () AS d, list_filter(regexp_split_to_array(array_to_string(y, ' '), '[^a-z0-9]+'), lambda w: w <> '') AS words FROM (SELECT DISTINCT brand_norm, y FROM lt)),
lh AS MATERIALIZED (SELECT x, d, q, len(q) AS words FROM lq JOIN ly ON lq.brand_norm = ly.brand_norm AND list_has_all(ly.words, q)),
lw AS (SELECT d, unnest(w) AS w, generate_subscripts(w, 1) AS place FROM (SELECT d, list_concat(list_concat(list_transform(list_filter(string_split(y[1], ' '), lambda t: t <> ''), lambda t: {{'w': t, 'z': 1.0::DOUBLE}}), list_transform(list_filter(string_split(y[2], ' '), lambda t: t <> ''), lambda t: {{'w': t, 'z': 1.0::DOUBLE}})),
  list_concat(list_transform(list_filter(string_split(y[3], ' '), lambda t: t <> ''), lambda t: {{'w': t, 'z': 0.4::DOUBLE}}), list_transform(list_filter(string_split(y[4], ' '), lambda t: t <> ''), lambda t: {{'w': t, 'z': 0.2::DOUBLE}}))) AS w FROM ly)),
lm AS MATERIALIZED (SELECT x, lh.d, words, place, lw.w.w AS w, lw.w.z AS z FROM lh JOIN lw ON lh.d = lw.d AND list_contains(q, lw.w.w)),
le AS (SELECT a.x, a.d, a.words, a.place AS e, b.w, max(b.place) AS near FROM lm a JOIN lm b ON a.x = b.x AND a.d = b.d AND b.place <= a.place GROUP BY ALL),
lc AS (SELECT x, d, e, min(near) AS b FROM le GROUP BY x, d, words, e HAVING count(*) = words),
ws AS (SELECT x, d, b, min(e) AS e FROM lc GROUP BY x, d, b),
lr AS (SELECT ws.x, ws.d, b, e, count(*) AS m, sum(1 / z) AS z FROM ws JOIN lm ON lm.x = ws.x AND lm.d = ws.d AND place BETWEEN b AND e GROUP BY ALL),
lg AS (SELECT x, d, coalesce(s, 0.0) AS s FROM lh LEFT JOIN (SELECT x, d, list_sum(list(m / z / (1 + e - b - (m - 1)) ORDER BY b)) AS s FROM lr GROUP BY x, d) USING (x, d)),
la AS (SELECT source_id, x, d FROM lt JOIN ly USING (brand_norm, y) LEFT JOIN lq USING (brand_norm, q)),
lp AS MATERIALIZED (SELECT i, j, round(s, 4) AS score FROM (SELECT a.source_id AS i, b.source_id AS j, s FROM lg JOIN la a ON a.x = lg.x JOIN la b ON b.d = lg.d AND b.x IS NOT NULL AND a.source_id < b.source_id) QUALIFY row_number() OVER (PARTITION BY i ORDER BY s DESC, j) <= 25)"""
RETRIEVAL = BASE + "," + LEXICAL + """, x AS (SELECT i, j, 'exact' AS layer, 0.0::DOUBLE AS s FROM xp UNION ALL SELECT i, j, 'lexical', score FROM lp UNION ALL SELECT i, j, 'trigram', score FROM tp), z AS (SELECT i AS source_id, layer, s FROM x UNION ALL SELECT j, layer, s FROM x)
SELECT source_id, bool_or(layer = 'exact') AS has_exact, count(*) FILTER (layer = 'lexical') AS fts_hits, count(*) FILTER (layer = 'trigram') AS trigram_hits, max(CASE WHEN layer = 'lexical' THEN s ELSE 0 END)::DOUBLE AS max_fts_rank,
  max(CASE WHEN layer = 'trigram' THEN s ELSE 0 END)::DOUBLE AS max_trigram_similarity, count(*) FILTER (layer <> 'exact') AS neighbour_rows FROM z GROUP BY 1"""

"""SQL counterparts (DuckDB) of the operators' queries, on the same tables.

Operators 3, 5, 6, 8 to 12 have none: SQL has no XXH64 of a given seed, no keyed networks over characters,
no learned models, no range coder, no hash trees and no tokenizers. They are tested against brute force.
"""

from __future__ import annotations

_OP1 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n FROM documents
), src AS (SELECT source, sum(n)::BIGINT AS tokens FROM d GROUP BY source),
tot AS (SELECT sum(tokens)::BIGINT AS t, count(*) FILTER (tokens > 0) AS k FROM src),
ps AS (SELECT list(tokens::DOUBLE / t ORDER BY source) AS p FROM src, tot WHERE tokens > 0),
h AS (
  SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi,
    (SELECT -list_sum([x * ln(x) for x in p]) >= 0.97 * ln(k) FROM ps, tot) AS done
  UNION ALL
  SELECT step + 1, CASE WHEN up THEN mid ELSE lo END, CASE WHEN up THEN hi ELSE mid END, done
  FROM (
    SELECT step, lo, hi, done, (lo + hi) / 2 AS mid,
      ln(list_sum([exp(ln(x) * ((lo + hi) / 2)) for x in p]))
      - ((lo + hi) / 2) * list_sum([exp(ln(x) * ((lo + hi) / 2)) * ln(x) for x in p])
        / list_sum([exp(ln(x) * ((lo + hi) / 2)) for x in p]) >= 0.97 * ln(k) AS up
    FROM h, ps, tot WHERE step < 20 AND NOT done
  )
), power AS (SELECT CASE WHEN done OR k < 2 THEN 1.0 ELSE lo END AS a FROM h, tot ORDER BY step DESC LIMIT 1),
temp AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN exp(ln(tokens::DOUBLE / t) * a) ELSE 0 END AS w FROM src, tot, power),
bud AS (SELECT source, tokens, floor(w / sum(w) OVER () * t + 1e-6)::BIGINT AS b FROM temp, tot),
plan AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN b // tokens ELSE 1 END AS epochs,
    CASE WHEN tokens > 0 THEN b % tokens ELSE 0 END AS rest FROM bud
), keyed AS (
  SELECT doc_id, d.source, n, epochs, rest,
    ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || epochs || ':1')[1:13])::BIGINT AS key
  FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source
), last AS (
  SELECT *, sum(n) OVER (PARTITION BY source ORDER BY key RANGE UNBOUNDED PRECEDING) AS upto FROM keyed
), copies AS (
  SELECT doc_id, source, epochs + (rest > 0 AND upto <= rest)::INT AS c FROM last
), rows AS (SELECT doc_id, source, unnest(range(c::BIGINT)) AS epoch FROM copies)
SELECT doc_id, source, epoch,
  ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || epoch || ':1')[1:13])::BIGINT >> 42 AS block
FROM rows
"""

_OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), low AS (SELECT a, min(least(a, b)) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS k FROM links GROUP BY a)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN low ON vec_id = low.a
"""

_OP4 = """
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(rule_host, rule_path, decided) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT host, path, max_by(rule_host || rule_path, len(rule_host || rule_path)) AS rule,
    max_by(decided, len(rule_host || rule_path)) AS decided
  FROM (SELECT DISTINCT host, path FROM parts) p
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, parts.host, parts.path, rule,
  coalesce(decided, CASE WHEN list_has_any(string_split(parts.host, '.'),
    ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fits ON parts.host = fits.host AND parts.path = fits.path
"""

_WORDS = r"""regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_OP7 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT item_id, coalesce({_WORDS.format("text")}, []) AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM win),
seen AS (
  SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), found AS (SELECT r, seen.size, i, item_id FROM seen JOIN win ON seen.size = win.size AND seen.phrase = win.phrase),
hits AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r),
items AS (
  SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM found GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON d.r = hits.r LEFT JOIN items ON d.r = items.r
"""

_OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), dw AS (SELECT r, unnest(w) AS word FROM d),
bw AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), t AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
), words AS (SELECT DISTINCT word FROM (SELECT word FROM dw UNION ALL SELECT word FROM bw)),
bytes AS (
  SELECT word, list_transform(range(1, len(hex(word)), 2), lambda i: ('0x' || hex(word)[i:i + 1])::BIGINT) AS b FROM words
), buckets AS (
  SELECT word, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, t
), s AS (SELECT bucket, count(*) AS n FROM dw JOIN buckets USING (word) GROUP BY 1),
tt AS (SELECT bucket, count(*) AS n FROM bw JOIN buckets USING (word) GROUP BY 1),
gain AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(tt.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)
    / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000))))::BIGINT AS g
  FROM s LEFT JOIN tt USING (bucket)
), weights AS (SELECT r, sum(g)::BIGINT AS weight FROM dw JOIN buckets USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT d.r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r)
), able AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, r) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20 AND score IS NOT NULL
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank FROM scored LEFT JOIN able USING (r)
"""

ORACLE: dict[str, str] = {
    "op1_mixing": _OP1,
    "op2_grid_join": _OP2,
    "op4_cascade": _OP4,
    "op7_fm_index": _OP7,
    "op13_resampling": _OP13,
}

"""DuckDB SQL of the queries whose operators load more than Spark (kept apart from them)."""

DECONTAMINATE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
stretches AS (
  SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, s, n, item FROM stretches JOIN windows USING (n, phrase)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

PHRASES = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM words WHERE len(w) > 0),
grams AS (
  SELECT lang, size, array_to_string(w[s : s + size - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (SELECT unnest(range(1, 6)) AS size) WHERE s + size - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1),
inner_parts AS (
  SELECT lang, a, phrase, array_to_string(w[s : s + m - 1], ' ') AS part
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates))),
dropped AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inner_parts i ON i.lang = c.lang AND i.part = c.phrase
  WHERE 100 * i.a >= 100 * c.a),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n,
         CAST(1000::HUGEINT * c.a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 : c.size], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best ANTI JOIN dropped USING (lang, phrase)
QUALIFY rank <= 2000
"""

WARC = """
WITH p AS (SELECT row_number() OVER () AS r, page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
shared AS (SELECT digest, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY digest HAVING count(*) > 1),
ranked AS (SELECT p.*, s.last, row_number() OVER (PARTITION BY page_id, p.digest ORDER BY r) AS nth FROM p LEFT JOIN shared s USING (digest)),
told AS (SELECT *, last IS NOT NULL AND (page_id IS DISTINCT FROM last OR nth > 1) AS again FROM ranked)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN last END AS refers_to
FROM told
"""

"""DuckDB SQL for the training-data queries that SQL can express."""
from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op4_url_filter"] = r"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(verdict, rule) AS (
  VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'),
         ('block', 'com/de/')),
m AS (
  SELECT page_id, verdict, rule,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, strpos(rule, '/') DESC) AS n
  FROM p JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
   AND starts_with(path, substr(rule, strpos(rule, '/'))))
SELECT p.page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(
         host, '(^|\.)([^.]*-)?(ads|adult|bets|casino|pills|porn|spam)(-[^.]*)?\.') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m ON m.page_id = p.page_id AND n = 1
"""

ORACLE["op5_host_quality"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
g AS (
  SELECT doc_id, i, lead(i, 2) OVER x IS NOT NULL AS whole,
         [word, lead(word) OVER x, lead(word, 2) OVER x] AS gram
  FROM w WINDOW x AS (PARTITION BY doc_id ORDER BY i)),
r AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g WHERE whole) WHERE c > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT i + plus) AS n FROM r, (VALUES (0), (1), (2)) AS v(plus) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN dup ON dup.doc_id = d.doc_id LEFT JOIN repeated ON repeated.doc_id = d.doc_id),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (
  SELECT source, count(*) AS n,
         count(*) FILTER (base_failed OR 100 * n_symbols > 10 * word_chars OR n_dup_lines > 20) AS fails
  FROM f WHERE source <> '' GROUP BY source),
prior AS (
  SELECT avg(fails / n) AS m, var_pop(fails / n) AS v FROM h),
strength AS (
  SELECT m, greatest(2.0, least(1000.0, CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1000.0 END)) AS s FROM prior),
bad AS (SELECT source FROM h, strength WHERE (fails + m * s) / (n + s) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.source IS NULL AS kept
FROM f LEFT JOIN bad ON bad.source = f.source
"""

ORACLE["op9_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, source, md5(text) AS page, unnest(string_split(text, chr(10))) AS line FROM documents),
k AS (
  SELECT source, trim(line, concat(' ', chr(9), chr(13), chr(11), chr(12))) AS line, count(DISTINCT page) AS pages
  FROM l WHERE source <> '' GROUP BY ALL),
t AS (SELECT source, count(DISTINCT md5(text)) AS total FROM documents GROUP BY source),
b AS (
  SELECT source, line FROM k JOIN t USING (source)
  WHERE line <> '' AND pages >= 4 AND pages > CAST(0.1 AS DOUBLE) * total),
n AS (
  SELECT doc_id, source, text, generate_subscripts(string_split(text, chr(10)), 1) AS i,
         unnest(string_split(text, chr(10))) AS line FROM documents),
c AS (
  SELECT doc_id, count(*)::INTEGER AS n_lines, count(b.line)::INTEGER AS n_dropped,
         coalesce(string_agg(n.line, chr(10) ORDER BY i) FILTER (b.line IS NULL), '') AS text
  FROM n LEFT JOIN b ON b.source = n.source
   AND b.line = trim(n.line, concat(' ', chr(9), chr(13), chr(11), chr(12)))
  GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       length(c.text)::BIGINT AS n_chars, sha256(c.text) AS text_sha256
FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id
"""

ORACLE["op12_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
         (len(w) < 100)::INTEGER + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INTEGER
         + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::INTEGER
         + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER + 16 * (d.doc_id > min(d.doc_id) OVER (PARTITION BY t))::INTEGER AS mask
  FROM d LEFT JOIN labels ON labels.doc_id = d.doc_id),
g AS (SELECT part, mask, good, toxic, count(*) AS n FROM f GROUP BY ALL),
i AS (SELECT unnest(range(5))::INTEGER AS f),
o AS (
  SELECT chr(65 + a.f) || chr(65 + b.f) || chr(65 + c.f) || chr(65 + d.f) || chr(65 + e.f) AS filter_order,
         [1 << a.f, 1 << b.f, 1 << c.f, 1 << d.f, 1 << e.f] AS bits
  FROM i a JOIN i b ON b.f <> a.f JOIN i c ON c.f NOT IN (a.f, b.f) JOIN i d ON d.f NOT IN (a.f, b.f, c.f)
  JOIN i e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
s AS (
  SELECT filter_order, step::INTEGER AS step, bits[step] AS own, list_sum(bits[1:step])::INTEGER - bits[step] AS before
  FROM o, range(1, 6) AS r(step)),
c AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (mask & (own | before) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before > 0 AND mask & own > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0 AND good), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0 AND toxic), 0)::BIGINT AS toxic_lost
  FROM g, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM c
"""


def _vector_codes(rounds: int = 6) -> str:
    """Every round is one pair of tables: nearest entries, then the new codebook."""
    nearest = """
a{k} AS MATERIALIZED (
  SELECT vec_id, p, e, dist FROM (
    SELECT c.vec_id, c.p, b.e, sum((c.x - b.x) * (c.x - b.x)) AS dist
    FROM c JOIN b{k} b ON b.p = c.p AND b.d = c.d GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY dist, e) = 1),"""
    book = """
b{next} AS MATERIALIZED (
  SELECT b.p, b.e, b.d, coalesce(m.x, b.x) AS x
  FROM b{k} b LEFT JOIN (
    SELECT p, e, d, ((total - ((total % n) + n) % n) // n)::BIGINT AS x FROM (
      SELECT c.p, a.e, c.d, sum(c.x)::BIGINT AS total, count(*) AS n
      FROM c JOIN a{k} a ON a.vec_id = c.vec_id AND a.p = c.p GROUP BY ALL)) m
  ON m.p = b.p AND m.e = b.e AND m.d = b.d),"""
    return """
WITH u AS (
  SELECT vec_id, len(embedding) AS n, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i
  FROM embeddings WHERE embedding IS NOT NULL),
bad AS (SELECT DISTINCT vec_id FROM u WHERE x IS NULL OR isnan(x) OR isinf(x)),
c AS MATERIALIZED (
  SELECT vec_id, i // (n // 8) AS p, i % (n // 8) AS d, floor(4096 * x)::BIGINT AS x
  FROM u WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
b0 AS MATERIALIZED (
  SELECT p, e, d, x FROM c JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (SELECT DISTINCT vec_id FROM c)
    QUALIFY e < 16) USING (vec_id)),""" + "".join(
        nearest.format(k=k) + book.format(k=k, next=k + 1) for k in range(rounds)) + nearest.format(k=rounds) + """
v AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error
  FROM a6 GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, d)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN embeddings USING (vec_id), digest
"""


ORACLE["op11_vector_codes"] = _vector_codes()

"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP5 = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (
  SELECT src, CAST(sum(size) AS BIGINT) AS size,
         list_value(5, 2, 1)[CAST((row_number() OVER (ORDER BY src) - 1) % 3 + 1 AS BIGINT)] AS w
  FROM d GROUP BY src),
-- a source is at its limit if, of all sources with a smaller or equal size to weight, none has room left
a AS (
  SELECT src, size, w,
         150 * (SELECT sum(size) FROM s) - 200 * coalesce(sum(size) OVER earlier, 0) AS words_left,
         (SELECT sum(w) FROM s) - coalesce(sum(w) OVER earlier, 0) AS w_left,
         row_number() OVER (ORDER BY size / CAST(w AS DOUBLE), src) AS n
  FROM s WINDOW earlier AS (ORDER BY size / CAST(w AS DOUBLE), src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (
  SELECT words_left, w_left FROM a WHERE 200 * size * w_left > w * words_left ORDER BY n LIMIT 1),
t AS (
  SELECT src, size AS source_size,
         CASE WHEN 200 * size * a.w_left <= w * a.words_left THEN CAST(2 * size AS DOUBLE)
              ELSE CAST(w * (SELECT words_left FROM o) AS DOUBLE) / CAST(100 * (SELECT w_left FROM o) AS DOUBLE) END AS target
  FROM a),
p AS (
  SELECT d.*, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS budget,
         coalesce(sum(size) OVER (PARTITION BY src ORDER BY k, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_word
  FROM d JOIN t USING (src))
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - first_word)) END AS BIGINT) AS taken
FROM p
"""

OP6 = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)
         / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM p)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, i, lines[i] AS line, translate(trim(lines[i], {_SPACE}), '{_UPPER}', '{_LOWER}') AS k
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
h AS (
  SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
f AS (SELECT l.doc_id, i, line, h.k IS NOT NULL AND l.doc_id <> h.last AS gone FROM l LEFT JOIN h ON l.k = h.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

OP9 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""

OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

OP12 = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?
-]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS words FROM p),
s AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (SELECT lang, unnest([words[i:i + k - 1] FOR k IN range(1, 6) IF i + k - 1 <= len(words)]) AS phrase FROM s),
f AS (SELECT lang, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(phrase) = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE f >= 100 AND len(phrase) >= 2),
b AS (
  SELECT * FROM c WHERE NOT EXISTS (
    FROM c q WHERE q.lang = c.lang AND len(q.phrase) > len(c.phrase) AND 100 * q.f >= 100 * c.f
    AND contains(' ' || array_to_string(q.phrase, ' ') || ' ', ' ' || array_to_string(c.phrase, ' ') || ' '))),
k AS (SELECT lang, phrase, f AS a, unnest(range(1, len(phrase))) AS cut FROM b),
m AS (
  SELECT k.lang, k.phrase, k.a, cut, l.f AS l, r.f AS r, t.n,
         CAST((CAST(1000 AS HUGEINT) * k.a * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM k JOIN t ON t.lang = k.lang JOIN f l ON l.lang = k.lang AND l.phrase = k.phrase[1:cut]
  JOIN f r ON r.lang = k.lang AND r.phrase = k.phrase[cut + 1:]
  QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, cut) = 1),
o AS (SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score FROM m)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM o QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op5_mixing": OP5.strip(),
    "op6_ann": OP6.strip(),
    "op7_line_dedup": OP7.strip(),
    "op9_exact_dedup": OP9.strip(),
    "op11_hard_negatives": OP11.strip(),
    "op12_collocations": OP12.strip(),
}

"""SQL of the registered queries, where SQL can express them."""
from __future__ import annotations

#: Integer inner products of the queries' vectors with all others; the contract in one statement.
TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT CAST(query_id AS BIGINT) AS query_id, rank, CAST(vec_id AS BIGINT) AS vec_id, score FROM ranked WHERE rank <= 5
"""

#: Distinct sets first; shingles of one set only cannot link; components by reachability among the linked sets.
JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_sort(list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
  FROM w
), sets AS MATERIALIZED (
  SELECT row_number() OVER () AS sid, s, len(s) AS n, min(doc_id) AS least FROM s WHERE len(s) > 0 GROUP BY s
), grams AS (
  SELECT sid, n, unnest(s) AS gram FROM sets
), links AS MATERIALIZED (
  SELECT a.sid AS a, b.sid AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.sid <> b.sid AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.sid, b.sid, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), named AS (
  SELECT x.s, least(min(x.least), coalesce(min(y.least), min(x.least))) AS component_id
  FROM sets x LEFT JOIN reach ON reach.a = x.sid LEFT JOIN sets y ON y.sid = reach.b GROUP BY x.s
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CAST(coalesce(named.component_id, s.doc_id) AS BIGINT) AS component_id
FROM s LEFT JOIN named ON named.s = s.s
"""

ORACLES = {"op3_topk_search": TOPK_SQL, "op11_jaccard_join": JACCARD_SQL}

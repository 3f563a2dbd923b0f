"""DuckDB SQL with the rows of the queries of this subpackage, where SQL can express them."""

OP9 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP6 = """
WITH RECURSIVE n AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
v AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM n
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) >= 0.9 * a.norm * b.norm),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS least FROM r GROUP BY a),
k AS (SELECT a, count(*) AS links FROM l GROUP BY a)
SELECT n.vec_id, coalesce(k.links, 0) AS n_links, least(n.vec_id, coalesce(c.least, n.vec_id)) AS component_id,
       least(n.vec_id, coalesce(c.least, n.vec_id)) = n.vec_id AS kept
FROM n LEFT JOIN c ON c.a = n.vec_id LEFT JOIN k ON k.a = n.vec_id
"""

OP8 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS h
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM w WHERE len(ws) >= 50)),
f AS (SELECT h, min(doc_id) AS least FROM s GROUP BY h),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS k FROM s JOIN f USING (h) WHERE doc_id > least),
k AS (SELECT doc_id, count(*) AS n, list(k) AS gone FROM g GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN ws ELSE
           list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(gone, i)), lambda i: ws[i]) END, ' ')
       ) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

SQL: dict[str, str] = {"op6_embedding_near_dedup": OP6, "op8_substring_dedup": OP8, "op9_warc": OP9}

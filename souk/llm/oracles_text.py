"""DuckDB SQL of the byte-exact removal of repeats."""

#: Every string of 100 bytes by its place; texts as hex, so bytes are pairs of digits.
REPEATS = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes,
    row_number() OVER (ORDER BY doc_id NULLS FIRST) AS doc
  FROM documents
), b AS (SELECT doc, x, n_bytes, unnest(range(0, n_bytes - 99, 500)) AS first FROM d WHERE n_bytes >= 100),
c AS (SELECT doc, first, substr(x, 2 * first + 1, 1198) AS part, least(500, n_bytes - 99 - first) AS n FROM b),
p AS (SELECT doc, first + k AS i, md5(substr(part, 2 * k + 1, 200)) AS h FROM (SELECT doc, first, part, unnest(range(n)) AS k FROM c)),
w AS (SELECT doc, i, row_number() OVER (PARTITION BY h ORDER BY doc, i) > 1 AS again FROM p),
marks AS (SELECT doc, i, lag(i) OVER (PARTITION BY doc ORDER BY i) AS before FROM w WHERE again),
runs AS (SELECT doc, i, sum(CASE WHEN before + 100 >= i THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY i) AS run FROM marks),
spans AS (SELECT doc, run, min(i) AS s, max(i) + 100 AS e FROM runs GROUP BY doc, run),
edges AS (SELECT doc, s, e, coalesce(lag(e) OVER (PARTITION BY doc ORDER BY s), 0) AS left_end FROM spans),
cut AS (
  SELECT d.doc, string_agg(substr(x, 2 * left_end + 1, 2 * (s - left_end)), '' ORDER BY s) || substr(any_value(x), 2 * max(e) + 1) AS kept,
    sum(e - s) AS n_removed, count(*) AS n_spans
  FROM edges JOIN d USING (doc) GROUP BY d.doc
)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc)"""

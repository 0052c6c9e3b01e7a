"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS plain
  FROM documents
), ranked AS (
  SELECT doc_id, plain,
         first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(body) DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY plain) AS group_size,
         row_number() OVER (PARTITION BY plain ORDER BY length(body) DESC, doc_id NULLS LAST) AS place
  FROM t
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(plain) AS text_sha256 FROM ranked
"""

NEAR_GROUPS = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT x, y FROM shared JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, e.y FROM reach r JOIN edge e ON e.x = r.y
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM documents d LEFT JOIN size s ON s.doc_id = d.doc_id JOIN reach r ON r.x = d.doc_id
GROUP BY d.doc_id, s.n
"""

def _words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words("text")} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_words("text")} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item, size, array_to_string(w[s:s + size - 1], ' ') AS gram
  FROM (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)
), dw AS (
  SELECT rid, s, size, array_to_string(w[s:s + size - 1], ' ') AS gram
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS s
        FROM d, (SELECT DISTINCT size FROM g) WHERE len(w) >= size)
), hit AS (SELECT DISTINCT dw.rid, dw.s, dw.size, g.item FROM dw JOIN g ON dw.size = g.size AND dw.gram = g.gram),
n_hit AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(s, s + size)) AS place FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.list, '')) AS items_sha256, coalesce(n_hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit ON n_hit.rid = d.rid LEFT JOIN items ON items.rid = d.rid
"""

ORACLE_SQL = {"op2_ngram_jaccard_join": NEAR_GROUPS, "op8_exact_dedup": EXACT_DEDUP, "op13_benchmark_decontamination": CONTAMINATION}

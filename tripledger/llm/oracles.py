"""DuckDB SQL for the queries that SQL can express."""


OP1 = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents
), hashed AS (
  SELECT *, md5(line) AS h, count(*) OVER (PARTITION BY doc_id) AS n,
         md5(lag(md5(line)) OVER (PARTITION BY doc_id ORDER BY i) || md5(line)) AS r
  FROM lines
), ends AS (
  SELECT *, coalesce(i BETWEEN 1 AND n - 3
         AND (i = 1 OR r < lag(r) OVER w) AND r <= lead(r) OVER w, false) AS ends
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
  FROM ends
), chunks AS (
  SELECT doc_id, chunk, min(i) AS first, string_agg(line, chr(10) ORDER BY i) AS body,
         count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) AS worded, count(*) AS m
  FROM numbered GROUP BY ALL
), repeats AS (
  SELECT doc_id, chunk, row_number() OVER (PARTITION BY body ORDER BY doc_id, first) > 1 AS again
  FROM chunks WHERE m > 1 AND worded > 1
), marked AS (
  SELECT x.*, coalesce(again, false) AS gone FROM numbered x LEFT JOIN repeats USING (doc_id, chunk)
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
       count(*) FILTER (gone) AS n_lines_removed
FROM marked GROUP BY doc_id
"""

OP12 = r"""
WITH asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), texts AS (
  SELECT doc_id, regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), sizes AS (
  SELECT doc_id, len(terms) AS n FROM texts WHERE len(terms) > 0
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes
), found AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(terms) AS term FROM texts)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM found, total GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total.terms))))::BIGINT AS score
  FROM asked JOIN found USING (term) JOIN weighed USING (term) JOIN sizes USING (doc_id), total
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES = {"op1_line_dedup": OP1, "op12_lexical_search": OP12}

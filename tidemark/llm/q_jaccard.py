"""Query 8: groups of similar `documents` by 4-word shingles at 0.85."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.jaccard_join import jaccard_groups
from tidemark.llm.registry import query, table

SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 3], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b USING (g) JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
  HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, link.b FROM r JOIN link ON r.b = link.a) SELECT * FROM r)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(min(reach.b), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id, n.n
"""


@query("op8_ngram_jaccard", SQL)
def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), n=4, num=85, den=100)

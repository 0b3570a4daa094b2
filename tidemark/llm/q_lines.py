"""Query 5: line dedup over `documents`, with `source` as the site."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.line_dedup import drop_boilerplate
from tidemark.llm.registry import query, table

SQL = r"""
WITH lines AS (
  SELECT doc_id, source, i, ln, regexp_matches(ln, '[^\x20\x09-\x0D]') AS has_word
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS ln,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
total AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
bad AS (SELECT source, trim(ln, ' ') AS k FROM lines JOIN total USING (source) WHERE has_word
        GROUP BY source, k HAVING count(DISTINCT doc_id) >= 5 AND count(DISTINCT doc_id) > 0.1 * any_value(n)),
marked AS (SELECT l.*, has_word AND bad.k IS NOT NULL AS gone
           FROM lines l LEFT JOIN bad ON l.source = bad.source AND trim(l.ln, ' ') = bad.k)
SELECT d.doc_id, coalesce(m.n_lines, 0)::BIGINT AS n_lines, coalesce(m.n_dropped, 0)::BIGINT AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN coalesce(m.kept, '') END AS text
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (has_word) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         string_agg(ln, chr(10) ORDER BY i) FILTER (NOT gone) AS kept
  FROM marked GROUP BY 1) m USING (doc_id)
"""


@query("op5_line_dedup", SQL)
def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs, host="source").select("doc_id", "n_lines", "n_dropped", "text")

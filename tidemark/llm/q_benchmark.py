"""Query 3: passages of `benchmark` in `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontamination import contaminated
from tidemark.llm.registry import query, table

SQL = r"""
WITH i AS (
  SELECT item_id, ws, len(ws) AS n, least(len(ws), 5) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x20\x09-\x0D]+') AS ws FROM benchmark) WHERE len(ws) > 0),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
ig AS (SELECT item_id, n, k, q, array_to_string(ws[q:q + k - 1], ' ') AS g
       FROM (SELECT item_id, ws, n, k, unnest(range(1, n - k + 2)) AS q FROM i)),
dg AS (SELECT doc_id, size, k, p, array_to_string(ws[p:p + k - 1], ' ') AS g
       FROM (SELECT doc_id, ws, len(ws) AS size, k, unnest(range(1, len(ws) - k + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT k FROM i))),
win AS (SELECT DISTINCT doc_id, item_id, n, k, greatest(1, least(p - q + 1, size - n + 1)) AS start FROM dg JOIN ig USING (g, k)),
pairs AS (  -- each window against all items of its length
  SELECT DISTINCT w.doc_id, w.start, w.k, w.n, i.item_id FROM win w JOIN i USING (n)),
wg AS (SELECT doc_id, start, n, g, count(*) AS c FROM (
         SELECT doc_id, start, n, array_to_string(t[j:j + k - 1], ' ') AS g FROM (
           SELECT doc_id, start, n, k, ws[start:start + n - 1] AS t, unnest(range(1, len(ws[start:start + n - 1]) - k + 2)) AS j
           FROM (SELECT DISTINCT doc_id, start, n, k FROM win) JOIN d USING (doc_id))) GROUP BY ALL),
wt AS (SELECT doc_id, start, n, sum(c) AS total FROM wg GROUP BY ALL),
ic AS (SELECT item_id, g, count(*) AS c FROM ig GROUP BY ALL),
it AS (SELECT item_id, sum(c) AS total FROM ic GROUP BY ALL),
both_ AS (
  SELECT p.doc_id, p.start, p.item_id, sum(least(wg.c, ic.c)) AS b, any_value(wt.total) + any_value(it.total) AS t
  FROM pairs p JOIN wg USING (doc_id, start, n) JOIN ic ON ic.item_id = p.item_id AND ic.g = wg.g
  JOIN wt USING (doc_id, start, n) JOIN it ON it.item_id = p.item_id GROUP BY ALL),
good AS (SELECT doc_id, item_id, start, b / (t - b) AS sim FROM both_ WHERE b * 100 >= (t - b) * 80)
SELECT doc_id, item_id, max(sim) AS similarity, (arg_max(start, (sim, -start)) - 1)::BIGINT AS first_word, count(*)::BIGINT AS n_windows
FROM good GROUP BY ALL
"""


@query("op3_benchmark_decontamination", SQL)
def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""Query 11: collocations of `documents`, the first 2,000 of each language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.phrase_mining import mine_phrases
from tidemark.llm.registry import query, table

SQL = r"""
WITH p AS (
  SELECT lang, unnest(list_transform(
      string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'),
      lambda x: regexp_extract_all(x, '[^\x20\x09]+'))) AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM p CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY 1),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cuts AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS cut FROM c),
s AS (
  SELECT cuts.lang, cuts.k, cuts.phrase, a, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score, cut
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[:cut], ' ')
            JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[cut + 1:], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sub AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS above
  FROM (SELECT lang, ws, a, m, unnest(range(1, k - m + 2)) AS i FROM c CROSS JOIN (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN sub USING (lang, phrase) WHERE above IS NULL OR 100 * above < 80 * a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op11_phrase_mining", SQL)
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents").select("lang", "text"))

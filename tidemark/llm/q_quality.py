"""Query 9: quality rules over `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.quality_rules import DEFAULT_RULES, Rule, base_counts, cascade
from tidemark.llm.registry import query, table

# The counts are columns of the result and so are made for every row; rules on them read those columns.
ON_COUNTS = {
    "few_words": lambda text, w: F.col("n_words") < 50,
    "many_words": lambda text, w: F.col("n_words") > 1_000_000,
    "word_length": lambda text, w: ~F.col("word_chars").between(2 * F.col("n_words"), 15 * F.col("n_words")),
    "symbols": lambda text, w: 10 * F.col("n_symbols") > F.col("n_words"),
    "repetition": lambda text, w: 2 * F.col("n_repeat_words") > F.col("n_words"),
}
RULES = tuple(Rule(r.name, ON_COUNTS.get(r.name, r.rejects)) for r in DEFAULT_RULES)

SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
grams AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, g FROM grams GROUP BY ALL HAVING count(*) > 1),
hit AS (SELECT doc_id, count(DISTINCT j) AS n
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM grams JOIN twice USING (doc_id, g)) GROUP BY 1),
c AS (
  SELECT w.doc_id, t, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
         coalesce(hit.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS letters,
         length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS capitals
  FROM w LEFT JOIN hit USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_words > 1000000
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words
            OR coalesce(n_dup_lines / nullif(n_lines, 0), 0) > 0.3
            OR coalesce(letters / nullif(word_chars, 0), 0) < 0.6
            OR coalesce(capitals / nullif(word_chars, 0), 0) > 0.5) AS kept
FROM c
"""


@query("op9_quality_rules", SQL)
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = base_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    judged = cascade(counted, RULES)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("kept")).alias("kept"),
    )

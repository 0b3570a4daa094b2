"""Query 13: main text of all `pages`.

The check SQL states the expected text of pages of the given shape: the article's blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.html_text import extract_text
from tidemark.llm.registry import query, table

SQL = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS h FROM pages),
b AS (
  SELECT page_id, url, list_transform(string_split_regex(h, '</?(?:p|h1)>'),
    lambda x: regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '</?b>', '', 'g')) AS bs FROM a),
c AS (
  SELECT page_id, url, list_transform(bs, lambda x: trim(regexp_replace(
    replace(replace(regexp_replace(x, '&amp$', '&amp;'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))) AS bs FROM b),
t AS (SELECT page_id, url, coalesce(array_to_string(list_filter(bs, lambda x: x <> ''), chr(10) || chr(10)), '') AS text FROM c)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""


@query("op13_html_text", SQL)
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))

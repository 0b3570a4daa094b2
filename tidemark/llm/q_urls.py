"""Query 10: dated URL lists over `pages`.

The tables hold no lists and no fetch times, so both come from `pages` by fixed rules: a page is
fetched on a day of 2024 given by its id; a host, or a host with its first path segment, is listed
and unlisted on days given by the md5 of its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.url_filter import filter_urls, host_of

START = "2024-01-01"

SQL = r"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host,
         lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)) AS path,
         DATE '2024-01-01' + ((page_id * 37) % 366)::INTEGER AS fetched
  FROM pages),
names AS (
  SELECT DISTINCT unnest([host, host || '/' || split_part(path, '/', 2)]) AS pattern FROM p),
v AS (
  SELECT pattern, ('0x' || substr(md5(pattern), 1, 2))::INTEGER AS a, ('0x' || substr(md5(pattern), 3, 2))::INTEGER AS b,
         ('0x' || substr(md5(pattern), 5, 2))::INTEGER AS c FROM names),
events AS (
  SELECT pattern, DATE '2024-01-01' + b AS day, true AS listed FROM v WHERE a < 128
  UNION ALL SELECT pattern, DATE '2024-01-01' + b + 1 + c, false FROM v WHERE a < 96
  UNION ALL SELECT pattern, DATE '2024-01-01' + b + 30 + c, true FROM v WHERE a < 32),
state AS (
  SELECT page_id, pattern, day, listed, fetched,
         row_number() OVER (PARTITION BY page_id, pattern ORDER BY day DESC) AS rn
  FROM p JOIN events ON day <= fetched
   AND (host = split_part(pattern, '/', 1) OR ends_with(host, '.' || split_part(pattern, '/', 1)))
   AND (NOT contains(pattern, '/') OR path || '/' LIKE '/' || split_part(pattern, '/', 2) || '/%')),
best AS (
  SELECT page_id, count(*) AS n, arg_min(pattern, (-length(pattern), pattern)) AS pattern,
         arg_min(day, (-length(pattern), pattern)) AS since
  FROM state WHERE rn = 1 AND listed GROUP BY 1)
SELECT p.page_id, n IS NOT NULL AS blocked, coalesce(n, 0)::BIGINT AS n_active, pattern, strftime(since, '%Y-%m-%d') AS listed_since
FROM p LEFT JOIN best USING (page_id)
"""


def _digits(name: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(name), at, 2), 16, 10).cast("int")


def dated_lists(pages: DataFrame) -> DataFrame:
    """Rows (pattern, at, listed) made from the hosts and first path segments of `pages`."""
    segment = F.regexp_extract("url", r"^[a-z]+://[^/?#]*/([^/?#]*)", 1)
    patterns = pages.select(
        F.explode(F.array(host_of(F.col("url")), F.concat_ws("/", host_of(F.col("url")), F.lower(segment)))).alias("pattern")
    ).where(F.col("pattern").isNotNull())
    name = F.col("pattern")
    v = patterns.distinct().select(name, _digits(name, 1).alias("a"), _digits(name, 3).alias("b"), _digits(name, 5).alias("c"))
    event = lambda days, listed: F.struct(F.date_add(F.lit(START).cast("date"), days).alias("at"), F.lit(listed).alias("listed"))
    events = F.array_compact(
        F.array(
            F.when(F.col("a") < 128, event(F.col("b"), True)),
            F.when(F.col("a") < 96, event(F.col("b") + 1 + F.col("c"), False)),
            F.when(F.col("a") < 32, event(F.col("b") + 30 + F.col("c"), True)),
        )
    )
    return v.select("pattern", F.explode(events).alias("e")).select("pattern", "e.at", "e.listed")


@query("op10_url_filters", SQL)
def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    day = F.date_add(F.lit(START).cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int"))
    found = filter_urls(pages.withColumn("fetched_at", day), dated_lists(pages), key="page_id")
    return found.withColumn("listed_since", F.date_format("listed_since", "yyyy-MM-dd"))

"""Line dedup by site-relative frequency, in DataFrame functions only.

A line of a site is boilerplate when more than `max_ratio` of the site's pages hold it, and at
least `min_pages` pages do. Boilerplate lines are taken out of every page of that site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textcols import free_name
from tidemark.sizing import counted_side

MAX_RATIO = 0.1
MIN_PAGES = 5
BROADCAST_SITES = 10_000
BROADCAST_LINES = 100_000


def line_key(line: Column) -> Column:
    """128 bits that stand for a line; trailing and leading white space does not count."""
    line = F.trim(line)
    return F.concat(F.hex(F.xxhash64(line)), F.hex(F.xxhash64(F.lit("second"), line)))


def line_keys(text: Column) -> Column:
    """Keys of the lines with a word, in order."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.transform(F.filter(lines, _has_word), line_key)


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(docs: DataFrame, host: str, text: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Rows (host, key, pages, total): the lines to drop, per host.

    Pages are counted before the shuffle (one row per host, line and task), so a host with a third
    of all pages costs no more than its distinct lines. Null hosts are one host of their own.
    """
    named = docs.select(F.col(f"`{host}`").cast("string").alias("host"), F.col(f"`{text}`").cast("string").alias("text"))
    totals = named.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    pages = (
        named.select("host", F.explode(F.array_distinct(line_keys(F.col("text")))).alias("key"))
        .groupBy("host", "key")
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    few_totals = counted_side(totals, BROADCAST_SITES).select(F.col("host").alias("site"), "total")
    return (
        pages.join(few_totals, F.col("host").eqNullSafe(F.col("site")))
        .where(F.col("pages") > max_ratio * F.col("total"))
        .select("host", "key", "pages", "total")
    )


def drop_boilerplate(
    docs: DataFrame, host: str, text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """`docs` with its text freed of the site's boilerplate, and `n_lines` and `n_dropped`.

    n_lines counts lines with a word; lines without one are never dropped. Null texts stay null
    with 0 lines. Every row is judged by itself, so repeated rows come out repeated (and count
    as pages). An empty table gives an empty result. Columns n_lines and n_dropped of `docs` give
    way to the new ones.

    The lines to drop of one host are at most (mean lines per page) / `max_ratio`, so they are
    joined as one array per host; that side is broadcast only when counted small.
    """
    found = boilerplate(docs, host, text, max_ratio, min_pages)
    small = counted_side(found.select("host", "key"), BROADCAST_LINES)
    site, drop = free_name(docs, "site"), free_name(docs, "drop")
    per_host = small.groupBy(F.col("host").alias(site)).agg(F.collect_list("key").alias(drop))
    per_host = counted_side(per_host, BROADCAST_SITES)
    body = F.col(f"`{text}`").cast("string")
    joined = docs.drop("n_lines", "n_dropped").join(
        per_host, F.col(f"`{host}`").cast("string").eqNullSafe(F.col(site)), "left"
    )
    lines = F.split(body, "\n")
    kept = F.filter(lines, lambda x: ~_has_word(x) | ~F.array_contains(F.col(drop), line_key(x)))
    cleaned = F.when(F.col(drop).isNull(), body).otherwise(F.array_join(kept, "\n"))
    n_lines = F.coalesce(F.size(F.filter(lines, _has_word)), F.lit(0))
    n_dropped = F.when(F.col(drop).isNull(), F.lit(0)).otherwise(F.coalesce(F.size(lines) - F.size(kept), F.lit(0)))
    out = joined.withColumns({"n_lines": n_lines.cast("long"), "n_dropped": n_dropped.cast("long")})
    return out.withColumn(text, cleaned).drop(site, drop)

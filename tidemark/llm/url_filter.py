"""URL filters with dated lists: which captures were on a list when they were fetched.

List entries are dated events: from `at` on, `pattern` is on the list (`listed` true) or off it
again. They become validity intervals, and an as-of join judges every capture by the entries in
force at its fetch time. A pattern is a host (it covers its subdomains) or a host with a path
prefix of whole segments, such as `example.com/ads`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.textcols import free_name
from tidemark.sizing import counted_side

BROADCAST_ENTRIES = 50_000


def intervals(events: DataFrame) -> DataFrame:
    """Rows (pattern, valid_from, valid_to) from rows (pattern, at, listed); valid_to is open.

    Events without pattern or time say nothing and are left out. Of several events of a pattern
    at one time the one that lists it wins; an event that repeats the state before it changes
    nothing. An interval that never ends has a null valid_to.
    """
    one = (
        events.where(F.col("pattern").isNotNull() & F.col("at").isNotNull())
        .groupBy(F.lower("pattern").alias("pattern"), "at")
        .agg(F.max(F.coalesce("listed", F.lit(False))).alias("listed"))
    )
    line = Window.partitionBy("pattern").orderBy("at")
    turns = one.withColumn("was", F.lag("listed", 1, False).over(line)).where(F.col("listed") != F.col("was"))
    ended = turns.withColumn("valid_to", F.lead("at").over(line))
    return ended.where("listed").select("pattern", F.col("at").alias("valid_from"), "valid_to")


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; null where there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\\]*)", 1)
    host = F.regexp_replace(F.regexp_replace(rest, r"^.*@", ""), r":\d*$", "")
    host = F.regexp_replace(F.lower(host), r"\.+$", "")
    return F.when(host != "", host)


def keys_of(url: Column, max_segments: int) -> Column:
    """All patterns that could cover `url`: each host suffix, alone and with each path prefix of at most `max_segments`."""
    host = host_of(url)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#\\]*([^?#]*)", 1)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    parts = F.slice(F.array_remove(F.split(F.lower(path), "/"), ""), 1, max_segments)
    paths = F.concat(
        F.array(F.lit("")),
        F.transform(
            F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts))).otherwise(F.array().cast("array<int>")),
            lambda i: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")),
        ),
    )
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(paths, lambda p: F.concat(s, p))))
    return F.when(host.isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(both))


def filter_urls(captures: DataFrame, events: DataFrame, key: str, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """One row per `key` of `captures`: blocked, n_active, pattern, listed_since.

    `pattern` is the longest entry in force at the fetch time (ties: the smaller text),
    `listed_since` its start, `n_active` how many entries were in force. An entry is in force from
    its start on and before its end. Captures without host, fetch time or match are not blocked
    and keep their row. Rows that share a `key` are one capture with several addresses.

    A capture has at most (host labels) x (segments of the list's longest path + 1) keys, so the exploded side grows with
    the captures only. The list goes out by broadcast if counted small; else the captures are
    shuffled by pattern, where adaptive execution splits the patterns of a hot host. Matches are
    then brought to one row per capture by an aggregate that combines before its shuffle.
    """
    spans = intervals(events)
    deepest = events.where(F.col("pattern").isNotNull()).agg(F.max(F.size(F.split("pattern", "/")) - 1).alias("n")).first()["n"] or 0
    asked = captures.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{fetched}`").alias("fetched"), keys_of(F.col(f"`{url}`").cast("string"), deepest).alias("ks")
    )
    side = counted_side(spans, BROADCAST_ENTRIES)
    exploded = asked.select("key", "fetched", F.explode("ks").alias("asked"))
    active = exploded.join(
        side,
        (F.col("asked") == F.col("pattern"))
        & (F.col("fetched") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to"))),
    )
    best = active.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_active"),
        F.min(F.struct((-F.length("pattern")).alias("len"), "pattern", "valid_from")).alias("best"),
    )
    rows = captures.select(F.col(f"`{key}`").alias("key")).distinct()
    return (
        rows.join(best.withColumnRenamed("key", "k"), F.col("key").eqNullSafe(F.col("k")), "left")
        .select(
            F.col("key").alias(key),
            F.coalesce(F.col("n_active") > 0, F.lit(False)).alias("blocked"),
            F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
            F.col("best.pattern").alias("pattern"),
            F.col("best.valid_from").alias("listed_since"),
        )
    )

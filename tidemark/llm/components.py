"""Connected components of a table of links, and tables written between steps."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sizing import shared_dir, shuffles_dropped

BROADCAST_ROWS = 500_000


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Jobs run inside send texts to Python `rows` at a time, so that a batch of long texts stays small."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    if not 0 < int(before) < rows:
        spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: its lineage ends there."""
    path = shared_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of a few numbers a row, to be broadcast if it has at most `limit` rows."""
    return F.broadcast(df) if df.count() <= limit else df


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for all nodes of `links` (columns a, b); component is the smallest node.

    Every round hooks each node to its least neighbour, if that is smaller, and then to that one's own
    hook, and contracts the links to what they were hooked to. At least half of the nodes go in a round,
    so all rounds together are a small multiple of the first. Hooks of one hub are combined before the
    shuffle; joins on a hub's key are split by adaptive execution. Nothing goes to the driver but
    whether links are left.
    """
    edges = links.select("a", "b").where("a <> b")
    steps = []
    while True:
        both = written(edges.union(edges.select(F.col("b"), F.col("a"))).distinct(), "links")
        if steps and not both.limit(1).count():
            break
        hooks = written(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("hook")), "hooks")
        next_hook = hooks.select(F.col("node").alias("hook"), F.col("hook").alias("component"))
        step = written(hooks.join(next_hook, "hook").select("node", "component"), "step")
        steps.append(step)
        ends = both.where("a < b")
        for end in ("a", "b"):
            to = step.select(F.col("node").alias(end), F.col("component").alias("to"))
            ends = ends.join(to, end).drop(end).withColumnRenamed("to", end)
        edges = ends.where("a <> b").select("a", "b")
    labels = steps[0]
    for step in steps[1:]:
        later = sized(step.select(F.col("node").alias("component"), F.col("component").alias("lower")))
        labels = labels.join(later, "component", "left").select("node", F.coalesce("lower", "component").alias("component"))
    return written(labels, "labels") if len(steps) > 1 else labels

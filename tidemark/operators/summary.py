"""Counts of a telemetry table and of prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import share


def node_summary(df: DataFrame, key: str = "node_id", label: str = "is_anomaly") -> DataFrame:
    """Rows, anomalies and anomaly percentage per node, and in total (NULL key), in one pass."""
    rows, hits = F.count(F.lit(1)), F.count_if(F.col(label) == 1)
    return df.rollup(key).agg(
        rows.alias("rows"), hits.alias("anomalies"), (share(hits, rows) * 100).alias("anomaly_pct")
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their share of all, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(column, "count", share(F.col("count"), total).alias("share")).orderBy(F.desc("count"), column)


def key_counts(df: DataFrame, key: str = "node_id") -> DataFrame:
    """Number of rows and of distinct keys."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(key).alias("keys")
    )


def routing_counts(df: DataFrame) -> DataFrame:
    """Rows per model that answered."""
    return df.groupBy("model_used").agg(F.count(F.lit(1)).alias("count"))


def batch_totals(df: DataFrame, batch: list[str], flag: str = "is_anomaly") -> DataFrame:
    """Records and anomalies per batch."""
    return df.groupBy(*batch).agg(F.count(F.lit(1)).alias("total"), F.sum(flag).alias("anomaly_count"))


def prediction_rates(df: DataFrame, groups: list[str], flag: str, failed: str) -> DataFrame:
    """Anomaly and error rate over the rows there are; 0 for none."""
    total = F.count(F.lit(1))
    return df.groupBy(*groups).agg(
        total.alias("total_requests"),
        share(F.count_if(F.col(flag) == 1), total).alias("anomaly_rate"),
        share(F.count_if(F.col(failed) == 1), total).alias("error_rate"),
    )


def standard_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation per column, one row per column."""
    one = df.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}__std") for c in columns]
    )
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
        for c in columns
    ]
    return one.select(F.inline(F.array(*pairs)))


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in every given column."""
    return df.na.drop(subset=columns)


def only_normal(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    return df.where(F.col(label) == 0)


def only_anomalies(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    return df.where(F.col(label) == 1)

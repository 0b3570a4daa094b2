"""Registry of queries and the binding of the given tables to telemetry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Order of rows within a node; total at every scale of the test data.
TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
ORDER = ["timestamp", *TIES]
ROW_KEY = ["node_id", "l_orderkey", "l_linenumber", "l_partkey"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with check SQL where SQL can express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as node telemetry: one row per line, nodes are suppliers."""
    return telemetry_of(table(spark, sf_dir, "lineitem"))


def telemetry_of(lines: DataFrame) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    return lines.select(
        F.col("l_shipdate").alias("timestamp"),
        F.concat(F.lit("node-"), F.col("l_suppkey").cast("string")).alias("node_id"),
        (F.col("l_extendedprice") / 1000).alias("latency_ms"),
        (F.col("l_discount") * 100).alias("packet_loss_pct"),
        (F.col("l_quantity") * 2).alias("cpu_utilization"),
        F.try_divide("l_extendedprice", "l_quantity").alias("bandwidth_mbps"),
        (F.col("l_tax") * 100).alias("error_rate"),
        F.when(returned, 1).otherwise(0).alias("is_anomaly"),
        F.when(returned, "spike").otherwise("none").alias("anomaly_type"),
        *TIES,
    )


TELEMETRY_SQL = """telemetry AS (
  SELECT l_shipdate AS ts, 'node-' || l_suppkey AS node_id,
         l_extendedprice / 1000 AS latency_ms, l_discount * 100 AS packet_loss_pct,
         l_quantity * 2 AS cpu_utilization, l_extendedprice / l_quantity AS bandwidth_mbps,
         l_tax * 100 AS error_rate,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_anomaly,
         CASE WHEN l_returnflag = 'R' THEN 'spike' ELSE 'none' END AS anomaly_type,
         l_orderkey, l_linenumber, l_partkey, l_extendedprice
  FROM lineitem)"""

ORDER_SQL = "ts, l_orderkey, l_linenumber, l_partkey, l_extendedprice"


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a two-metric series per user, at true event times."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("node_id"),
        F.col("ts").alias("timestamp"),
        "event_id",
        F.col("value").alias("latency_ms"),
        F.get_json_object("props", "$.k").cast("double").alias("cpu_utilization"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_anomaly"),
        "event_type",
    )


EVENTS_SQL = """series AS (
  SELECT 'user-' || user_id AS node_id, ts, event_id, value AS latency_ms,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS cpu_utilization,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_anomaly, event_type
  FROM events)"""


def shown(c: Column | str, digits: int = 4) -> Column:
    """Round for comparison. The small shift keeps exact decimal ties on one side in every engine."""
    c = F.col(c) if isinstance(c, str) else c
    scale = 10.0**digits
    return F.floor(c * F.lit(scale) + F.lit(0.5000001)).cast("double") / F.lit(scale)


def shown_sql(expr: str, digits: int = 4) -> str:
    scale = 10**digits
    return f"floor(({expr}) * {scale}.0::DOUBLE + 0.5000001::DOUBLE) / {scale}.0::DOUBLE"


def rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Apply `shown` to the named columns."""
    return df.select(*[shown(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


METRICS = schema.METRICS

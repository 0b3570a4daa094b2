"""Feature families over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import features as ops
from workload.base import (
    EVENTS_SQL,
    METRICS,
    ORDER,
    ORDER_SQL,
    TELEMETRY_SQL,
    TIES,
    event_series,
    query,
    rounded,
    shown_sql,
    telemetry,
    with_sql,
)

IDS = ["node_id", "l_orderkey", "l_linenumber", "l_partkey"]
FRAMES = {"5min": 4, "15min": 14, "1hr": 59}


def _frame(name: str, back: int, order: str = ORDER_SQL) -> str:
    return f"{name} AS (PARTITION BY node_id ORDER BY {order} ROWS BETWEEN {back} PRECEDING AND CURRENT ROW)"


def _windows(order: str = ORDER_SQL) -> str:
    frames = [_frame(f"w_{k}", v, order) for k, v in FRAMES.items()]
    frames += [_frame("w_30", 29, order), f"w AS (PARTITION BY node_id ORDER BY {order})"]
    return "WINDOW " + ", ".join(frames)


def _rolling_sql(m: str) -> list[str]:
    out = []
    for label in FRAMES:
        out.append(f"{shown_sql(f'avg({m}) OVER w_{label}')} AS {m}_roll_mean_{label}")
        out.append(f"{shown_sql(f'coalesce(stddev_samp({m}) OVER w_{label}, 0)')} AS {m}_roll_std_{label}")
        out.append(f"{shown_sql(f'max({m}) OVER w_{label}')} AS {m}_roll_max_{label}")
    return out


def _delta_sql(m: str) -> list[str]:
    one = f"coalesce({m} - lag({m}, 1) OVER w, 0)"
    return [
        f"{shown_sql(one)} AS {m}_delta_1m",
        f"{shown_sql(f'coalesce({m} - lag({m}, 5) OVER w, 0)')} AS {m}_delta_5m",
        f"{shown_sql(f'abs({one})')} AS {m}_abs_delta_1m",
    ]


def zscore_sql(m: str) -> str:
    std = f"coalesce(stddev_samp({m}) OVER w_1hr, 0)"
    z = f"CASE WHEN count({m}) OVER w_1hr >= 10 AND {std} > 0 THEN ({m} - avg({m}) OVER w_1hr) / {std} ELSE 0 END"
    return f"{shown_sql(z)} AS {m}_zscore"


_CORR = (
    "CASE WHEN count(*) FILTER (latency_ms IS NOT NULL AND cpu_utilization IS NOT NULL) OVER w_30 >= 10 "
    "AND NOT isnan(coalesce(corr(latency_ms, cpu_utilization) OVER w_30, 0)) "
    "THEN coalesce(corr(latency_ms, cpu_utilization) OVER w_30, 0) ELSE 0 END"
)
_CROSS = [
    f"{shown_sql('latency_ms * packet_loss_pct')} AS latency_x_loss",
    f"{shown_sql('CASE WHEN bandwidth_mbps > 0 THEN cpu_utilization / bandwidth_mbps ELSE 0 END')} AS cpu_bw_ratio",
    f"{shown_sql('CASE WHEN cpu_utilization > 0 THEN error_rate / cpu_utilization * 100 ELSE 0 END')} AS error_per_cpu",
    f"{shown_sql(_CORR)} AS latency_cpu_corr_30m",
]
_CALENDAR = [
    "CAST(hour(ts) AS INTEGER) AS hour",
    "CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week",
    "CAST(hour(ts) BETWEEN 8 AND 18 AS INTEGER) AS is_business_hours",
    "CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend",
]


def _sql(columns: list[str]) -> str:
    return with_sql(TELEMETRY_SQL) + f"SELECT {', '.join(IDS + columns)} FROM telemetry {_windows()}"


def _all_sql() -> str:
    cols = [c for m in METRICS for c in _rolling_sql(m)]
    cols += [c for m in METRICS for c in _delta_sql(m)]
    cols += _CROSS + [zscore_sql(m) for m in METRICS] + _CALENDAR
    return _sql(cols)


def _family(spark: SparkSession, sf_dir: str, families: set[str]) -> DataFrame:
    out = ops.compute_features(telemetry(spark, sf_dir), order=ORDER, families=families)
    names = ops.output_columns(METRICS, families)
    return rounded(out.select(*IDS, *names), [n for n in names if n not in schema.CALENDAR])


@query("features_all", _all_sql())
def features_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _family(spark, sf_dir, set(ops.ALL_FAMILIES))


@query("features_all_split_series", _all_sql())
def features_all_split_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table on the plan for hot nodes: every node is cut into slots of about 150 rows."""
    out = ops.compute_features(
        telemetry(spark, sf_dir), order=ORDER, target_rows=150, small_bytes=0
    )
    names = ops.output_columns(METRICS)
    return rounded(out.select(*IDS, *names), [n for n in names if n not in schema.CALENDAR])


@query("rolling_mean_std_max", _sql([c for m in METRICS for c in _rolling_sql(m)]))
def rolling_mean_std_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _family(spark, sf_dir, {"rolling"})


@query("rate_of_change", _sql([c for m in METRICS for c in _delta_sql(m)]))
def rate_of_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _family(spark, sf_dir, {"delta"})


@query("cross_metric_features", _sql(_CROSS))
def cross_metric_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _family(spark, sf_dir, {"cross"})


@query("zscore_features", _sql([zscore_sql(m) for m in METRICS]))
def zscore_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _family(spark, sf_dir, {"zscore"})


@query(
    "calendar_features",
    with_sql(EVENTS_SQL) + f"SELECT event_id, {', '.join(_CALENDAR)} FROM series",
)
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = event_series(spark, sf_dir)
    return series.select(
        "event_id", *[c.alias(n) for n, c in ops.calendar_columns(F.col("timestamp")).items()]
    )


@query(
    "event_series_features",
    with_sql(EVENTS_SQL)
    + "SELECT event_id, "
    + ", ".join(
        [c for m in ("latency_ms", "cpu_utilization") for c in _rolling_sql(m) + _delta_sql(m) + [zscore_sql(m)]]
        + [f"{shown_sql(_CORR)} AS latency_cpu_corr_30m"]
    )
    + f" FROM series {_windows('ts, event_id')}",
)
def event_series_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling, change, z-score and correlation features of the two-metric event series."""
    metrics = ["latency_ms", "cpu_utilization"]
    families = {"rolling", "delta", "cross", "zscore"}
    out = ops.compute_features(
        event_series(spark, sf_dir), order=["timestamp", "event_id"], metrics=metrics, families=families
    )
    names = ops.output_columns(metrics, families)
    return rounded(out.select("event_id", *names), names)


@query(
    "feature_family_counts",
    with_sql(TELEMETRY_SQL)
    + """SELECT family, CAST(features AS BIGINT) AS features,
         CAST(features * (SELECT count(*) FROM telemetry) AS BIGINT) AS known_values
       FROM (VALUES ('raw', 5), ('rolling', 45), ('delta', 15), ('cross', 4), ('zscore', 5), ('calendar', 4))
            AS f(family, features)""",
)
def feature_family_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ops.compute_features(telemetry(spark, sf_dir), order=ORDER).drop(*TIES)
    return ops.family_counts(out, schema.feature_columns(out.columns))

"""Names and types of the telemetry model."""

from __future__ import annotations

from pyspark.sql import types as T

# Metric names, calendar columns and label columns of the data model.
METRICS = ["latency_ms", "packet_loss_pct", "cpu_utilization", "bandwidth_mbps", "error_rate"]
CALENDAR = ["hour", "day_of_week", "is_business_hours", "is_weekend"]
NOT_FEATURES = ["timestamp", "node_id", "is_anomaly", "anomaly_type"]

# Rolling frames (label -> rows).
ROLLING_ROWS = {"5min": 5, "15min": 15, "1hr": 60}
CORRELATION_ROWS = 30
ZSCORE_ROWS = 60
MIN_ROWS = 10

TELEMETRY = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("node_id", T.StringType()),
        *[T.StructField(m, T.DoubleType()) for m in METRICS],
        T.StructField("is_anomaly", T.IntegerType()),
        T.StructField("anomaly_type", T.StringType()),
    ]
)

REQUEST = T.StructType([T.StructField(m, T.DoubleType()) for m in METRICS])
REQUEST_BATCH = T.StructType([T.StructField("records", T.ArrayType(REQUEST))])

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("step", T.IntegerType()),
    ]
)


def feature_columns(columns: list[str], extra: list[str] | None = None) -> list[str]:
    """Columns that are model inputs: everything but keys and labels."""
    skip = {*NOT_FEATURES, *(extra or [])}
    return [c for c in columns if c not in skip]

"""The 73 derived features of a telemetry table: rolling, change, cross-metric, z-score, calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions.expr import nan_to_null, ratio_or_zero
from tidemark.operators.rolling import Rolling
from tidemark.operators.series import TARGET_ROWS, over_series

LOOKBACK = max(*schema.ROLLING_ROWS.values(), schema.ZSCORE_ROWS, schema.CORRELATION_ROWS) - 1


def clean_metrics(df: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """NaN to NULL for the metric columns present."""
    present = [m for m in (metrics or schema.METRICS) if m in df.columns]
    return df.withColumns({m: nan_to_null(m) for m in present})


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Hour, weekday (0 = Monday), business hours (8 to 18 inclusive) and weekend flags."""
    hour, day = F.hour(ts), F.weekday(ts)
    return {
        "hour": hour,
        "day_of_week": day,
        "is_business_hours": hour.between(8, 18).cast("int"),
        "is_weekend": (day >= 5).cast("int"),
    }


# Inputs of the cross-metric columns of one row.
CROSS_INPUTS = {
    "latency_x_loss": {"latency_ms", "packet_loss_pct"},
    "cpu_bw_ratio": {"cpu_utilization", "bandwidth_mbps"},
    "error_per_cpu": {"error_rate", "cpu_utilization"},
}


def cross_names(available: list[str]) -> list[str]:
    return [n for n, inputs in CROSS_INPUTS.items() if inputs <= set(available)]


def cross_columns(available: list[str]) -> dict[str, Column]:
    """Products and ratios of metrics of the same row, as far as their inputs are there."""
    columns = {
        "latency_x_loss": F.col("latency_ms") * F.col("packet_loss_pct"),
        "cpu_bw_ratio": ratio_or_zero("cpu_utilization", "bandwidth_mbps"),
        "error_per_cpu": ratio_or_zero("error_rate", "cpu_utilization", 100.0),
    }
    return {n: columns[n] for n in cross_names(available)}


def feature_columns(
    df: DataFrame,
    partition: list[str],
    order: list[str],
    metrics: list[str],
    families: set[str],
) -> DataFrame:
    """Add the feature families to `df`; all lags share one window sort."""
    keep = df.columns
    framed = bool(families & {"rolling", "zscore"})
    paired = "cross" in families and {"latency_ms", "cpu_utilization"} <= set(metrics)
    values = {m: m for m in metrics} if framed else {}
    pairs = {}
    if paired:
        values["pair_x"] = "CASE WHEN cpu_utilization IS NOT NULL THEN latency_ms END"
        values["pair_y"] = "CASE WHEN latency_ms IS NOT NULL THEN cpu_utilization END"
        pairs["pair"] = ("pair_x", "pair_y")
    roll = Rolling(partition, order, values, pairs)

    derived: dict[str, str] = {}
    if "delta" in families:
        df = df.selectExpr("*", *roll.lags(metrics, [1, 5]))
        changes = {f"{m}_delta_{k}m": f"coalesce({m} - _ago{k}.{m}, 0D)" for m in metrics for k in (1, 5)}
        df = df.selectExpr(*keep, *[f"{e} AS {n}" for n, e in changes.items()])
        derived |= {n: n for n in changes}
        derived |= {f"{m}_abs_delta_1m": f"abs({m}_delta_1m)" for m in metrics}
    if values:
        short, middle, long = schema.ROLLING_ROWS.values()
        df = roll.base(df, short)
        df = roll.extend(df, short, [middle])
        df = roll.extend(df, middle, ([long] if framed else []) + ([schema.CORRELATION_ROWS] if paired else []))
    if framed:
        stds = {(m, rows): f"{m}_roll_std_{label}" for m in metrics for label, rows in schema.ROLLING_ROWS.items()}
        df = df.selectExpr("*", *[f"{roll.std(m, rows)} AS {n}" for (m, rows), n in stds.items()])
        if "rolling" in families:
            for m in metrics:
                for label, rows in schema.ROLLING_ROWS.items():
                    derived[f"{m}_roll_mean_{label}"] = roll.stat(m, "mean", rows)
                    derived[f"{m}_roll_std_{label}"] = stds[m, rows]
                    derived[f"{m}_roll_max_{label}"] = roll.stat(m, "max", rows)
        if "zscore" in families:
            for m in metrics:
                std = stds[m, schema.ZSCORE_ROWS]
                derived[f"{m}_zscore"] = roll.zscore(m, std, schema.ZSCORE_ROWS, schema.MIN_ROWS)
    if paired:
        derived["latency_cpu_corr_30m"] = roll.correlation("pair", schema.CORRELATION_ROWS, schema.MIN_ROWS)
    columns = {n: F.expr(e) for n, e in derived.items()}
    if "cross" in families:
        columns |= cross_columns(keep)
    if "calendar" in families:
        columns |= calendar_columns(F.col("timestamp"))
    return df.select(*keep, *[columns[n].alias(n) for n in output_columns(metrics, families)])


ALL_FAMILIES = frozenset({"rolling", "delta", "cross", "zscore", "calendar"})


def output_columns(metrics: list[str], families: set[str] | frozenset[str] = ALL_FAMILIES) -> list[str]:
    """Names of the derived features in their documented order."""
    names: list[str] = []
    if "rolling" in families:
        names += [
            f"{m}_roll_{stat}_{label}"
            for m in metrics
            for label in schema.ROLLING_ROWS
            for stat in ("mean", "std", "max")
        ]
    if "delta" in families:
        names += [f"{m}_{d}" for m in metrics for d in ("delta_1m", "delta_5m", "abs_delta_1m")]
    if "cross" in families:
        names += cross_names(metrics)
        if {"latency_ms", "cpu_utilization"} <= set(metrics):
            names.append("latency_cpu_corr_30m")
    if "zscore" in families:
        names += [f"{m}_zscore" for m in metrics]
    if "calendar" in families:
        names += schema.CALENDAR
    return names


def compute_features(
    df: DataFrame,
    *,
    key: str = "node_id",
    order: list[str] | None = None,
    metrics: list[str] | None = None,
    families: set[str] | frozenset[str] = ALL_FAMILIES,
    target_rows: int = TARGET_ROWS,
    small_bytes: int | None = None,
) -> DataFrame:
    """Feature table of a telemetry table: its columns followed by the derived ones.

    `order` must be a total order within a series (timestamp, then tie breakers).
    Frames count rows, not minutes; a gap in time is not filled.
    """
    order = order or ["timestamp"]
    metrics = metrics or schema.METRICS
    inputs = df.columns

    def build(frame: DataFrame, partition: list[str]) -> DataFrame:
        return feature_columns(frame, partition, order, metrics, set(families))

    out = over_series(clean_metrics(df, metrics), key, order, LOOKBACK, build, target_rows, small_bytes)
    return out.select(*inputs, *output_columns(metrics, families))


def family_of(name: Column) -> Column:
    """Feature family by column-name pattern."""
    return (
        F.when(name.contains("roll_"), "rolling")
        .when(name.contains("delta_"), "delta")
        .when(name.contains("zscore"), "zscore")
        .when(name.isin(*schema.CALENDAR), "calendar")
        .when(name.rlike("_x_|_ratio|_per_|_corr_"), "cross")
        .otherwise("raw")
    )


def family_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of features and of known values per family."""
    known = df.agg(*[F.count(c).alias(c) for c in columns])
    long = known.unpivot([], columns, "feature", "known")
    return long.groupBy(family_of(F.col("feature")).alias("family")).agg(
        F.count(F.lit(1)).alias("features"), F.sum("known").alias("known_values")
    )

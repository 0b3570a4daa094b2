"""Prediction-log monitor, thresholds and the rollback decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions.expr import share
from tidemark.operators.ecdf import percentiles
from tidemark.plans.registry import latest_run, rollback_target

# Latency target and monitoring limits.
SLA_P99_MS = 100.0
LIMITS = {"latency_p99_ms": 100.0, "anomaly_rate": 0.50, "error_rate": 0.05}
LATENCY_POINTS = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}


def latency_stats(
    log: DataFrame, groups: list[str], latency: str, small_bytes: int | None = None, beside: dict[str, Column] | None = None
) -> DataFrame:
    """p50, p95, p99 (linear interpolation), mean, max and min, rounded to 3 digits, and the aggregates `beside`.

    Exact at every size, in one pass over small inputs; beyond them the percentiles come from binned
    running totals.
    """
    moments = {"mean_ms": F.avg(latency), "max_ms": F.max(latency), "min_ms": F.min(latency)}
    found = percentiles(log, groups, latency, LATENCY_POINTS, beside={**moments, **(beside or {})}, small_bytes=small_bytes)
    numbers = [*LATENCY_POINTS, *moments]
    return found.select(*groups, *[F.round(c, 3).alias(c) for c in numbers], *(beside or {}))


def log_monitor(
    log: DataFrame, groups: list[str], latency: str, flag: str, failed: str, small_bytes: int | None = None
) -> DataFrame:
    """Latency statistics, request count, anomaly and error rate and SLA flag per group."""
    total = F.count(F.lit(1))
    rates = {
        "total_requests": total,
        "anomaly_rate": share(F.count_if(F.col(flag) == 1), total),
        "error_rate": share(F.count_if(F.col(failed) == 1), total),
    }
    stats = latency_stats(log, groups, latency, small_bytes, rates)
    return stats.withColumn("sla_violation", F.col("p99_ms") > SLA_P99_MS)


def violations(p99: Column, anomaly_rate: Column, error_rate: Column) -> Column:
    """Texts of the limits that are exceeded; an unknown value counts as 0."""
    p99, anomaly_rate, error_rate = (F.coalesce(c, F.lit(0.0)) for c in (p99, anomaly_rate, error_rate))
    limits = LIMITS
    return F.array_compact(
        F.array(
            F.when(
                p99 > limits["latency_p99_ms"],
                F.format_string(f"P99 latency %.1fms > {limits['latency_p99_ms']:g}ms", p99),
            ),
            F.when(
                anomaly_rate > limits["anomaly_rate"],
                F.format_string(f"Anomaly rate %.1f%% > {limits['anomaly_rate'] * 100}%%", anomaly_rate * 100),
            ),
            F.when(
                error_rate > limits["error_rate"],
                F.format_string(f"Error rate %.1f%% > {limits['error_rate'] * 100}%%", error_rate * 100),
            ),
        )
    )


def decide(drift: DataFrame, performance: DataFrame, *, force: bool = False, dry_run: bool = False) -> DataFrame:
    """Rollback decision from a drift summary and a performance row (none = no finding).

    `performance` has latency_p99_ms, anomaly_rate and error_rate; rows are judged one by one.
    """
    found = drift.select(F.struct("dataset_drift_detected", "drift_share")).limit(1).scalar()
    drift_text = F.when(
        F.coalesce(found["dataset_drift_detected"], F.lit(False)),
        F.format_string("Data drift detected (%.1f%% features drifted)", found["drift_share"] * 100),
    )
    forced = F.when(F.lit(force), F.lit("Forced by --force flag"))
    reasons = F.concat(
        F.array_compact(F.array(drift_text)),
        violations(F.col("latency_p99_ms"), F.col("anomaly_rate"), F.col("error_rate")),
        F.array_compact(F.array(forced)),
    )
    judged = performance.withColumn("reasons", reasons)
    needed = F.size("reasons") > 0
    action = F.when(~needed, "none").otherwise("dry-run" if dry_run else "rollback")
    return judged.select(
        *performance.columns,
        needed.alias("should_rollback"),
        F.array_join("reasons", "; ").alias("reasons"),
        action.alias("action"),
    )


def checked(summary: DataFrame, at: Column, method: str) -> DataFrame:
    """A drift summary with the time of the check and the way it was made."""
    return summary.withColumns({"timestamp": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), "method": F.lit(method)})


def run_rows(df: DataFrame, name: str | Column, start: Column, kind: str, keys: dict[str, Column]) -> DataFrame:
    """One run per row of `df` as rows of the run history, one per key; its id is the name with the time."""
    run = F.lit(name) if isinstance(name, str) else name
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in keys.items()])
    whole = {
        "run_id": F.concat_ws("-", run, F.date_format(start, "yyyyMMdd-HHmmss")),
        "run_name": F.concat_ws("-", run, F.date_format(start, "yyyyMMdd-HHmm")),
        "start_time": start.cast("timestamp"),
        "kind": F.lit(kind),
    }
    long = df.select(*[v.alias(k) for k, v in whole.items()], F.explode(pairs).alias("_p"))
    return long.select(*whole, "_p.key", "_p.value", F.lit(0).alias("step")).select(*[f.name for f in schema.RUNS.fields])


def drift_run(summary: DataFrame, at: Column) -> DataFrame:
    """The run that a drift check leaves in the history."""
    keys = {
        "drift_detected": F.col("dataset_drift_detected").cast("int"),
        "drift_share": F.col("drift_share"),
        "drifted_features_count": F.col("num_drifted_features"),
    }
    return run_rows(summary, "drift-check", at, "metric", keys)


def performance_runs(stats: DataFrame, at: Column) -> DataFrame:
    """One run per row of `log_monitor`, at the time `at`."""
    keys = {"latency_p99_ms": F.col("p99_ms"), "anomaly_rate": F.col("anomaly_rate"), "error_rate": F.col("error_rate")}
    return run_rows(stats, "performance-check", at, "metric", keys)


def latest_performance(runs: DataFrame, name_like: str = "performance-check-%") -> DataFrame:
    """One row with the judged metrics of the newest performance run; NULL where the history has none."""
    newest = latest_run(runs.where("kind = 'metric'"), name_like)
    return newest.agg(*[F.max(F.when(F.col("key") == k, F.col("value").cast("double"))).alias(k) for k in LIMITS])


def rollback_plan(
    versions: DataFrame, drift: DataFrame, runs: DataFrame, *, force: bool = False, dry_run: bool = False
) -> DataFrame:
    """One row: what the newest findings ask for, from which version to which.

    Without a version in Production there is nothing to go back from, without an archived or staged
    one nothing to go back to; both are said in `action`, and neither is a rollback.
    """
    judged = decide(drift, latest_performance(runs), force=force, dry_run=dry_run)
    current = versions.where("stage = 'Production'").orderBy(F.col("version").cast("int").desc()).limit(1)
    told = judged.select(
        current.select("version").scalar().alias("from_version"), rollback_target(versions).select("version").scalar().alias("to_version"),
        "should_rollback", "reasons", "action",
    )
    nothing = F.col("from_version").isNull()
    action = (
        F.when(nothing, "no production model")
        .when(F.col("should_rollback") & F.col("to_version").isNull(), "no target")
        .otherwise(F.col("action"))
    )
    return told.withColumns({"action": action, "should_rollback": ~nothing & F.col("should_rollback")})


def rollback_run(plan: DataFrame, at: Column) -> DataFrame:
    """The run that an executed or tried rollback leaves in the history; none for other plans."""
    done = plan.where(F.col("action").isin("rollback", "dry-run"))
    return run_rows(done, "rollback", at, "param", {k: F.col(k) for k in ("action", "from_version", "to_version", "reasons")})

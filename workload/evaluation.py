"""Counts, classifier evaluation and percentiles over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ecdf, metrics, summary
from tidemark.plans import monitoring
from tidemark.sizing import group_join
from workload.base import EVENTS_SQL, METRICS, TELEMETRY_SQL, event_series, query, rounded, shown_sql, telemetry, with_sql

# Scored predictions of seven model versions (the line number): a score in 1/120 steps with many
# ties, and a cut that differs by version.
_POINTS = "CAST(round(packet_loss_pct) AS INT) * 5 + CAST(round(cpu_utilization / 2) AS INT) + CAST((l_orderkey * l_linenumber) % 17 AS INT)"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = F.expr(_POINTS)
    return telemetry(spark, sf_dir).select(
        F.col("l_linenumber").alias("version"),
        (points / F.lit(120.0)).alias("score"),
        (points > F.lit(70) - F.col("l_linenumber") * 3).cast("int").alias("predicted"),
        F.col("is_anomaly").alias("label"),
        F.col("latency_ms"),
        "timestamp",
        "node_id",
        "l_orderkey",
    )


PREDICTIONS_SQL = f"""predictions AS (
  SELECT l_linenumber AS version, ({_POINTS}) / 120.0::DOUBLE AS score,
         CAST(({_POINTS}) > 70 - l_linenumber * 3 AS INT) AS predicted, is_anomaly AS label,
         latency_ms, ts, node_id, l_orderkey
  FROM telemetry)"""
PRED = with_sql(TELEMETRY_SQL, PREDICTIONS_SQL)
TEL = with_sql(TELEMETRY_SQL)


@query(
    "node_summary",
    TEL
    + f"""SELECT node_id, count(*) AS rows, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
          {shown_sql("100.0 * sum(is_anomaly) / count(*)")} AS anomaly_pct FROM telemetry GROUP BY ROLLUP (node_id)""",
)
def node_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(summary.node_summary(telemetry(spark, sf_dir)), ["anomaly_pct"])


@query(
    "anomaly_type_shares",
    TEL
    + """SELECT anomaly_type, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
          FROM telemetry WHERE is_anomaly = 1 GROUP BY anomaly_type""",
)
def anomaly_type_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.value_shares(summary.only_anomalies(telemetry(spark, sf_dir)), "anomaly_type")


@query(
    "event_type_shares",
    f"SELECT event_type, count(*) AS count, {shown_sql('count(*) / sum(count(*)) OVER ()', 6)} AS share FROM events GROUP BY event_type",
)
def event_type_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(summary.value_shares(event_series(spark, sf_dir), "event_type"), ["share"], 6)


@query("distinct_nodes", TEL + "SELECT count(*) AS rows, count(DISTINCT node_id) AS keys FROM telemetry")
def distinct_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.key_counts(telemetry(spark, sf_dir))


@query(
    "drop_incomplete_normals",
    TEL
    + """SELECT node_id, count(*) AS rows FROM telemetry WHERE is_anomaly = 0 AND latency_ms IS NOT NULL
          AND packet_loss_pct IS NOT NULL AND cpu_utilization IS NOT NULL AND bandwidth_mbps IS NOT NULL
          AND error_rate IS NOT NULL GROUP BY node_id""",
)
def drop_incomplete_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summary.drop_incomplete(summary.only_normal(telemetry(spark, sf_dir)), METRICS)
    return rows.groupBy("node_id").agg(F.count(F.lit(1)).alias("rows"))


_CONFUSION = """SELECT version,
  count(*) FILTER (predicted = 1 AND label = 1) AS tp, count(*) FILTER (predicted = 1 AND label = 0) AS fp,
  count(*) FILTER (predicted = 0 AND label = 1) AS fn, count(*) FILTER (predicted = 0 AND label = 0) AS tn
  FROM predictions GROUP BY version"""


@query("confusion_matrix", PRED + _CONFUSION)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(predictions(spark, sf_dir), ["version"], "predicted", "label")


@query(
    "classification_scores",
    with_sql(
        TELEMETRY_SQL,
        PREDICTIONS_SQL,
        f"c AS ({_CONFUSION})",
        """s AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p,
                 CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM c)""",
    )
    + f"""SELECT version, tp, fp, fn, tn, {shown_sql("p", 6)} AS precision, {shown_sql("r", 6)} AS recall,
          {shown_sql("CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END", 6)} AS f1_score,
          {shown_sql("(tp + tn) / (tp + fp + fn + tn)", 6)} AS accuracy, tp + fp + fn + tn AS total FROM s""",
)
def classification_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.classification_scores(predictions(spark, sf_dir), ["version"], "predicted", "label")
    return rounded(out, ["precision", "recall", "f1_score", "accuracy"], 6)


# ROC AUC from average ranks (Mann-Whitney), average precision from rows above each score.
_RANKING = (
    with_sql(
        TELEMETRY_SQL,
        PREDICTIONS_SQL,
        """r AS (SELECT version, score, label,
                 rank() OVER (PARTITION BY version ORDER BY score)
                   + (count(*) OVER (PARTITION BY version, score) - 1) / 2 AS place,
                 count(*) OVER (PARTITION BY version ORDER BY score DESC) AS above,
                 sum(label) OVER (PARTITION BY version ORDER BY score DESC) AS hits FROM predictions)""",
    )
    + f"""SELECT version,
      {shown_sql("(sum(place) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label))", 6)} AS roc_auc,
      {shown_sql("sum(hits / above) FILTER (label = 1) / sum(label)", 6)} AS pr_auc
      FROM r GROUP BY version"""
)


@query("ranking_scores", _RANKING)
def ranking_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.ranking_scores(predictions(spark, sf_dir), ["version"], "score", "label")
    return rounded(out, ["roc_auc", "pr_auc"], 6)


@query("ranking_scores_binned", _RANKING)
def ranking_scores_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC AUC and average precision on the plan for groups too large for one task."""
    out = metrics.ranking_scores(predictions(spark, sf_dir), ["version"], "score", "label", small_bytes=0)
    return rounded(out, ["roc_auc", "pr_auc"], 6)


_ROC = (
    with_sql(
        TELEMETRY_SQL,
        "c AS (SELECT latency_ms, sum(is_anomaly) AS pos, sum(1 - is_anomaly) AS neg FROM telemetry GROUP BY latency_ms)",
    )
    + f"""SELECT {shown_sql("latency_ms", 6)} AS threshold,
      {shown_sql("sum(neg) OVER (ORDER BY latency_ms DESC) / sum(neg) OVER ()", 6)} AS fpr,
      {shown_sql("sum(pos) OVER (ORDER BY latency_ms DESC) / sum(pos) OVER ()", 6)} AS tpr FROM c"""
)


@query("roc_curve_points", _ROC)
def roc_curve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.roc_points(telemetry(spark, sf_dir), [], "latency_ms", "is_anomaly")
    return rounded(out, ["threshold", "fpr", "tpr"], 6)


@query("roc_curve_points_binned", _ROC)
def roc_curve_points_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.roc_points(telemetry(spark, sf_dir), [], "latency_ms", "is_anomaly", small_bytes=0)
    return rounded(out, ["threshold", "fpr", "tpr"], 6)


@query(
    "classification_report",
    with_sql(
        TELEMETRY_SQL,
        PREDICTIONS_SQL,
        """m AS (SELECT c AS cls, count(*) FILTER (predicted = c AND label = c) AS hit,
                 count(*) FILTER (predicted = c) AS said, count(*) FILTER (label = c) AS support
                 FROM predictions, (VALUES (0), (1)) AS v(c) GROUP BY c)""",
        """s AS (SELECT CASE cls WHEN 1 THEN 'Anomaly' ELSE 'Normal' END AS class, hit / said AS precision,
                 hit / support AS recall, 2 * hit / (said + support) AS f1_score, support, hit FROM m)""",
        """a AS (SELECT class, precision, recall, f1_score, support FROM s
                 UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM s
                 UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM s
                 UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1_score * support) / sum(support), sum(support) FROM s)""",
    )
    + f"""SELECT class, {shown_sql("precision", 6)} AS precision, {shown_sql("recall", 6)} AS recall,
          {shown_sql("f1_score", 6)} AS f1_score, CAST(support AS BIGINT) AS support FROM a""",
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.classification_report(
        predictions(spark, sf_dir), "predicted", "label", {0: "Normal", 1: "Anomaly"}
    )
    return rounded(out, ["precision", "recall", "f1_score"], 6)


@query(
    "class_weight",
    TEL
    + f"""SELECT CAST(sum(is_anomaly) AS BIGINT) AS positives, CAST(sum(1 - is_anomaly) AS BIGINT) AS negatives,
          {shown_sql("sum(1 - is_anomaly) / sum(is_anomaly)", 6)} AS pos_weight FROM telemetry""",
)
def class_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.class_weight(telemetry(spark, sf_dir), "is_anomaly"), ["pos_weight"], 6)


_STATS = (
    TEL
    + f"""SELECT node_id, {", ".join(f"{shown_sql(f'quantile_cont(latency_ms, {p})', 3)} AS p{int(p * 100)}_ms" for p in (0.5, 0.95, 0.99))},
      {shown_sql("avg(latency_ms)", 3)} AS mean_ms, {shown_sql("max(latency_ms)", 3)} AS max_ms, {shown_sql("min(latency_ms)", 3)} AS min_ms
      FROM telemetry GROUP BY node_id"""
)


def _latency(spark: SparkSession, sf_dir: str, small_bytes: int | None) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    marks = ecdf.percentiles(rows, ["node_id"], "latency_ms", monitoring.LATENCY_POINTS, small_bytes=small_bytes)
    moments = rows.groupBy("node_id").agg(
        F.avg("latency_ms").alias("mean_ms"), F.max("latency_ms").alias("max_ms"), F.min("latency_ms").alias("min_ms")
    )
    return rounded(group_join(marks, moments, ["node_id"]), [*monitoring.LATENCY_POINTS, "mean_ms", "max_ms", "min_ms"], 3)


@query("latency_percentiles", _STATS)
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latency(spark, sf_dir, None)


@query("latency_percentiles_binned", _STATS)
def latency_percentiles_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles from binned running totals: the plan for large groups."""
    return _latency(spark, sf_dir, 0)


@query(
    "prediction_rates",
    PRED
    + f"""SELECT version, count(*) AS total_requests, {shown_sql("sum(predicted) / count(*)", 6)} AS anomaly_rate,
          {shown_sql("count(*) FILTER (latency_ms > 90) / count(*)", 6)} AS error_rate FROM predictions GROUP BY version""",
)
def prediction_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predictions(spark, sf_dir).withColumn("failed", (F.col("latency_ms") > 90).cast("int"))
    out = summary.prediction_rates(rows, ["version"], "predicted", "failed")
    return rounded(out, ["anomaly_rate", "error_rate"], 6)


@query(
    "density_histogram",
    with_sql(
        TELEMETRY_SQL,
        """s AS (SELECT is_anomaly, min(latency_ms) AS low, (max(latency_ms) - min(latency_ms)) / 100 AS w, count(*) AS n
                 FROM telemetry GROUP BY is_anomaly)""",
        """b AS (SELECT is_anomaly, least(CAST(floor((latency_ms - low) / w) AS INT), 99) AS bin, n, w, low
                 FROM telemetry JOIN s USING (is_anomaly))""",
    )
    + f"""SELECT is_anomaly, bin, count(*) AS count, {shown_sql("min(low + bin * w)", 6)} AS bin_start,
          {shown_sql("count(*) / min(n * w)", 6)} AS density FROM b GROUP BY is_anomaly, bin""",
)
def density_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.density_histogram(telemetry(spark, sf_dir), ["is_anomaly"], "latency_ms")
    return rounded(out, ["bin_start", "density"], 6)


def _sweep_sql(source: str, judged: str) -> str:
    return with_sql(
        TELEMETRY_SQL,
        f"""t AS (SELECT unnest(range(0, 20)) AS candidate,
          unnest(quantile_cont(latency_ms, {[(90 + i / 2) / 100 for i in range(20)]}) FILTER (is_anomaly = 0)) AS threshold
          FROM telemetry WHERE {source})""",
        f"""c AS (SELECT candidate, threshold, count(*) FILTER (latency_ms > threshold AND is_anomaly = 1) AS tp,
         count(*) FILTER (latency_ms > threshold AND is_anomaly = 0) AS fp,
         count(*) FILTER (latency_ms <= threshold AND is_anomaly = 1) AS fn,
         count(*) FILTER (latency_ms <= threshold AND is_anomaly = 0) AS tn
         FROM telemetry, t WHERE {judged} GROUP BY candidate, threshold)""",
        """f AS (SELECT CAST(candidate AS INT) AS candidate, threshold, tp, fp, fn, tn,
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_score FROM c)""",
    )


_SWEEP = _sweep_sql("true", "true")
_EARLY = "ts < TIMESTAMP '1999-01-01'"
_SWEEP_COLUMNS = f"candidate, {shown_sql('threshold', 6)} AS threshold, tp, fp, fn, tn, {shown_sql('f1_score', 6)} AS f1_score"


@query("threshold_sweep", _SWEEP + f"SELECT {_SWEEP_COLUMNS} FROM f")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.threshold_sweep(telemetry(spark, sf_dir), "latency_ms", "is_anomaly")
    return rounded(out.drop("precision", "recall", "accuracy", "total"), ["threshold", "f1_score"], 6)


@query("threshold_sweep_two_sets", _sweep_sql(_EARLY, f"NOT {_EARLY}") + f"SELECT {_SWEEP_COLUMNS} FROM f")
def threshold_sweep_two_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates from an earlier period's normal rows, judged on the later period."""
    rows = telemetry(spark, sf_dir)
    early = F.col("timestamp") < F.lit("1999-01-01").cast("timestamp_ntz")
    out = metrics.threshold_sweep(rows.where(~early), "latency_ms", "is_anomaly", source=rows.where(early))
    return rounded(out.drop("precision", "recall", "accuracy", "total"), ["threshold", "f1_score"], 6)


@query("best_threshold", _SWEEP + f"SELECT {_SWEEP_COLUMNS} FROM f ORDER BY f.f1_score DESC, candidate LIMIT 1")
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    sweep = metrics.threshold_sweep(telemetry(spark, sf_dir), "latency_ms", "is_anomaly", small_bytes=0)
    out = metrics.best_threshold(sweep)
    return rounded(out.drop("precision", "recall", "accuracy", "total"), ["threshold", "f1_score"], 6)


@query(
    "standardisation_stats",
    TEL
    + " UNION ALL ".join(
        f"SELECT '{m}' AS \"column\", {shown_sql(f'avg({m})')} AS mean, {shown_sql(f'stddev_pop({m})')} AS std FROM telemetry WHERE is_anomaly = 0"
        for m in METRICS
    ),
)
def standardisation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(summary.standard_stats(summary.only_normal(telemetry(spark, sf_dir)), METRICS), ["mean", "std"])


@query(
    "batch_totals",
    PRED + "SELECT l_orderkey, count(*) AS total, CAST(sum(predicted) AS BIGINT) AS anomaly_count FROM predictions GROUP BY l_orderkey",
)
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.batch_totals(predictions(spark, sf_dir), ["l_orderkey"], "predicted")


_MSE_STEP = " + ".join(
    f"power({m} - avg({m}) OVER (PARTITION BY node_id ORDER BY ts, l_orderkey, l_linenumber, l_partkey, l_extendedprice ROWS 4 PRECEDING), 2)"
    for m in METRICS
)


@query(
    "reconstruction_mse",
    TEL + f"SELECT node_id, l_orderkey, l_linenumber, l_partkey, {shown_sql(f'({_MSE_STEP}) / 5')} AS mse FROM telemetry",
)
def reconstruction_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row error against the 5-row rolling mean as the expected vector."""
    from tidemark.operators.features import compute_features
    from workload.base import ORDER, ROW_KEY

    out = compute_features(telemetry(spark, sf_dir), order=ORDER, families={"rolling"})
    actual, expected = F.array(*METRICS), F.array(*[f"{m}_roll_mean_5min" for m in METRICS])
    return rounded(out.select(*ROW_KEY, metrics.row_mse(actual, expected).alias("mse")), ["mse"])

"""Model versions, run history, monitoring decisions, data versions and file round trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema
from tidemark.operators import drift, lineage, rules
from tidemark.operators.features import compute_features, output_columns
from tidemark.plans import monitoring, registry
from tidemark.sizing import shared_dir
from tidemark.sources import files
from tidemark.sources.views import present
from workload.base import METRICS, ORDER, TELEMETRY_SQL, TIES, query, rounded, shown_sql, table, telemetry, with_sql
from workload.drift import _PERIODS, _details, _periods, _summary
from workload.evaluation import PREDICTIONS_SQL, predictions

# Seven versions scored on the given rows; stages and model types follow from the version number.
_STAGES = {1: "Archived", 2: "Archived", 3: "Production", 4: "Staging", 5: "None", 6: "Staging", 7: "None"}
_TYPES = {0: "IsolationForest", 1: "XGBoost", 2: "Autoencoder"}
_STAGE_SQL = "CASE " + " ".join(f"WHEN version = {v} THEN '{s}'" for v, s in _STAGES.items()) + " END"
_TYPE_SQL = "CASE version % 3 " + " ".join(f"WHEN {k} THEN '{t}'" for k, t in _TYPES.items()) + " END"

_BOARD = [
    TELEMETRY_SQL,
    PREDICTIONS_SQL,
    """c AS (SELECT version, count(*) FILTER (predicted = 1 AND label = 1) AS tp, count(*) FILTER (predicted = 1) AS said,
         sum(label) AS support FROM predictions GROUP BY version)""",
    """r AS (SELECT version, score, label, rank() OVER (PARTITION BY version ORDER BY score)
           + (count(*) OVER (PARTITION BY version, score) - 1) / 2 AS place FROM predictions)""",
    """a AS (SELECT version, (sum(place) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)) AS roc_auc
         FROM r GROUP BY version)""",
    f"""board AS (SELECT version, {_STAGE_SQL} AS stage, {_TYPE_SQL} AS model_type,
         coalesce(2 * tp / nullif(said + support, 0), 0) AS f1_score, roc_auc,
         coalesce(tp / nullif(said, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
         'run-' || version AS run_id FROM c JOIN a USING (version))""",
]


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version table with a row per version that scored rows."""
    v = F.col("version")
    seen = predictions(spark, sf_dir).select("version").distinct()
    stage = F.create_map(*[F.lit(x) for p in _STAGES.items() for x in p])[v]
    return seen.select(v, stage.alias("stage"), F.concat(F.lit("run-"), v.cast("string")).alias("run_id"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history with the evaluation of each version and its model type."""
    scores = registry.score_models(predictions(spark, sf_dir), "version", "predicted", "score", "label")
    v = F.col("version")
    run_id = F.concat(F.lit("run-"), v.cast("string"))
    name = F.concat(F.lit("perf-"), v.cast("string"))
    start = F.timestamp_seconds(F.lit(1767225600) + v * 60)
    measured = registry.metric_rows(scores, run_id, name, start, registry.METRIC_NAMES)
    kind = F.create_map(*[F.lit(x) for p in _TYPES.items() for x in p])[v % 3]
    params = scores.select(
        run_id.alias("run_id"),
        name.alias("run_name"),
        start.alias("start_time"),
        F.lit("param").alias("kind"),
        F.lit("model_type").alias("key"),
        kind.alias("value"),
        F.lit(None).cast("int").alias("step"),
    )
    return measured.unionByName(params)


def _board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.version_table(_versions(spark, sf_dir), _runs(spark, sf_dir))


_NUMBERS = ["f1_score", "roc_auc", "precision", "recall"]
_NUMBERS_SQL = ", ".join(f"{shown_sql(f'board.{n}', 6)} AS {n}" for n in _NUMBERS)


@query(
    "model_leaderboard",
    with_sql(*_BOARD)
    + f"""SELECT version, stage, model_type, {_NUMBERS_SQL}, run_id,
          CAST(row_number() OVER (ORDER BY round(board.f1_score, 12) DESC, version) AS INT) AS place FROM board""",
)
def model_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions joined to their runs and ranked by F1."""
    return rounded(registry.leaderboard(_board(spark, sf_dir)), _NUMBERS, 6)


@query(
    "champion_improvement",
    with_sql(*_BOARD, "b AS (SELECT * FROM board ORDER BY f1_score DESC, version LIMIT 1)", "p AS (SELECT * FROM board WHERE stage = 'Production')")
    + f"""SELECT b.version AS best_version, {shown_sql("b.f1_score", 6)} AS best_f1, p.version AS production_version,
          {shown_sql("p.f1_score", 6)} AS production_f1,
          {shown_sql("CASE WHEN b.f1_score > p.f1_score THEN (b.f1_score - p.f1_score) / p.f1_score * 100 ELSE 0 END")} AS improvement_pct FROM b, p""",
)
def champion_improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(registry.improvement(_board(spark, sf_dir)), ["best_f1", "production_f1"], 6), ["improvement_pct"])


@query(
    "promotion_candidate",
    with_sql(*_BOARD)
    + f"""SELECT version, stage, CASE stage WHEN 'Staging' THEN 'Production' ELSE 'Staging' END AS target_stage,
          {shown_sql("board.f1_score", 6)} AS f1_score FROM board WHERE stage <> 'Production' ORDER BY board.f1_score DESC, version LIMIT 1""",
)
def promotion_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(registry.promotion_candidate(_board(spark, sf_dir)), ["f1_score"], 6)


@query(
    "rollback_stages",
    with_sql(*_BOARD)
    + """SELECT version, run_id, CASE WHEN version = (SELECT max(version) FROM board WHERE stage = 'Archived') THEN 'Production'
         WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage FROM board""",
)
def rollback_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages after going back to the newest archived version."""
    versions = _versions(spark, sf_dir)
    return registry.apply_rollback(versions, registry.rollback_target(versions)).select("version", "run_id", "stage")


@query(
    "promoted_stages",
    with_sql(
        *_BOARD,
        """w AS (SELECT version AS v, CASE stage WHEN 'Staging' THEN 'Production' ELSE 'Staging' END AS target
             FROM board WHERE stage <> 'Production' ORDER BY board.f1_score DESC, version LIMIT 1)""",
    )
    + "SELECT version, run_id, CASE WHEN version = v THEN target WHEN stage = target THEN 'Archived' ELSE stage END AS stage FROM board, w",
)
def promoted_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages after promoting the best candidate; the former holders are archived."""
    candidate = registry.promotion_candidate(_board(spark, sf_dir))
    return registry.apply_promotion(_versions(spark, sf_dir), candidate).select("version", "run_id", "stage")


@query(
    "version_tags",
    with_sql(
        *_BOARD,
        """t AS (SELECT version, unnest(['model_type', 'training_date', 'author', 'project', 'data_version', 'anomaly_types_detected',
               'f1_score', 'roc_auc', 'framework']) AS tag,
             unnest([model_type, '2026-01-01', 'ops', 'telemetry', 'v1.0', 'spike',
               regexp_replace(printf('%.4f', board.f1_score), '(\\.\\d+?)0+$', '\\1'), regexp_replace(printf('%.4f', roc_auc), '(\\.\\d+?)0+$', '\\1'),
               CASE model_type WHEN 'IsolationForest' THEN 'scikit-learn' WHEN 'XGBoost' THEN 'xgboost' ELSE 'pytorch' END]) AS value FROM board)""",
    )
    + "SELECT version, tag, value FROM t",
)
def version_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.version_tags(_board(spark, sf_dir), F.lit("2026-01-01").cast("date"), F.lit("v1.0"), author="ops", project="telemetry", anomaly_types="spike")


@query(
    "latest_performance_run",
    with_sql(*_BOARD, "n AS (SELECT * FROM board ORDER BY version DESC LIMIT 1)")
    + f"""SELECT run_id, 'perf-' || version AS run_name, k AS key, {shown_sql("v", 6)} AS value FROM (
          SELECT run_id, version, unnest(['f1_score', 'roc_auc', 'precision', 'recall']) AS k,
          unnest([n.f1_score, roc_auc, precision, recall]) AS v FROM n)""",
)
def latest_performance_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history written in two appends and read back; the newest matching run."""
    folder = shared_dir(spark, "runs")
    history = _runs(spark, sf_dir)
    files.append_runs(history.where("kind = 'metric'"), folder)
    files.append_runs(history.where("kind = 'param'"), folder)
    newest = registry.latest_run(files.read_runs(spark, folder), "perf-%").where("kind = 'metric'")
    return rounded(newest.select("run_id", "run_name", "key", F.col("value").cast("double").alias("value")), ["value"], 6)


_LOG = [
    TELEMETRY_SQL,
    PREDICTIONS_SQL,
    """log AS (SELECT CAST(epoch(date_trunc('month', ts)) / 86400 AS INT) AS month_day, latency_ms, predicted,
         CAST(latency_ms > 104 AS INT) AS failed FROM predictions)""",
]
_MONITOR = f"""mon AS (SELECT month_day, {", ".join(f"round(quantile_cont(latency_ms, {p}), 3) AS p{int(p * 100)}_ms" for p in (0.5, 0.95, 0.99))},
  round(avg(latency_ms), 3) AS mean_ms, round(max(latency_ms), 3) AS max_ms, round(min(latency_ms), 3) AS min_ms,
  count(*) AS total_requests, sum(predicted) / count(*) AS anomaly_rate, sum(failed) / count(*) AS error_rate
  FROM log GROUP BY month_day)"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.datediff(F.date_trunc("month", "timestamp").cast("date"), F.lit("1970-01-01").cast("date"))
    return predictions(spark, sf_dir).select(
        month.alias("month_day"), "latency_ms", "predicted", (F.col("latency_ms") > 104).cast("int").alias("failed")
    )


@query(
    "prediction_log_monitor",
    with_sql(*_LOG, _MONITOR)
    + f"""SELECT month_day, p50_ms, p95_ms, p99_ms, mean_ms, max_ms, min_ms, total_requests, {shown_sql("mon.anomaly_rate", 6)} AS anomaly_rate,
          {shown_sql("mon.error_rate", 6)} AS error_rate, p99_ms > 100 AS sla_violation FROM mon""",
)
def prediction_log_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency statistics, rates and SLA flag per month of the prediction log."""
    out = monitoring.log_monitor(_log(spark, sf_dir), ["month_day"], "latency_ms", "predicted", "failed")
    return rounded(out, ["anomaly_rate", "error_rate"], 6)


@query(
    "rollback_decision",
    with_sql(*_details(*_PERIODS), *[p for p in _LOG if p != TELEMETRY_SQL], _MONITOR, f"d1 AS ({_summary('drifted')})")
    + f"""SELECT month_day, reasons <> '' AS should_rollback, reasons, CASE WHEN reasons <> '' THEN 'dry-run' ELSE 'none' END AS action FROM (
         SELECT month_day, concat_ws('; ',
           CASE WHEN dataset_drift_detected THEN printf('Data drift detected (%.1f%% features drifted)', drift_share * 100) END,
           CASE WHEN p99_ms > 100 THEN printf('P99 latency %.1fms > 100ms', {shown_sql('p99_ms', 1)}) END,
           CASE WHEN mon.anomaly_rate > 0.5 THEN printf('Anomaly rate %.1f%% > 50.0%%', {shown_sql('mon.anomaly_rate * 100', 1)}) END,
           CASE WHEN mon.error_rate > 0.05 THEN printf('Error rate %.1f%% > 5.0%%', {shown_sql('mon.error_rate * 100', 1)}) END) AS reasons FROM mon, d1)""",
)
def rollback_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift summary through its JSON file and the monthly log, judged together (dry run).

    Numbers in the texts round half up.
    """
    folder = shared_dir(spark, "drift-summary")
    files.write_summary(drift.drift_summary(drift.drift_details(*_periods(spark, sf_dir), METRICS)), folder)
    monitor = monitoring.log_monitor(_log(spark, sf_dir), ["month_day"], "latency_ms", "predicted", "failed")
    rates = monitor.select("month_day", F.col("p99_ms").alias("latency_p99_ms"), "anomaly_rate", "error_rate")
    out = monitoring.decide(files.read_drift_summary(spark, folder), rates, dry_run=True)
    return out.select("month_day", "should_rollback", "reasons", "action")


_CHECKED_AT = "2026-01-05 00:00:00"
_REASONS = f"""concat_ws('; ',
  CASE WHEN dataset_drift_detected THEN printf('Data drift detected (%.1f%% features drifted)', drift_share * 100) END,
  CASE WHEN p99_ms > 100 THEN printf('P99 latency %.1fms > 100ms', {shown_sql('p99_ms', 1)}) END,
  CASE WHEN mon.anomaly_rate > 0.5 THEN printf('Anomaly rate %.1f%% > 50.0%%', {shown_sql('mon.anomaly_rate * 100', 1)}) END,
  CASE WHEN mon.error_rate > 0.05 THEN printf('Error rate %.1f%% > 5.0%%', {shown_sql('mon.error_rate * 100', 1)}) END)"""


def _chain(spark: SparkSession, sf_dir: str, versions: DataFrame) -> DataFrame:
    """Checks appended to the run history, and the rollback that follows from the newest of them (tried only)."""
    at, folder = F.lit(_CHECKED_AT).cast("timestamp"), shared_dir(spark, "monitoring")
    summary = drift.drift_summary(drift.drift_details(*_periods(spark, sf_dir), METRICS))
    files.write_summary(monitoring.checked(summary, at, "ks+mean-shift"), f"{folder}/summary")
    monitor = monitoring.log_monitor(_log(spark, sf_dir), ["month_day"], "latency_ms", "predicted", "failed")
    month = F.timestamp_seconds(F.col("month_day").cast("long") * 86400)
    files.append_runs(monitoring.performance_runs(monitor, month), f"{folder}/runs")
    files.append_runs(monitoring.drift_run(summary, at), f"{folder}/runs")
    runs = files.read_runs(spark, f"{folder}/runs")
    plan = monitoring.rollback_plan(versions, files.read_drift_summary(spark, f"{folder}/summary"), runs, dry_run=True)
    files.append_runs(monitoring.rollback_run(plan, at), f"{folder}/runs")
    return files.read_runs(spark, f"{folder}/runs")


@query(
    "monitoring_run_history",
    with_sql(
        *_details(*_PERIODS), *[p for p in _LOG if p != TELEMETRY_SQL], _MONITOR, f"d1 AS ({_summary('drifted')})",
        f"newest AS (SELECT {_REASONS} AS reasons FROM mon, d1 ORDER BY month_day DESC LIMIT 1)",
    )
    + f"""SELECT 'drift-check' AS check_name, key, {shown_sql("v", 6)} AS number, NULL AS said FROM (SELECT
            unnest(['drift_detected', 'drift_share', 'drifted_features_count']) AS key,
            unnest([dataset_drift_detected::INT::DOUBLE, drift_share, num_drifted_features::DOUBLE]) AS v FROM d1)
      UNION ALL SELECT 'performance-check', key, {shown_sql("v", 6)}, NULL FROM (SELECT
            unnest(['latency_p99_ms', 'anomaly_rate', 'error_rate']) AS key, unnest([p99_ms, mon.anomaly_rate, mon.error_rate]) AS v FROM mon)
      UNION ALL SELECT 'rollback', unnest(['action', 'from_version', 'to_version', 'reasons']), NULL,
            unnest(['dry-run', '3', '2', reasons]) FROM newest WHERE reasons <> ''""",
)
def monitoring_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What drift checks, performance checks and a tried rollback leave in the run history."""
    runs = _chain(spark, sf_dir, _versions(spark, sf_dir))
    name = F.regexp_extract("run_name", r"^([a-z-]+)-\d", 1)
    metric = F.col("kind") == "metric"
    out = runs.select(
        name.alias("check_name"), "key", F.when(metric, F.col("value").cast("double")).alias("number"), F.when(~metric, F.col("value")).alias("said")
    )
    return rounded(out, ["number"], 6)


@query(
    "rollback_plans",
    with_sql(
        *_details(*_PERIODS), *[p for p in _LOG if p != TELEMETRY_SQL], _MONITOR, f"d1 AS ({_summary('drifted')})",
        f"newest AS (SELECT {_REASONS} AS reasons FROM mon, d1 ORDER BY month_day DESC LIMIT 1)",
        """cases AS (SELECT * FROM (VALUES ('whole', 3, 2), ('no archive', 3, 6), ('production alone', 3, NULL), ('no production', NULL, 2))
             AS t(versions, from_version, to_version))""",
    )
    + """SELECT versions, from_version, to_version, from_version IS NOT NULL AND reasons <> '' AS should_rollback, reasons,
         CASE WHEN from_version IS NULL THEN 'no production model' WHEN reasons = '' THEN 'none'
              WHEN to_version IS NULL THEN 'no target' ELSE 'rollback' END AS action FROM cases, newest""",
)
def rollback_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for the newest findings under four version tables."""
    versions = _versions(spark, sf_dir)
    monitor = monitoring.log_monitor(_log(spark, sf_dir), ["month_day"], "latency_ms", "predicted", "failed")
    month = F.timestamp_seconds(F.col("month_day").cast("long") * 86400)
    runs = files.stored(monitoring.performance_runs(monitor, month), "performance-runs")
    found = files.stored(drift.drift_summary(drift.drift_details(*_periods(spark, sf_dir), METRICS)), "drift-summary")
    cases = {
        "whole": versions, "no archive": versions.where("stage <> 'Archived'"), "production alone": versions.where("stage = 'Production'"),
        "no production": versions.where("stage <> 'Production'"),
    }
    plans = [monitoring.rollback_plan(v, found, runs).withColumn("versions", F.lit(name)) for name, v in cases.items()]
    return reduce(DataFrame.unionByName, plans)


# Data versions: the year of the order is the version of the orders data set.
# Every column counts; prices as decimals and dates as days, which both engines write alike.
_PRINT_SQL = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "o_custkey",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": "CAST(o_totalprice AS DECIMAL(18, 2))",
    "o_orderdate": "CAST(o_orderdate AS DATE)",
    "o_orderpriority": "o_orderpriority",
}
_PRINT_COLUMNS = list(_PRINT_SQL)
_PARTS = " || ".join(f"coalesce(length(CAST({e} AS VARCHAR)) || ':' || CAST({e} AS VARCHAR), '-')" for e in _PRINT_SQL.values())
_DIGEST = f"('0x' || substr(md5({_PARTS}), 1, 15))::BIGINT"
_PRINTS = f"""f AS (SELECT CAST(year(o_orderdate) AS INT) AS version, count(*) AS rows,
  md5(concat_ws('|', count(*), CAST(sum(CAST({_DIGEST} AS HUGEINT)) AS VARCHAR))) AS content_hash FROM orders GROUP BY 1)"""


def _prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("version"), *[F.expr(e.replace("VARCHAR", "STRING")).alias(c) for c, e in _PRINT_SQL.items()])
    return lineage.fingerprint(orders, _PRINT_COLUMNS, ["version"]).withColumn("dataset", F.lit("orders"))


@query("dataset_fingerprints", with_sql(_PRINTS) + "SELECT version, rows, content_hash FROM f")
def dataset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prints(spark, sf_dir).select("version", "rows", "content_hash")


@query("file_tree_fingerprints", with_sql(_PRINTS) + "SELECT version, rows, content_hash, true AS has_bytes FROM f")
def file_tree_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of a table that grows by a partition a year, from its files: of the second listing only new files are read."""
    folder = shared_dir(spark, "file-tree")
    columns = [F.expr(e.replace("VARCHAR", "STRING")).alias(c) for c, e in _PRINT_SQL.items()]
    orders = table(spark, sf_dir, "orders").select(*columns, F.year("o_orderdate").alias("year"))
    known = None
    for part in (F.col("year") < 1997, F.col("year") >= 1997):
        orders.where(part).repartition("year").write.mode("append").partitionBy("year").parquet(f"{folder}/orders")
        known = files.stored(lineage.file_fingerprints(spark, f"{folder}/orders", _PRINT_COLUMNS, known), "file-prints")
    year = F.regexp_extract("file", r"year=(\d+)/", 1).cast("int")
    prints = lineage.combined_fingerprint(known, {"version": year})
    return prints.select("version", "rows", "content_hash", (F.col("bytes") > 0).alias("has_bytes"))


@query(
    "changed_data_versions",
    with_sql(_PRINTS)
    + """SELECT 'orders' AS dataset, version, content_hash, lag(content_hash) OVER (ORDER BY version) AS previous_hash,
         coalesce(lag(content_hash) OVER (ORDER BY version) <> content_hash, TRUE) AS changed FROM f""",
)
def changed_data_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.changed_versions(_prints(spark, sf_dir), "dataset", "version")


@query(
    "data_version_diff",
    """WITH o AS (SELECT * FROM lineitem WHERE l_orderkey % 10 <> 3),
         n AS (SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 1 THEN 'X' ELSE l_returnflag END AS l_returnflag,
                                 CASE WHEN l_orderkey % 11 = 1 THEN l_tax + 1 ELSE l_tax END AS l_tax)
               FROM lineitem WHERE l_orderkey % 10 <> 4),
         a AS (SELECT * FROM n EXCEPT ALL SELECT * FROM o), r AS (SELECT * FROM o EXCEPT ALL SELECT * FROM n)
       SELECT l_suppkey, CAST(sum(a) AS BIGINT) AS added, CAST(sum(r) AS BIGINT) AS removed FROM (
         SELECT l_suppkey, 1 AS a, 0 AS r FROM a UNION ALL SELECT l_suppkey, 0, 1 FROM r) GROUP BY l_suppkey""",
)
def data_version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows added and removed between two versions of the line table, per supplier."""
    k = F.col("l_orderkey")
    lines = table(spark, sf_dir, "lineitem")
    old = lines.where(k % 10 != 3)
    new = lines.where(k % 10 != 4).withColumns(
        {
            "l_returnflag": F.when(k % 7 == 1, "X").otherwise(F.col("l_returnflag")),
            "l_tax": F.when(k % 11 == 1, F.col("l_tax") + 1).otherwise(F.col("l_tax")),
        }
    )
    return lineage.version_diff(old, new, ["l_suppkey"])


@query(
    "run_data_lineage",
    with_sql(_PRINTS)
    + "SELECT 'run-' || (version - 1990) AS run_id, content_hash, 'orders' AS dataset, rows FROM f",
)
def run_data_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that logged a data version, traced to the data set with that hash."""
    prints = _prints(spark, sf_dir)
    runs = prints.select(
        F.concat(F.lit("run-"), (F.col("version") - 1990).cast("string")).alias("run_id"),
        F.lit("param").alias("kind"),
        F.lit("data_version").alias("key"),
        F.col("content_hash").alias("value"),
    )
    return lineage.run_lineage(runs, prints, "dataset")


_TIE_TYPES = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_extendedprice", T.DoubleType()),
    ]
)
_PER_NODE = with_sql(TELEMETRY_SQL) + f"""SELECT node_id, count(*) AS rows, {shown_sql("sum(latency_ms)", 3)} AS latency,
  CAST(sum(is_anomaly) AS BIGINT) AS anomalies, CAST(max(epoch(ts)) AS BIGINT) AS newest FROM telemetry GROUP BY node_id"""


def _per_node(df: DataFrame) -> DataFrame:
    out = df.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("latency_ms").alias("latency"),
        F.sum("is_anomaly").alias("anomalies"),
        F.max(F.unix_seconds(F.col("timestamp").cast("timestamp"))).alias("newest"),
    )
    return rounded(out, ["latency"], 3)


def _written_csv(spark: SparkSession, sf_dir: str, folder: str) -> str:
    rows = telemetry(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    files.write_csv(rows.select(*[f.name for f in schema.TELEMETRY.fields], *TIES), f"{folder}/csv")
    return f"{folder}/csv"


@query("csv_round_trip", _PER_NODE)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry written as CSV and read back with the fixed types."""
    path = _written_csv(spark, sf_dir, shared_dir(spark, "csv"))
    return _per_node(files.read_telemetry_csv(spark, path, _TIE_TYPES))


@query("csv_to_parquet_stage", _PER_NODE)
def csv_to_parquet_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV staged to Parquet with the time column cast."""
    folder = shared_dir(spark, "stage")
    path = _written_csv(spark, sf_dir, folder)
    fields = [T.StructField("timestamp", T.StringType()), *schema.TELEMETRY.fields[1:], *_TIE_TYPES.fields]
    return _per_node(files.stage_csv(spark, path, f"{folder}/parquet", types=T.StructType(fields)))


@query("feature_table_round_trip", _PER_NODE)
def feature_table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table written sorted, and read back with three columns only."""
    folder = shared_dir(spark, "features")
    table_ = compute_features(telemetry(spark, sf_dir), order=ORDER, families={"delta", "cross"})
    files.write_parquet(table_, folder, sort=["node_id", *ORDER])
    return _per_node(files.read_parquet(spark, folder, ["node_id", "timestamp", "latency_ms", "is_anomaly"]))


@query(
    "feature_manifest",
    with_sql(TELEMETRY_SQL)
    + f"""SELECT feature, n AS known_values FROM (SELECT unnest({METRICS + output_columns(METRICS)}) AS feature),
          (SELECT count(*) AS n FROM telemetry)""",
)
def feature_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature names through their manifest file, with the known values of each in the table."""
    folder = shared_dir(spark, "manifest")
    features = compute_features(telemetry(spark, sf_dir), order=ORDER).drop(*TIES)
    names = schema.feature_columns(features.columns)
    files.write_manifest(spark, names, folder)
    counts = present(features, names).agg(*[F.count(c).alias(c) for c in names])
    known = counts.unpivot([], names, "feature", "known_values")
    return files.read_manifest(spark, folder).join(known, "feature")


@query("accepted_requests", with_sql(TELEMETRY_SQL) + "SELECT count(*) AS accepted FROM telemetry WHERE latency_ms <= 60")
def accepted_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass validation when high latencies are sent as missing."""
    from tidemark.plans.scoring import accepted_and_rejected

    rows = telemetry(spark, sf_dir).withColumn("latency_ms", F.when(F.col("latency_ms") <= 60, F.col("latency_ms")))
    return accepted_and_rejected(rows)[0].agg(F.count(F.lit(1)).alias("accepted"))

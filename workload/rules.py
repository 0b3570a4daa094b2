"""Rules, validation, request parsing, alignment, routing, sampling and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import rules as ops
from tidemark.operators import metrics, splits, summary
from workload.base import METRICS, ROW_KEY, TELEMETRY_SQL, query, rounded, shown_sql, telemetry, with_sql

TEL = with_sql(TELEMETRY_SQL)
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "node_id"]
KEY_SQL = ", ".join(KEY)

_RULES = [
    ("latency_ms", ">", "100", "warning"),
    ("latency_ms", ">", "500", "critical"),
    ("packet_loss_pct", ">", "2.0", "warning"),
    ("packet_loss_pct", ">", "10.0", "critical"),
    ("cpu_utilization", ">", "85", "warning"),
    ("cpu_utilization", ">", "95", "critical"),
    ("bandwidth_mbps", "<", "50", "warning"),
    ("bandwidth_mbps", "<", "10", "critical"),
    ("error_rate", ">", "20", "warning"),
    ("error_rate", ">", "50", "critical"),
]
_HITS = ", ".join(f"CASE WHEN {m} {o} {t} THEN '{m} {o} {t}' END" for m, o, t, _ in _RULES)
_CRITICAL = " OR ".join(f"{m} {o} {t}" for m, o, t, s in _RULES if s == "critical")
_ANY = " OR ".join(f"{m} {o} {t}" for m, o, t, _ in _RULES)
_RULED = f"""ruled AS (SELECT *, concat_ws(';', {_HITS}) AS rules, coalesce({_CRITICAL}, FALSE) AS critical,
  coalesce({_ANY}, FALSE) AS hit FROM telemetry)"""


@query(
    "rule_detector",
    with_sql(TELEMETRY_SQL, _RULED)
    + f"""SELECT {KEY_SQL}, CAST(hit AS INT) AS predicted, CASE WHEN critical THEN 1.0::DOUBLE WHEN hit THEN 0.7::DOUBLE ELSE 0.0::DOUBLE END AS confidence,
          CASE WHEN critical THEN 'critical' WHEN hit THEN 'warning' ELSE 'normal' END AS severity, rules,
          CAST(CASE WHEN rules = '' THEN 0 ELSE len(string_split(rules, ';')) END AS INT) AS num_rules_triggered, 'rule-based' AS method FROM ruled""",
)
def rule_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ops.rule_verdict(telemetry(spark, sf_dir), flag="predicted")
    names = F.array_join(F.transform("triggered_rules", lambda r: r["rule"]), ";")
    return out.select(*KEY, "predicted", "confidence", "severity", names.alias("rules"), "num_rules_triggered", "method")


@query(
    "rule_hits",
    with_sql(TELEMETRY_SQL, _RULED, "h AS (SELECT unnest(string_split(rules, ';')) AS rule FROM ruled WHERE rules <> '')")
    + "SELECT rule, count(*) AS hits FROM h GROUP BY rule",
)
def rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each rule holds."""
    out = ops.rule_verdict(telemetry(spark, sf_dir), flag="predicted")
    return out.select(F.explode("triggered_rules").alias("r")).groupBy("r.rule").agg(F.count(F.lit(1)).alias("hits"))


_EVALUATE = """c AS (SELECT count(*) FILTER (hit AND is_anomaly = 1) AS tp, count(*) FILTER (hit AND is_anomaly = 0) AS fp,
  count(*) FILTER (NOT hit AND is_anomaly = 1) AS fn, count(*) FILTER (NOT hit AND is_anomaly = 0) AS tn FROM ruled)"""


@query(
    "rule_baseline_scores",
    with_sql(TELEMETRY_SQL, _RULED, _EVALUATE)
    + """SELECT tp, fp, fn, tn, tp + fp + fn + tn AS total, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision,
         round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1_score FROM c""",
)
def rule_baseline_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule detector against the labels; scores rounded to 4 digits."""
    out = ops.rule_verdict(telemetry(spark, sf_dir), flag="predicted")
    scores = metrics.classification_scores(out, [], "predicted", "is_anomaly")
    return scores.select(
        "tp", "fp", "fn", "tn", "total", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1_score")]
    )


_LIMITS = {"latency_ms": 200, "packet_loss_pct": 5, "cpu_utilization": 95, "error_rate": 50}
_FALLBACK = ", ".join(f"CASE WHEN {m} > {v} THEN '{m}' END" for m, v in _LIMITS.items())


@query(
    "fallback_detector",
    with_sql(TELEMETRY_SQL, f"f AS (SELECT *, concat_ws(',', {_FALLBACK}) AS fallback_rules FROM telemetry)")
    + f"""SELECT {KEY_SQL}, fallback_rules, CAST(fallback_rules <> '' AS INT) AS fallback_anomaly,
          CASE WHEN fallback_rules <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS fallback_confidence FROM f""",
)
def fallback_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ops.fallback_verdict(telemetry(spark, sf_dir))
    return out.select(
        *KEY, F.array_join("fallback_rules", ",").alias("fallback_rules"), "fallback_anomaly", "fallback_confidence"
    )


# Requests with planted faults: negative latency, loss above 100 and a missing metric.
_REQUESTS = """requests AS (SELECT l_orderkey, l_linenumber, l_partkey, node_id,
  CASE WHEN l_orderkey % 11 = 0 THEN -latency_ms ELSE latency_ms END AS latency_ms,
  CASE WHEN l_orderkey % 13 = 0 THEN packet_loss_pct + 100 ELSE packet_loss_pct END AS packet_loss_pct,
  CASE WHEN l_orderkey % 17 <> 0 THEN cpu_utilization END AS cpu_utilization, bandwidth_mbps, error_rate FROM telemetry)"""


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_orderkey")
    return telemetry(spark, sf_dir).select(
        *KEY,
        F.when(k % 11 == 0, -F.col("latency_ms")).otherwise(F.col("latency_ms")).alias("latency_ms"),
        F.when(k % 13 == 0, F.col("packet_loss_pct") + 100).otherwise(F.col("packet_loss_pct")).alias("packet_loss_pct"),
        F.when(k % 17 != 0, F.col("cpu_utilization")).alias("cpu_utilization"),
        "bandwidth_mbps",
        "error_rate",
    )


@query(
    "request_validation",
    with_sql(TELEMETRY_SQL, _REQUESTS)
    + f"""SELECT {KEY_SQL}, concat_ws(';', CASE WHEN latency_ms < 0 THEN 'latency_ms must be >= 0' END,
          CASE WHEN packet_loss_pct > 100 THEN 'packet_loss_pct must be <= 100' END,
          CASE WHEN cpu_utilization IS NULL THEN 'cpu_utilization is required' END) AS errors,
          latency_ms >= 0 AND packet_loss_pct <= 100 AND cpu_utilization IS NOT NULL AS valid FROM requests""",
)
def request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.validate(_requests(spark, sf_dir)).select(*KEY, F.array_join("errors", ";").alias("errors"), "valid")


@query(
    "request_json_batches",
    with_sql(TELEMETRY_SQL, _REQUESTS)
    + f"SELECT {KEY_SQL}, CAST(0 AS INT) AS position, latency_ms, packet_loss_pct, cpu_utilization, bandwidth_mbps, error_rate FROM requests",
)
def request_json_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests written as JSON batches and parsed back to rows."""
    body = F.to_json(F.struct(F.array(F.struct(*METRICS)).alias("records")))
    return ops.parse_requests(_requests(spark, sf_dir).select(*KEY, body.alias("body")), "body")


@query(
    "align_to_training_schema",
    with_sql(TELEMETRY_SQL, _REQUESTS)
    + f"SELECT {KEY_SQL}, latency_ms, coalesce(cpu_utilization, 0) AS cpu_utilization, 0.0::DOUBLE AS latency_ms_zscore FROM requests",
)
def align_to_training_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.align(_requests(spark, sf_dir), ["latency_ms", "cpu_utilization", "latency_ms_zscore"], keep=KEY)


def _unit(seed: str, keys: str = "node_id, l_orderkey, l_linenumber, l_partkey") -> str:
    return f"((('0x' || substr(md5(concat_ws('|', {keys}, '{seed}')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


@query(
    "ab_routing_counts",
    with_sql(TELEMETRY_SQL, f"r AS (SELECT CASE WHEN {_unit('route42')} > 0.8 THEN 'challenger' ELSE 'primary' END AS model_used FROM telemetry)")
    + "SELECT model_used, count(*) AS count FROM r GROUP BY model_used",
)
def ab_routing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.routing_counts(ops.route(telemetry(spark, sf_dir), ROW_KEY))


_HASHED = "h AS (SELECT *, md5(concat_ws('|', node_id, l_orderkey, l_linenumber, l_partkey, '42')) AS h FROM telemetry)"


@query(
    "stratified_split",
    with_sql(
        TELEMETRY_SQL,
        _HASHED,
        """r AS (SELECT *, row_number() OVER (PARTITION BY is_anomaly ORDER BY h) AS place,
             count(*) OVER (PARTITION BY is_anomaly) AS n FROM h)""",
    )
    + f"SELECT {KEY_SQL}, is_anomaly, CASE WHEN place <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r",
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = splits.assign_split(telemetry(spark, sf_dir), ROW_KEY, 0.2, strata=["is_anomaly"])
    return out.select(*KEY, "is_anomaly", "split")


@query(
    "train_validation_split",
    with_sql(
        TELEMETRY_SQL,
        "h AS (SELECT *, md5(concat_ws('|', node_id, l_orderkey, l_linenumber, l_partkey, '42')) AS h FROM telemetry WHERE is_anomaly = 0)",
        "r AS (SELECT *, row_number() OVER (ORDER BY h) AS place, count(*) OVER () AS n FROM h)",
    )
    + f"SELECT {KEY_SQL}, CASE WHEN place <= round(0.15 * n) THEN 'test' ELSE 'train' END AS split FROM r",
)
def train_validation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """85/15 split of the normal rows."""
    normals = summary.only_normal(telemetry(spark, sf_dir))
    return splits.assign_split(normals, ROW_KEY, 0.15).select(*KEY, "split")


@query(
    "seeded_sample",
    with_sql(TELEMETRY_SQL, _HASHED) + f"SELECT {KEY_SQL} FROM h ORDER BY h LIMIT 5000",
)
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.sample_rows(telemetry(spark, sf_dir), ROW_KEY, 5000).select(*KEY)


@query(
    "example_rows",
    TEL
    + f"SELECT {KEY_SQL}, {shown_sql('latency_ms', 6)} AS latency_ms FROM telemetry ORDER BY ts, l_orderkey, l_linenumber, l_partkey, node_id LIMIT 5",
)
def example_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows in time order, as an input example."""
    rows = splits.first_rows(telemetry(spark, sf_dir), ["timestamp", "l_orderkey", "l_linenumber", "l_partkey", "node_id"])
    return rounded(rows.select(*KEY, "latency_ms"), ["latency_ms"], 6)


@query(
    "filtered_first_rows",
    TEL
    + f"""SELECT {KEY_SQL}, {shown_sql('latency_ms', 6)} AS latency_ms FROM telemetry WHERE node_id = 'node-1'
          ORDER BY ts, l_orderkey, l_linenumber, l_partkey LIMIT 50""",
)
def filtered_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One node's first rows: filter by key, then limit in time order."""
    rows = telemetry(spark, sf_dir).where(F.col("node_id") == "node-1")
    first = splits.first_rows(rows, ["timestamp", "l_orderkey", "l_linenumber", "l_partkey"], 50)
    return rounded(first.select(*KEY, "latency_ms"), ["latency_ms"], 6)

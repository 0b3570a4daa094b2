"""Drift between an earlier and a later period, and against what-if scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import drift as ops
from tidemark.operators.features import compute_features
from workload.base import METRICS, ORDER, ORDER_SQL, ROW_KEY, TELEMETRY_SQL, query, rounded, shown_sql, telemetry, with_sql
from workload.features import zscore_sql

CUT = "1999-01-01"


def _periods(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = telemetry(spark, sf_dir)
    early = F.col("timestamp") < F.lit(CUT).cast("timestamp_ntz")
    return rows.where(early), rows.where(~early)


def _scored_periods(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both periods with the z-score columns of the feature table, rounded as the check SQL does."""
    table = compute_features(telemetry(spark, sf_dir), order=ORDER, families={"zscore"})
    rows = rounded(table, [f"{m}_zscore" for m in METRICS])
    early = F.col("timestamp") < F.lit(CUT).cast("timestamp_ntz")
    return rows.where(early), rows.where(~early)


def _long(columns: list[str], source: str, side: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v, '{side}' AS side FROM {source}" for c in columns
    )


_PERIODS = [
    TELEMETRY_SQL,
    f"ref AS (SELECT * FROM telemetry WHERE ts < TIMESTAMP '{CUT}')",
    f"cur AS (SELECT * FROM telemetry WHERE ts >= TIMESTAMP '{CUT}')",
]


ANALYSED = METRICS + [f"{m}_zscore" for m in METRICS]
_SCORED = [
    TELEMETRY_SQL,
    f"""scored AS (SELECT *, {', '.join(zscore_sql(m) for m in METRICS)} FROM telemetry
      WINDOW w_1hr AS (PARTITION BY node_id ORDER BY {ORDER_SQL} ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))""",
    f"ref AS (SELECT * FROM scored WHERE ts < TIMESTAMP '{CUT}')",
    f"cur AS (SELECT * FROM scored WHERE ts >= TIMESTAMP '{CUT}')",
]


def _details(*sources: str, columns: list[str] = METRICS) -> list[str]:
    series = "list_sum(list_transform(range(1, 21), lambda k: CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * x * x)))"
    return [
        *sources,
        f"samples AS (SELECT * FROM ({_long(columns, 'ref', 'ref')} UNION ALL {_long(columns, 'cur', 'cur')}) WHERE v IS NOT NULL)",
        """c AS (SELECT col, v, count(*) FILTER (side = 'ref') AS r, count(*) FILTER (side = 'cur') AS u
             FROM samples GROUP BY col, v)""",
        """g AS (SELECT col, v, lead(v) OVER (PARTITION BY col ORDER BY v) - v AS w,
             abs(sum(r) OVER (PARTITION BY col ORDER BY v) / nullif(sum(r) OVER (PARTITION BY col), 0)
               - sum(u) OVER (PARTITION BY col ORDER BY v) / nullif(sum(u) OVER (PARTITION BY col), 0)) AS gap FROM c)""",
        "d AS (SELECT col, max(gap) AS ks, sum(gap * w) AS area FROM g GROUP BY col)",
        """m AS (SELECT col, avg(v) FILTER (side = 'ref') AS rm, avg(v) FILTER (side = 'cur') AS um,
             stddev_samp(v) FILTER (side = 'ref') AS rs, count(*) FILTER (side = 'ref') AS n,
             count(*) FILTER (side = 'cur') AS k FROM samples GROUP BY col)""",
        "x AS (SELECT *, ks * sqrt(n::DOUBLE * k / (n + k)) AS x, abs(um - rm) / (rs + 1e-10) AS shift FROM d JOIN m USING (col))",
        f"p AS (SELECT *, CASE WHEN x IS NULL THEN NULL WHEN x < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, {series})) END AS pv FROM x)",
        """details AS (SELECT *, coalesce(pv < 0.05 OR shift > 1.0, false) AS drifted, coalesce(area / rs > 0.1, false) AS moved,
             n = 0 OR k = 0 AS missing FROM p)""",
    ]


_DETAIL_COLUMNS = f"""SELECT col AS "column", {shown_sql("ks")} AS ks_statistic, {shown_sql("pv", 6)} AS ks_pvalue,
  {shown_sql("shift")} AS mean_shift_std, {shown_sql("coalesce(area / rs, 0)")} AS wasserstein_norm, {shown_sql("rm")} AS ref_mean,
  {shown_sql("um")} AS curr_mean, n AS ref_size, k AS cur_size, missing, drifted FROM details"""


def _shown(details: DataFrame) -> DataFrame:
    out = rounded(details, ["ks_pvalue"], 6)
    return rounded(out, ["ks_statistic", "mean_shift_std", "wasserstein_norm", "ref_mean", "curr_mean"])


@query("drift_details", with_sql(*_details(*_SCORED, columns=ANALYSED)) + _DETAIL_COLUMNS)
def drift_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(ops.drift_details(*_scored_periods(spark, sf_dir)))


@query("drift_details_binned", with_sql(*_details(*_SCORED, columns=ANALYSED)) + _DETAIL_COLUMNS)
def drift_details_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same distances on the plan for columns with too many distinct values for one task."""
    return _shown(ops.drift_details(*_scored_periods(spark, sf_dir), small_bytes=0))


def _summary(flag: str) -> str:
    return f"""SELECT count(*) FILTER ({flag}) > count(*) * 0.5 AS dataset_drift_detected,
      round(count(*) FILTER ({flag}) / count(*), 4) AS drift_share,
      coalesce(string_agg(col, ',' ORDER BY col) FILTER ({flag}), '') AS drifted_features,
      count(*) FILTER ({flag}) AS num_drifted_features, count(*) AS total_features_analyzed,
      coalesce(string_agg(col, ',' ORDER BY col) FILTER (missing), '') AS missing_features,
      max(n) AS reference_size, max(k) AS current_size FROM details"""


@query("drift_summary", with_sql(*_details(*_SCORED, columns=ANALYSED)) + _summary("drifted"))
def drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drift_summary(ops.drift_details(*_scored_periods(spark, sf_dir)))


@query("drift_summary_wasserstein", with_sql(*_details(*_SCORED, columns=ANALYSED)) + _summary("moved"))
def drift_summary_wasserstein(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = ops.drift_details(*_scored_periods(spark, sf_dir))
    return ops.drift_summary(ops.wasserstein_verdict(details))


_VANISHED = [
    *_PERIODS[:2],
    f"cur AS (SELECT * REPLACE (NULL::DOUBLE AS cpu_utilization, NULL::DOUBLE AS error_rate) FROM telemetry WHERE ts >= TIMESTAMP '{CUT}')",
]


def _vanished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details against a later period that lacks one metric and has another without any value."""
    before, after = _periods(spark, sf_dir)
    return ops.drift_details(before, after.drop("error_rate").withColumn("cpu_utilization", F.lit(None).cast("double")))


@query("drift_details_missing_columns", with_sql(*_details(*_VANISHED)) + _DETAIL_COLUMNS)
def drift_details_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_vanished(spark, sf_dir))


@query("drift_summary_missing_columns", with_sql(*_details(*_VANISHED)) + _summary("drifted"))
def drift_summary_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drift_summary(_vanished(spark, sf_dir))


_KEY_TEXT = "concat_ws('|', node_id, l_orderkey, l_linenumber, l_partkey, {seed})"


def _uniform(seed: str) -> str:
    return f"((('0x' || substr(md5({_KEY_TEXT.format(seed=seed)}), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


def _shifted(level: str) -> str:
    noise = f"-ln(1.0::DOUBLE - {_uniform(chr(39) + '99' + chr(39))})"
    normal = f"sqrt(-2.0 * ln({_uniform(chr(39) + '99r' + chr(39))})) * cos(6.283185307179586 * {_uniform(chr(39) + '99a' + chr(39))})"
    if level == "moderate":
        return f"""cur AS (SELECT latency_ms * 1.5 AS latency_ms, packet_loss_pct + {noise} * 0.5 AS packet_loss_pct,
          greatest(0.0, least(100.0, cpu_utilization + 10)) AS cpu_utilization, bandwidth_mbps, error_rate FROM telemetry)"""
    return f"""cur AS (SELECT latency_ms * 3 AS latency_ms, packet_loss_pct + {noise} * 2.0 AS packet_loss_pct,
      greatest(0.0, least(100.0, 80.0 + 10.0 * {normal})) AS cpu_utilization, bandwidth_mbps * 0.3::DOUBLE AS bandwidth_mbps,
      error_rate * 5 AS error_rate FROM telemetry)"""


def _scenario(level: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = telemetry(spark, sf_dir)
        return _shown(ops.drift_details(rows, ops.shifted_scenario(rows, level, ROW_KEY), METRICS))

    return run


for _level in ("moderate", "severe"):
    query(
        f"drift_scenario_{_level}",
        with_sql(*_details(TELEMETRY_SQL, "ref AS (SELECT * FROM telemetry)", _shifted(_level))) + _DETAIL_COLUMNS,
    )(_scenario(_level))


@query("drift_scenario_none")
def drift_scenario_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for added noise of 5 % of each deviation: no column may be called drifted by shift."""
    rows = telemetry(spark, sf_dir)
    return ops.drift_summary(ops.drift_details(rows, ops.shifted_scenario(rows, "none", ROW_KEY), METRICS))


@query(
    "histogram_divergence",
    with_sql(
        *_PERIODS,
        f"samples AS ({_long(METRICS, 'ref', 'ref')} UNION ALL {_long(METRICS, 'cur', 'cur')})",
        "s AS (SELECT col, min(v) AS low, (max(v) - min(v)) / 20 AS w FROM samples GROUP BY col)",
        """b AS (SELECT col, least(CAST(floor((v - low) / w) AS INT), 19) AS bin, count(*) FILTER (side = 'ref') AS r,
             count(*) FILTER (side = 'cur') AS u FROM samples JOIN s USING (col) GROUP BY 1, 2)""",
        """q AS (SELECT col, (r / sum(r) OVER (PARTITION BY col) + 1e-6) / (1 + 20e-6) AS q,
             (u / sum(u) OVER (PARTITION BY col) + 1e-6) / (1 + 20e-6) AS p FROM b)""",
    )
    + f'SELECT col AS "column", {shown_sql("sum(p * ln(p / q))", 6)} AS kl_divergence FROM q GROUP BY col',
)
def histogram_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = ops.two_samples(*_periods(spark, sf_dir), METRICS)
    return rounded(ops.histogram_divergence(samples), ["kl_divergence"], 6)

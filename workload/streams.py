"""Streaming queries: the given tables read as file streams until all their files are done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import rules
from tidemark.sizing import shared_dir
from tidemark.streaming import jobs
from workload.base import (
    METRICS,
    ORDER,
    ORDER_SQL,
    TELEMETRY_SQL,
    query,
    rounded,
    shown_sql,
    table,
    telemetry,
    telemetry_of,
    with_sql,
)

KEY = ["node_id", "l_orderkey", "l_linenumber", "l_partkey"]
_W = f"w AS (PARTITION BY node_id ORDER BY {ORDER_SQL} ROWS BETWEEN 59 PRECEDING AND CURRENT ROW), o AS (PARTITION BY node_id ORDER BY {ORDER_SQL})"


def _stats(m: str) -> list[str]:
    std = f"stddev_pop({m}) OVER w"
    return [
        f"{shown_sql(f'avg({m}) OVER w')} AS {m}_roll_mean",
        f"{shown_sql(std)} AS {m}_roll_std",
        f"{shown_sql(f'max({m}) OVER w')} AS {m}_roll_max",
        f"{shown_sql(f'CASE WHEN {std} > 1e-9 THEN ({m} - avg({m}) OVER w) / ({std}) ELSE 0 END')} AS {m}_zscore",
        f"{shown_sql(f'coalesce({m} - lag({m}) OVER o, 0)')} AS {m}_delta",
    ]


_COLUMNS = [c for m in METRICS for c in _stats(m)]
_CROSS = [
    f"{shown_sql('latency_ms * packet_loss_pct')} AS latency_x_loss",
    f"{shown_sql('CASE WHEN bandwidth_mbps > 0 THEN cpu_utilization / bandwidth_mbps ELSE 0 END')} AS cpu_bw_ratio",
]
_FEATURES = with_sql(TELEMETRY_SQL) + f"SELECT {', '.join(KEY + _COLUMNS + _CROSS)} FROM telemetry WINDOW {_W}"
_ZS = [f"CASE WHEN stddev_pop({m}) OVER w > 1e-9 THEN abs({m} - avg({m}) OVER w) / (stddev_pop({m}) OVER w) ELSE 0 END" for m in METRICS]
_ALERTS = f"scored AS (SELECT node_id, l_orderkey, l_linenumber, l_partkey, greatest({', '.join(_ZS)}) > 3.0 AS alert FROM telemetry WINDOW {_W})"


def _telemetry_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = table(spark, sf_dir, "lineitem").schema
    return telemetry_of(jobs.file_stream(spark, f"{sf_dir}/lineitem.parquet*", types))


def _run_features(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    folder = shared_dir(spark, "stream-features")
    features = jobs.with_cross(jobs.keyed_features(_telemetry_stream(spark, sf_dir), "node_id", ORDER))
    flagged = features.withColumn("alert", jobs.alert())
    jobs.finish(jobs.to_files(flagged, f"{folder}/out", f"{folder}/checkpoint"))
    return folder, spark.read.parquet(f"{folder}/out")


def _shown(df: DataFrame) -> DataFrame:
    names = [*jobs.stream_columns(METRICS), "latency_x_loss", "cpu_bw_ratio"]
    return rounded(df.select(*KEY, *names), names)


@query("stream_keyed_features", _FEATURES)
def stream_keyed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed 60-record buffers over the file stream."""
    return _shown(_run_features(spark, sf_dir)[1])


@query("stream_features_batch_twin", _FEATURES)
def stream_features_batch_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's features as a batch job, for back-filling and for checking."""
    return _shown(jobs.with_cross(jobs.batch_features(telemetry(spark, sf_dir), "node_id", ORDER)))


@query("stream_zscore_alerts", with_sql(TELEMETRY_SQL, _ALERTS) + f"SELECT {', '.join(KEY)} FROM scored WHERE alert")
def stream_zscore_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_features(spark, sf_dir)[1].where("alert").select(*KEY)


@query(
    "stream_counters",
    with_sql(TELEMETRY_SQL, _ALERTS)
    + "SELECT node_id, count(*) AS processed, count(*) FILTER (alert) AS alerts FROM scored GROUP BY node_id",
)
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stream counts the records and alerts the first one writes."""
    folder, written = _run_features(spark, sf_dir)
    counted = jobs.counters(jobs.file_stream(spark, f"{folder}/out", written.schema), "node_id")
    jobs.finish(jobs.to_changes(counted, f"{folder}/counters", f"{folder}/counters-checkpoint"))
    return jobs.merged_changes(spark, f"{folder}/counters", ["node_id"])


_HOURLY = f"""SELECT event_type, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour, count(*) AS records,
  {shown_sql("avg(value)")} AS value_mean, max(value) AS value_max FROM events"""
PARTS = 4


def _event_files(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The events as a stream of files, oldest first, one file a micro-batch. The last file begins with
    an event of the first hour, far behind the watermark."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    span = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    edges = [span.low + (span.high - span.low) * k / PARTS for k in range(PARTS)]
    for k, low in enumerate(edges):
        part = events.where(F.col("ts") >= F.lit(low))
        part = part.where(F.col("ts") < F.lit(edges[k + 1])) if k + 1 < PARTS else part
        if k + 1 == PARTS:
            part = part.unionByName(events.where(F.col("ts") == F.lit(span.low)).withColumn("value", F.lit(1e9)))
        part.coalesce(1).write.mode("append").parquet(folder)
    return jobs.file_stream(spark, folder, events.schema, files_per_trigger=1)


def _hourly(df: DataFrame) -> DataFrame:
    return rounded(df.withColumn("hour", F.unix_seconds("hour")), ["value_mean"])


@query("stream_hourly_view", f"{_HOURLY} GROUP BY 1, 2")
def stream_hourly_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours so far, open ones included: each batch writes the hours it changed."""
    folder = shared_dir(spark, "stream-hourly")
    hourly = jobs.hourly_view(_event_files(spark, sf_dir, f"{folder}/in"), "event_type", "ts", ["value"])
    jobs.finish(jobs.to_changes(hourly, f"{folder}/out", f"{folder}/checkpoint"))
    return _hourly(jobs.merged_changes(spark, f"{folder}/out", ["event_type", "hour"]))


@query(
    "stream_hourly_closed",
    f"{_HOURLY} WHERE date_trunc('hour', ts) + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events) GROUP BY 1, 2",
)
def stream_hourly_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that the watermark has closed, each written once and for good."""
    folder = shared_dir(spark, "stream-hourly-closed")
    hourly = jobs.hourly_view(_event_files(spark, sf_dir, f"{folder}/in"), "event_type", "ts", ["value"])
    jobs.finish(jobs.to_files(hourly, f"{folder}/out", f"{folder}/checkpoint"))
    return _hourly(spark.read.parquet(f"{folder}/out"))


_LIMIT_SQL = "latency_ms > 200 OR packet_loss_pct > 5 OR cpu_utilization > 95 OR error_rate > 50"


@query(
    "stream_rule_scoring",
    with_sql(TELEMETRY_SQL)
    + f"""SELECT {', '.join(KEY)}, CAST({_LIMIT_SQL} AS INT) AS predicted,
          CASE WHEN {_LIMIT_SQL} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence, 'rule-based-fallback' AS method FROM telemetry""",
)
def stream_rule_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches scored while no model is there: every record falls back to the rules."""
    from tidemark.plans.scoring import score_records

    folder = shared_dir(spark, "stream-scoring")

    def load():
        return lambda batch: score_records(batch, KEY, primary=None, challenger=None)

    jobs.finish(jobs.score_stream(_telemetry_stream(spark, sf_dir), load, f"{folder}/out", f"{folder}/checkpoint"))
    out = spark.read.parquet(f"{folder}/out")
    return out.select(*KEY, F.col("prediction").alias("predicted"), "confidence", "method")


_SWAP_SQL = "CASE WHEN l_orderkey % 2 = 0 THEN latency_ms > 50 ELSE cpu_utilization > 80 END"


@query(
    "stream_model_swap",
    with_sql(TELEMETRY_SQL)
    + f"""SELECT {', '.join(KEY)}, CAST({_SWAP_SQL} AS INT) AS predicted, 0.9::DOUBLE AS confidence, 'ml-model' AS method,
          CASE WHEN l_orderkey % 2 = 0 THEN 'models:/1' ELSE 'models:/2' END AS model_uri FROM telemetry""",
)
def stream_model_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream scored by a model that is replaced while its files go on arriving.

    Even orders arrive first and are scored by version 1; then version 2 takes over, odd orders
    arrive, and the stream goes on from its checkpoint.
    """
    from tidemark.plans.scoring import column_model, score_records

    folder = shared_dir(spark, "stream-swap")
    lines = table(spark, sf_dir, "lineitem")
    versions = [column_model(F.col("latency_ms") > 50), column_model(F.col("cpu_utilization") > 80)]
    serving = {"version": 0}

    def load():
        model, uri = versions[serving["version"]], f"models:/{serving['version'] + 1}"
        return lambda batch: score_records(batch, KEY, primary=model, challenger=None, uris={"primary": uri})

    for version in range(2):
        lines.where(F.col("l_orderkey") % 2 == version).write.mode("append").parquet(f"{folder}/in")
        serving["version"] = version
        stream = telemetry_of(jobs.file_stream(spark, f"{folder}/in", lines.schema))
        jobs.finish(jobs.score_stream(stream, load, f"{folder}/out", f"{folder}/checkpoint"))
    out = spark.read.parquet(f"{folder}/out")
    return out.select(*KEY, F.col("prediction").alias("predicted"), "confidence", "method", "model_uri")


@query(
    "stream_fitted_model_swap",
    with_sql(TELEMETRY_SQL)
    + """SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'models:/1' ELSE 'models:/2' END AS model_uri, 'ml-model' AS method,
         count(*) AS records, true AS agrees FROM telemetry GROUP BY 1""",
)
def stream_fitted_model_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream scored by a trained model out of a shared folder, which is replaced while files arrive.

    Version 1 has learned one rule from the table, version 2 another; every batch loads the version in
    force. Each must agree with its rule on 98 % of the records that it scored.
    """
    from tidemark.operators.boosting import BoostedTrees, BoostSettings, read_model, write_model
    from tidemark.plans.scoring import fitted_model, score_records

    folder = shared_dir(spark, "stream-fitted")
    lines = table(spark, sf_dir, "lineitem")
    truths = [F.col("latency_ms") > 50, F.col("cpu_utilization") > 80]
    settings = BoostSettings(rounds=12, depth=3, rate=0.5, rows=1.0, columns=1.0)
    known = telemetry(spark, sf_dir)
    for version, truth in enumerate(truths):
        model = BoostedTrees(METRICS, "label", None, settings).fit(known.withColumn("label", truth.cast("int")))
        write_model(spark, model, f"{folder}/models/{version + 1}")
    serving = {"version": 1}

    def load():
        version = serving["version"]
        model = fitted_model(read_model(spark, f"{folder}/models/{version}"), METRICS, KEY)
        return lambda batch: score_records(batch, KEY, primary=model, challenger=None, uris={"primary": f"models:/{version}"})

    for version in range(2):
        lines.where(F.col("l_orderkey") % 2 == version).write.mode("append").parquet(f"{folder}/in")
        serving["version"] = version + 1
        stream = telemetry_of(jobs.file_stream(spark, f"{folder}/in", lines.schema))
        jobs.finish(jobs.score_stream(stream, load, f"{folder}/out", f"{folder}/checkpoint"))
    out = spark.read.parquet(f"{folder}/out")
    truth = F.when(F.col("model_uri") == "models:/1", truths[0]).otherwise(truths[1]).cast("int")
    return out.groupBy("model_uri", "method").agg(
        F.count(F.lit(1)).alias("records"), (F.avg((F.col("prediction") == truth).cast("int")) >= 0.98).alias("agrees")
    )

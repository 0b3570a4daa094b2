"""Point-in-time joins, feature views, latest values, episodes and expected time lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import asof, timeline
from tidemark.operators.features import compute_features
from tidemark.sizing import shared_dir
from tidemark.sources import views as fv
from tidemark.sources.online import materialize_interval, online_table
from workload.base import (
    EVENTS_SQL,
    ORDER,
    ORDER_SQL,
    TELEMETRY_SQL,
    TIES,
    event_series,
    query,
    rounded,
    shown_sql,
    table,
    telemetry,
    with_sql,
)

# Entity rows: the error events. Feature rows: all other events of the same user.
_ASOF_COLUMNS = ["latency_ms", "cpu_utilization"]


def _asof(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    series = event_series(spark, sf_dir)
    entities = series.where(F.col("is_anomaly") == 1).select("node_id", "timestamp", "event_id")
    features = series.where(F.col("is_anomaly") == 0)
    out = asof.asof_join(
        entities,
        features,
        key="node_id",
        entity_ts="timestamp",
        feature_ts="timestamp",
        columns=["event_id", *_ASOF_COLUMNS],
        ttl="24 hours",
        tie=["event_id"],
        prefix="seen_",
        **options,
    )
    return out.select("event_id", F.col("seen_event_id").cast("string").alias("seen_event_id"), "seen_latency_ms", "seen_cpu_utilization")


_ASOF = (
    with_sql(
        EVENTS_SQL,
        "f AS (SELECT * FROM series WHERE is_anomaly = 0)",
        "e AS (SELECT * FROM series WHERE is_anomaly = 1)",
        """j AS (SELECT e.event_id, f.event_id AS fid, f.latency_ms AS l, f.cpu_utilization AS c,
             f.ts >= e.ts - INTERVAL 24 HOUR AS fresh FROM e ASOF LEFT JOIN f ON e.node_id = f.node_id AND e.ts >= f.ts)""",
    )
    + """SELECT event_id, CAST(CASE WHEN fresh THEN fid END AS VARCHAR) AS seen_event_id, CASE WHEN fresh THEN l END AS seen_latency_ms,
         CASE WHEN fresh THEN c END AS seen_cpu_utilization FROM j"""
)


@query("point_in_time_join", _ASOF)
def point_in_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir)


@query("point_in_time_join_split_keys", _ASOF)
def point_in_time_join_split_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join on the plan for hot keys."""
    return _asof(spark, sf_dir, target_rows=20, small_bytes=0)


def _views(spark: SparkSession, sf_dir: str) -> dict[str, fv.FeatureView]:
    raw = telemetry(spark, sf_dir)

    def engineered(_: SparkSession, narrow=lambda rows: rows) -> DataFrame:
        return compute_features(narrow(raw), order=ORDER, families={"rolling", "delta", "cross", "zscore", "calendar"})

    return fv.network_views(lambda _: raw, engineered, tie=tuple(TIES), narrows=True)


REFERENCES = [
    "network_raw_metrics:error_rate",
    "network_raw_metrics:bandwidth_mbps",
    "network_engineered_features:latency_ms_zscore",
    "network_engineered_features:packet_loss_pct_delta_1m",
    "network_engineered_features:bandwidth_mbps_roll_mean_5min",
    "network_engineered_features:latency_x_loss",
    "network_engineered_features:hour",
]

_ENRICHED = f"""enriched AS (
  SELECT *, CASE WHEN count(*) OVER w >= 10 AND coalesce(stddev_samp(latency_ms) OVER w, 0) > 0
    THEN (latency_ms - avg(latency_ms) OVER w) / (stddev_samp(latency_ms) OVER w) ELSE 0 END AS z,
    coalesce(packet_loss_pct - lag(packet_loss_pct) OVER (PARTITION BY node_id ORDER BY {ORDER_SQL}), 0) AS loss_step,
    avg(bandwidth_mbps) OVER (PARTITION BY node_id ORDER BY {ORDER_SQL} ROWS 4 PRECEDING) AS bandwidth_mean,
    latency_ms * packet_loss_pct AS product, hour(ts) AS hour_of_day,
    row_number() OVER (PARTITION BY node_id, ts ORDER BY {ORDER_SQL} DESC) AS newest
  FROM telemetry WINDOW w AS (PARTITION BY node_id ORDER BY {ORDER_SQL} ROWS 59 PRECEDING))"""


@query(
    "historical_features",
    with_sql(
        TELEMETRY_SQL,
        _ENRICHED,
        "lines AS (SELECT * FROM enriched QUALIFY row_number() OVER (PARTITION BY node_id, ts ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) = 1)",
        "entities AS (SELECT 'node-' || s_suppkey AS node_id, o_orderdate AS ts, o_orderkey FROM orders JOIN supplier ON o_custkey % (SELECT count(*) FROM supplier) + 1 = s_suppkey)",
    )
    + f"""SELECT o_orderkey, e.node_id,
      {shown_sql("CASE WHEN l.ts >= e.ts - INTERVAL 24 HOUR THEN error_rate END")} AS error_rate,
      {shown_sql("CASE WHEN l.ts >= e.ts - INTERVAL 24 HOUR THEN bandwidth_mbps END", 2)} AS bandwidth_mbps,
      {shown_sql("CASE WHEN l.ts >= e.ts - INTERVAL 24 HOUR THEN z END")} AS latency_ms_zscore,
      {shown_sql("CASE WHEN l.ts >= e.ts - INTERVAL 24 HOUR THEN loss_step END")} AS packet_loss_pct_delta_1m,
      {shown_sql("CASE WHEN l.ts >= e.ts - INTERVAL 24 HOUR THEN bandwidth_mean END", 2)} AS bandwidth_mbps_roll_mean_5min,
      {shown_sql("CASE WHEN l.ts >= e.ts - INTERVAL 24 HOUR THEN product END")} AS latency_x_loss,
      CASE WHEN l.ts >= e.ts - INTERVAL 24 HOUR THEN CAST(hour_of_day AS DOUBLE) END AS hour
      FROM entities e ASOF LEFT JOIN lines l ON e.node_id = l.node_id AND e.ts >= l.ts""",
)
def historical_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two views matched to order rows at their order time, each within 24 hours."""
    suppliers = table(spark, sf_dir, "supplier")
    nodes = suppliers.agg(F.count(F.lit(1)).alias("n")).scalar()
    entities = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", F.col("o_orderdate").alias("timestamp"), (F.col("o_custkey") % nodes + 1).alias("s_suppkey"))
        .join(suppliers.select("s_suppkey"), "s_suppkey")
        .select("o_orderkey", "timestamp", F.concat(F.lit("node-"), F.col("s_suppkey").cast("string")).alias("node_id"))
    )
    out = fv.historical_features(entities, REFERENCES, _views(spark, sf_dir))
    names = [r.partition(":")[2] for r in REFERENCES]
    wide = [n for n in names if n.startswith("bandwidth")]
    fine = [n for n in names if n != "hour" and n not in wide]
    whole = out.select("o_orderkey", "node_id", *names).withColumn("hour", F.col("hour").cast("double"))
    return rounded(rounded(whole, fine), wide, 2)


_LATEST = f"""latest AS (SELECT * FROM enriched WHERE ts BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'
  QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) = 1)"""


def _bounds():
    return F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("2000-12-31").cast("timestamp_ntz")


@query(
    "materialize_latest",
    with_sql(TELEMETRY_SQL, _ENRICHED, _LATEST)
    + "SELECT node_id, l_orderkey, l_linenumber, latency_ms, packet_loss_pct, cpu_utilization, error_rate FROM latest",
)
def materialize_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _views(spark, sf_dir)[fv.RAW_VIEW]
    out = fv.materialize(view, spark, *_bounds())
    return out.select("node_id", "l_orderkey", "l_linenumber", "latency_ms", "packet_loss_pct", "cpu_utilization", "error_rate")


@query(
    "online_table_intervals",
    with_sql(TELEMETRY_SQL, _ENRICHED, _LATEST)
    + "SELECT node_id, l_orderkey, l_linenumber, latency_ms, packet_loss_pct, cpu_utilization, error_rate FROM latest",
)
def online_table_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The online table kept up to date over three intervals, only touched buckets being written."""
    view, path = _views(spark, sf_dir)[fv.RAW_VIEW], shared_dir(spark, "online")
    start, end = _bounds()
    steps = [F.lit(t).cast("timestamp_ntz") for t in ("1998-06-30", "1999-12-31")]
    rows = fv.view_table(view.read(spark), view).where(F.col("timestamp") >= start)
    for version, (after, upto) in enumerate(zip([None, *steps], [*steps, end]), 1):
        materialize_interval(rows, path, version, key=view.entity, ts=view.timestamp_field, tie=list(view.tie), after=after, upto=upto)
    out = online_table(spark, path)
    return out.select("node_id", "l_orderkey", "l_linenumber", "latency_ms", "packet_loss_pct", "cpu_utilization", "error_rate")


@query(
    "online_features",
    with_sql(
        TELEMETRY_SQL,
        _ENRICHED,
        _LATEST,
        "asked AS (SELECT 'node-' || s_suppkey AS node_id FROM supplier UNION ALL SELECT 'unknown-' || n_nationkey FROM nation)",
    )
    + f"""SELECT a.node_id, {shown_sql("error_rate")} AS error_rate, {shown_sql("bandwidth_mbps", 2)} AS bandwidth_mbps,
          {shown_sql("z")} AS latency_ms_zscore, {shown_sql("loss_step")} AS packet_loss_pct_delta_1m
          FROM asked a LEFT JOIN latest l ON a.node_id = l.node_id""",
)
def online_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest values for every supplier node and for keys that no view knows."""
    known = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("node-"), F.col("s_suppkey").cast("string")).alias("node_id")
    )
    unknown = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("unknown-"), F.col("n_nationkey").cast("string")).alias("node_id")
    )
    views, asked = _views(spark, sf_dir), known.unionByName(unknown)
    tables = {n: fv.materialize(v, spark, *_bounds(), keys=asked) for n, v in views.items()}
    out = fv.online_features(asked, REFERENCES[:4], views, tables)
    return rounded(rounded(out, ["error_rate", "latency_ms_zscore", "packet_loss_pct_delta_1m"]), ["bandwidth_mbps"], 2)


@query(
    "feature_catalog_coverage",
    with_sql(
        TELEMETRY_SQL,
        "n AS (SELECT count(*) AS n FROM telemetry)",
        f"""f AS (SELECT 'network_raw_metrics' AS view, unnest({list(fv.RAW_FIELDS)}) AS feature
           UNION ALL SELECT 'network_engineered_features', unnest({list(fv.ENGINEERED_FIELDS)}))""",
    )
    + """SELECT view, feature, 'node_id' AS entity, '24 hours' AS ttl,
         CASE WHEN feature IN ('hour', 'is_business_hours') THEN 'bigint' ELSE 'double' END AS dtype, n AS known_values FROM f, n""",
)
def feature_catalog_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fv.coverage(spark, _views(spark, sf_dir))
    return out.select("view", "feature", "entity", "ttl", "dtype", "known_values")


_EPISODES = (
    with_sql(
        TELEMETRY_SQL,
        f"""c AS (SELECT *, CASE WHEN anomaly_type = lag(anomaly_type) OVER (PARTITION BY node_id ORDER BY {ORDER_SQL})
             THEN 0 ELSE 1 END AS changed FROM telemetry)""",
        f"r AS (SELECT *, sum(changed) OVER (PARTITION BY node_id ORDER BY {ORDER_SQL}) AS run FROM c)",
    )
    + """SELECT node_id, anomaly_type, CAST(epoch(min(ts)) / 86400 AS INT) AS start_day, CAST(epoch(max(ts)) / 86400 AS INT) AS end_day,
         count(*) AS length FROM r WHERE anomaly_type <> 'none' GROUP BY node_id, anomaly_type, run"""
)


def _episodes(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    out = timeline.episodes(telemetry(spark, sf_dir), "node_id", ORDER, "anomaly_type", **options)
    epoch = F.lit("1970-01-01").cast("date")
    return out.select(
        "node_id",
        "anomaly_type",
        F.datediff("start", epoch).alias("start_day"),
        F.datediff("end", epoch).alias("end_day"),
        "length",
    )


@query("anomaly_episodes", _EPISODES)
def anomaly_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _episodes(spark, sf_dir)


@query("anomaly_episodes_split_series", _EPISODES)
def anomaly_episodes_split_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _episodes(spark, sf_dir, target_rows=100, small_bytes=0)


def _hours_seen(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The hours with an event per user, and the users with the span of the table."""
    seen = event_series(spark, sf_dir).select(
        "node_id", F.date_trunc("hour", F.col("timestamp")).cast("timestamp").alias("timestamp")
    )
    span = seen.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    start = span.select("lo").scalar()
    end = span.select("hi").scalar() + F.expr("INTERVAL '1 hour'")
    return seen, seen.select("node_id").distinct().select("node_id", start.alias("_lo"), end.alias("_hi"))


@query(
    "time_gap_report",
    with_sql(
        "h AS (SELECT user_id, date_trunc('hour', ts) AS hour FROM events GROUP BY 1, 2)",
        "b AS (SELECT min(hour) AS lo, max(hour) AS hi FROM h)",
        """s AS (SELECT u.user_id, t.hour FROM (SELECT DISTINCT user_id FROM events) u,
             (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM b) t)""",
    )
    + f"""SELECT 'user-' || s.user_id AS node_id, count(*) AS expected, count(*) FILTER (h.hour IS NULL) AS missing,
          {shown_sql("count(h.hour) / count(*)", 6)} AS coverage
          FROM s LEFT JOIN h ON s.user_id = h.user_id AND s.hour = h.hour GROUP BY s.user_id""",
)
def time_gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours without an event, per user, over the span of the table."""
    seen, keys = _hours_seen(spark, sf_dir)
    report = timeline.gap_report(keys, "node_id", F.col("_lo"), F.col("_hi"), seen, "1 hour")
    return rounded(report, ["coverage"], 6)


@query(
    "time_gaps",
    with_sql(
        "h AS (SELECT user_id, date_trunc('hour', ts) AS hour FROM events GROUP BY 1, 2)",
        "b AS (SELECT min(hour) AS lo, max(hour) AS hi FROM h)",
        """s AS (SELECT u.user_id, t.hour FROM (SELECT DISTINCT user_id FROM events) u,
             (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM b) t)""",
    )
    + """SELECT 'user-' || s.user_id AS node_id, CAST(epoch(s.hour) AS BIGINT) AS hour
         FROM s LEFT JOIN h ON s.user_id = h.user_id AND s.hour = h.hour WHERE h.hour IS NULL""",
)
def time_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours without an event themselves, per user."""
    seen, keys = _hours_seen(spark, sf_dir)
    expected = timeline.spine(keys, "node_id", F.col("_lo"), F.col("_hi"), "1 hour")
    return timeline.gaps(expected, seen, "node_id").select("node_id", F.unix_seconds("timestamp").alias("hour"))

"""Files: telemetry CSV and Parquet, feature manifests, JSON summaries, run history."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema
from tidemark.functions.expr import nan_to_null
from tidemark.sizing import shared_dir, shuffles_dropped


def read_telemetry_csv(spark: SparkSession, path: str, extra: T.StructType | None = None) -> DataFrame:
    """CSV with a header and the fixed telemetry types (no inference pass over the data); NaN becomes NULL."""
    fields = schema.TELEMETRY.fields + (extra.fields if extra else [])
    rows = spark.read.schema(T.StructType(fields)).csv(path, header=True)
    return rows.withColumns({m: nan_to_null(m) for m in schema.METRICS})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet table; a missing path is Spark's own PATH_NOT_FOUND error."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(
    df: DataFrame, path: str, *, sort: list[str] | None = None, partition: list[str] | None = None, codec: str | None = None
) -> None:
    """Overwrite a table; `sort` orders rows inside each file, so readers can skip row groups."""
    out = df.sortWithinPartitions(*sort) if sort else df
    writer = out.write.mode("overwrite")
    if codec:
        writer = writer.option("compression", codec)
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For results that several jobs use, such as training input or scored rows: it cuts the lineage,
    survives lost executors, and gives the optimizer real sizes. `codec` is for tables so large that
    their size counts more than the time to pack them.
    """
    path = shared_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        write_parquet(df, path, codec=codec)
    return df.sparkSession.read.parquet(path)


def stage_csv(spark: SparkSession, csv: str, parquet: str, ts: str = "timestamp", types: T.StructType | None = None) -> DataFrame:
    """CSV to Parquet with the time column as a timestamp; hands back the staged table."""
    raw = spark.read.schema(types).csv(csv, header=True) if types else spark.read.csv(csv, header=True)
    write_parquet(raw.withColumn(ts, F.to_timestamp(ts)), parquet)
    return spark.read.parquet(parquet)


def write_manifest(spark: SparkSession, columns: list[str], path: str) -> None:
    """Feature-column list, one name per line."""
    spark.createDataFrame([(c,) for c in columns], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Column names of a manifest; blank lines are skipped."""
    name = F.trim("value")
    return spark.read.text(path).select(name.alias("feature")).where(F.length("feature") > 0)


def write_summary(summary: DataFrame, path: str) -> None:
    """Monitoring summary (a single row) as JSON, whatever the outcome."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def read_drift_summary(spark: SparkSession, path: str) -> DataFrame:
    """Last drift summary; without one, a row that says no drift."""
    types = "dataset_drift_detected boolean, drift_share double"
    try:
        found = spark.read.schema(types).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([(None, None)], types)
    return found.select(
        F.coalesce("dataset_drift_detected", F.lit(False)).alias("dataset_drift_detected"),
        F.coalesce("drift_share", F.lit(0.0)).alias("drift_share"),
    )


def append_runs(rows: DataFrame, path: str) -> None:
    """Add parameters, metrics and tags to the run history (one row per key)."""
    names = [f.name for f in schema.RUNS.fields]
    rows.select(*[F.col(n).cast(f.dataType).alias(n) for n, f in zip(names, schema.RUNS.fields)]).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.RUNS).parquet(path)

"""Online table: the newest row per key, kept up to date interval by interval.

Keys are dealt into a fixed number of buckets. An interval's new rows are reduced to the newest per
key; only the buckets that they touch are merged with what these hold and written again, as a new
version of the bucket. A manifest says which buckets a version wrote; it is written last, so a version
is there as a whole or not at all, and running one again replaces what it wrote. Older versions stay
readable.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import latest_per_key

BUCKETS = 64


def _manifest(spark: SparkSession, path: str, version: int | None) -> dict[int, int]:
    """The version in force per bucket, up to `version`: at most as many entries as buckets."""
    try:
        saved = spark.read.schema("bucket int, version int").parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    upto = saved if version is None else saved.where(F.col("version") <= version)
    return {r.bucket: r.version for r in upto.groupBy("bucket").agg(F.max("version").alias("version")).collect()}


def _rows(spark: SparkSession, path: str, current: dict[int, int]) -> DataFrame:
    """Rows of the given buckets in the given versions; the filter is on folders, so no other is read."""
    saved = spark.read.parquet(f"{path}/data")
    places = [(F.col("bucket") == b) & (F.col("version") == v) for b, v in sorted(current.items())]
    return saved.where(reduce(or_, places, F.lit(False)))


def online_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest row per key as of a version (default: the last one)."""
    return _rows(spark, path, _manifest(spark, path, version)).drop("bucket", "version")


def materialize_interval(
    rows: DataFrame, path: str, version: int, *, key: str, ts: str, tie: list[str] | None = None,
    after: Column | None = None, upto: Column | None = None, buckets: int = BUCKETS,
) -> list[int]:
    """Merge the rows of the interval (after, upto] into the table; the buckets that were written.

    `version` must grow with the intervals; one that was begun before is made again from the version
    before it. Rows without key or time are left out.
    """
    spark = rows.sparkSession
    inside = rows if after is None else rows.where(F.col(ts) > after)
    placed = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    fresh = latest_per_key(inside, key, ts, tie, end=upto).withColumn("bucket", placed)
    touched = sorted(r.bucket for r in fresh.select("bucket").distinct().collect())
    if not touched:
        return touched
    current = {b: v for b, v in _manifest(spark, path, version - 1).items() if b in set(touched)}
    if current:
        held = _rows(spark, path, current).drop("version")
        fresh = latest_per_key(fresh.unionByName(held.select(fresh.columns)), key, ts, tie)
    merged = fresh.withColumn("version", F.lit(version)).repartition("bucket")
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version")
    writer.parquet(f"{path}/data")
    done = spark.createDataFrame([(b,) for b in touched], "bucket int").withColumn("version", F.lit(version))
    done.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{path}/manifest")
    return touched

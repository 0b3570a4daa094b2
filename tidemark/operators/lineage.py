"""Data versions: fingerprints, change check, differences, lineage to runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def row_digest(columns: list[str]) -> Column:
    """60-bit number from the md5 of a row's text.

    Every part is written as its length, a colon and its text; NULL is a bare dash. So no two
    different rows have the same text, whatever their values hold.
    """
    texts = [F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, columns: list[str], groups: list[str] | None = None) -> DataFrame:
    """Order-free fingerprint of a table: row count, digest sum and schema digest.

    One aggregate with map-side combine, whatever the number of files or their order.
    """
    schema_text = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.select(*columns).schema.fields)
    sums = df.groupBy(*(groups or [])).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_digest(columns)).alias("digest")
    )
    content = _content_hash(F.col("rows"), F.col("digest"))
    return sums.select(
        *(groups or []), "rows", content.alias("content_hash"), F.md5(F.lit(schema_text)).alias("schema_hash")
    )


FILES = "file string, bytes long, modified timestamp, rows long, digest decimal(38,0)"


def file_fingerprints(spark: SparkSession, path: str, columns: list[str], known: DataFrame | None = None) -> DataFrame:
    """Rows (file, bytes, modified, rows, digest) of the Parquet files below `path`.

    Files that `known`, an earlier result, has with the same size and time are not read again; files
    that are gone leave the result. Digests add up, so those of any set of files give its fingerprint.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    # Only the listing is used: contents are not read.
    there = listed.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    same = ["file", "bytes", "modified"]
    fresh = there if known is None else there.join(known, same, "left_anti")
    paths = [r.file for r in fresh.select("file").collect()]
    old = known.join(there, same, "left_semi") if known is not None else spark.createDataFrame([], FILES)
    if not paths:
        return old.select(*[c.split()[0] for c in FILES.split(", ")])
    rows = spark.read.option("basePath", path).parquet(*paths)
    read = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_digest(columns)).alias("digest")
    )
    counted = fresh.join(read, "file", "left").withColumns(
        {"rows": F.coalesce("rows", F.lit(0)), "digest": F.coalesce("digest", F.lit(0)).cast("decimal(38,0)")}
    )
    return old.unionByName(counted)


def combined_fingerprint(files: DataFrame, groups: dict[str, Column] | None = None) -> DataFrame:
    """Fingerprint of the files of each group (by default all): files, bytes, rows and content hash."""
    groups = groups or {}
    sums = files.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.sum("digest").alias("_digest")
    )
    return sums.select(*groups, "files", "bytes", "rows", _content_hash(F.col("rows"), F.col("_digest")).alias("content_hash"))


def _content_hash(rows: Column, digest: Column) -> Column:
    return F.md5(F.concat_ws("|", rows.cast("string"), F.coalesce(digest.cast("decimal(38,0)").cast("string"), F.lit("0"))))


def changed_versions(fingerprints: DataFrame, dataset: str, version: str) -> DataFrame:
    """Each version beside the one before it, with a flag whether the content changed."""
    before = F.lag("content_hash").over(Window.partitionBy(dataset).orderBy(version))
    return fingerprints.select(
        dataset,
        version,
        "content_hash",
        before.alias("previous_hash"),
        F.coalesce(before != F.col("content_hash"), F.lit(True)).alias("changed"),
    )


def version_diff(old: DataFrame, new: DataFrame, groups: list[str]) -> DataFrame:
    """Rows added and removed between two versions, per group; equal rows cancel one by one."""
    signed = new.withColumn("_sign", F.lit(1)).unionByName(old.withColumn("_sign", F.lit(-1)))
    net = signed.groupBy(*new.columns).agg(F.sum("_sign").alias("_net")).where(F.col("_net") != 0)
    return net.groupBy(*groups).agg(
        F.sum(F.greatest(F.col("_net"), F.lit(0))).alias("added"), F.sum(F.greatest(-F.col("_net"), F.lit(0))).alias("removed")
    )


def run_lineage(runs: DataFrame, fingerprints: DataFrame, dataset: str) -> DataFrame:
    """Runs with the data version they were trained on; unknown hashes keep NULL."""
    used = runs.where((F.col("kind") == "param") & (F.col("key") == "data_version")).select(
        "run_id", F.col("value").alias("content_hash")
    )
    return used.join(fingerprints.select(dataset, "content_hash", "rows"), "content_hash", "left")

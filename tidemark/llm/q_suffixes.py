"""Query 1: byte strings of `documents` that repeat from earlier documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.suffix_dedup import remove_repeats


@query("op1_suffix_dedup")
def suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

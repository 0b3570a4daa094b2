"""Cleaning of a corpus, stage by stage; each stage's result is written and read again.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns the
columns of `documents`; the last one returns the encoded texts. Columns beside those of `documents`
pass through. Nulls, empty and repeated rows are treated as the stage's operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import sized, written
from tidemark.llm.decontamination import without_contaminated
from tidemark.llm.jaccard_join import jaccard_groups
from tidemark.llm.language_id import UNKNOWN, fit, identify
from tidemark.llm.line_dedup import drop_boilerplate
from tidemark.llm.q_language import held_out
from tidemark.llm.q_pieces import MODEL
from tidemark.llm.sentence_pieces import encoded
from tidemark.llm.textcols import free_name
from tidemark.session import tune
from tidemark.sizing import shared_dir

MIN_LANGUAGE_SCORE = 0.3
# Whole texts are read and go to Python in small batches: buffers of an executor keep the size of the largest.
TEXT_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.parquet.columnarReaderBatchSize": "1024"}
ORACLE_SQL = None  # language ID cannot be said in SQL


def small_texts(spark: SparkSession) -> None:
    """Sets TEXT_BATCHES for this session; stages are run by whoever writes them, so it stays set."""
    for key, value in TEXT_BATCHES.items():
        spark.conf.set(key, value)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts with a letter whose language is told with at least MIN_LANGUAGE_SCORE.

    The network learns from the labelled rows of `docs` outside the held-out third.
    """
    small_texts(spark)
    judged = identify(docs, fit(docs, ~held_out()))
    kept = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.drop("lang_pred", "score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines out; texts that had nothing else go, and n_chars follows the text."""
    small_texts(spark)
    cleaned = drop_boilerplate(docs, host="source")
    kept = cleaned.where((F.col("n_dropped") == 0) | F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of similar texts (5-word shingles, 0.8) the one of the smallest id.

    Of repeated rows with one id one stays; rows without id all stay.
    """
    small_texts(spark)
    groups = jaccard_groups(docs, n=5, num=80, den=100)
    other = free_name(docs, "other_id")
    gone = written(groups.where("component_id < doc_id").select(F.col("doc_id").alias(other)).distinct(), "gone")
    kept = docs.join(sized(gone), F.col("doc_id") == F.col(other), "left_anti")
    twice = groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(other))
    twice = sized(written(twice, "again"))
    single = kept.join(twice, F.col("doc_id") == F.col(other), "left_anti")
    repeated = kept.join(twice, F.col("doc_id") == F.col(other), "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(repeated).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    small_texts(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_contaminated(docs, items).select(*docs.columns)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, their number, and whether they decode to the text."""
    small_texts(spark)
    return encoded(docs, MODEL).select("doc_id", "lang", "source", "n_tokens", "ids", "round_trip")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece", sentence_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` after all stages."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

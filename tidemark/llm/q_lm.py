"""Query 2: language-model scores of `documents`, learned from six sevenths of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.lm_scoring import LEFT_OUT, TRAIN, UNSEEN, score_texts
from tidemark.llm.registry import query, table


@query("op2_lm_scoring")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = F.crc32(F.col("doc_id").cast("string")) % 7
    fold = F.when(rest == 2, UNSEEN).when(rest == 3, LEFT_OUT).when(rest.isNotNull(), TRAIN)
    scored = score_texts(docs, fold)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(True))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

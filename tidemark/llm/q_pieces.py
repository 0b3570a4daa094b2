"""Query 4: SentencePiece ids of `documents`, decoded again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.registry import query, table
from tidemark.llm.sentence_pieces import encoded

MODEL = "piece_bpe_32k.model"


@query("op4_sentencepiece")
def sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, MODEL).select("doc_id", "n_tokens", "ids", "round_trip")

"""Query 6: token counts of `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.registry import query, table
from tidemark.llm.token_counts import count_tokens


@query("op6_token_counts")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, "word_bpe_49k.json").select("doc_id", "n_bytes", "n_tokens", "over_limit")

"""Query 7: language of `documents`, learned from two thirds of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.language_id import fit, identify
from tidemark.llm.registry import query, table


def held_out(key: str = "doc_id") -> Column:
    """One third of the documents, never learned from; a row without id is never learned from either."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(True))


@query("op7_language_id")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = fit(docs, ~held_out())
    judged = identify(docs.select("doc_id", "text"), net)
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

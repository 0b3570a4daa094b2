from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest
from edge import PLAIN, clashing, prose, rows
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    alphabets = {"en": "abcdefg", "de": "hijklmn"}
    data = [(100 + i, prose(rng, 80, alphabets[lang]) + "\nshared footer line", lang, "site", 1) for i in range(40) for lang in [list(alphabets)[i % 2]]]
    data += [(200 + i, data[0][1], "en", "other", 1) for i in range(3)]
    passage = prose(rng, 40, "abcdefg")
    data += [(300, prose(rng, 60, "abcdefg") + " " + passage, "en", "site", 1)]
    place = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(data + rows(), PLAIN).coalesce(2).write.parquet(str(place / "documents.parquet"))
    spark.createDataFrame([(0, passage), (1, None)], "item_id long, text string").write.parquet(str(place / "benchmark.parquet"))
    return str(place), data


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_texts_in_small_batches(spark, folder, name):
    """The batches hold when the caller writes the stage, after its function has returned."""
    place, _ = folder
    before = {key: spark.conf.get(key) for key in corpus_pipeline.TEXT_BATCHES}
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(f"{place}/documents.parquet").limit(5), place)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000
        assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 1024
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_stages_follow_a_plain_version(spark, folder):
    """Each stage against what its rule says for the planted rows, on what the stage before kept."""
    place, data = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece"]
    stage = dict(corpus_pipeline.STAGES)

    def keep(df, name):
        path = f"{place}/{name}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    told = keep(stage["language_id"](spark, docs, place), "s1")
    ids = {r.doc_id for r in told.collect()}
    assert told.columns == columns and {d[0] for d in data} <= ids and not ids & {3, 4, 5, 10}

    cleaned = keep(stage["line_dedup"](spark, told, place), "s2")
    texts = {r.doc_id: r for r in cleaned.collect()}
    assert cleaned.columns == columns and cleaned.count() == told.count()
    assert texts[101].text == data[1][1].split("\n")[0] and texts[101].n_chars == len(texts[101].text)

    single = keep(stage["ngram_jaccard_join"](spark, cleaned, place), "s3")
    left = [r.doc_id for r in single.collect()]
    assert single.columns == columns and len(left) == len(set(left))
    assert 100 in left and not {200, 201, 202, 2} & set(left) and 1 in left and None in left
    assert {101 + i for i in range(39)} <= set(left)

    clean = keep(stage["benchmark_decontamination"](spark, single, place), "s4")
    assert clean.columns == columns and {r.doc_id for r in single.collect()} - {r.doc_id for r in clean.collect()} == {300}

    coded = stage["sentencepiece"](spark, clean, place).collect()
    assert len(coded) == clean.count() and all(r.round_trip and r.n_tokens == len(r.ids) > 0 for r in coded)
    assert sorted(map(str, (r.doc_id for r in corpus_pipeline.run(spark, place).collect()))) == sorted(str(r.doc_id) for r in coded)


def test_stages_survive_empty_tables_and_clashing_columns(spark, folder):
    place, _ = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), place).count() == 0, name
    extra = clashing(docs.where("doc_id < 12 or doc_id is null"))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, extra, place)
        assert out.columns == extra.columns and out.count() > 0, name
    assert stage_columns(corpus_pipeline.STAGES[0][1](spark, extra, place)) <= set(extra.columns)


def stage_columns(df) -> set[str]:
    assert df.where(F.col("text").isNull()).count() == 0
    return set(df.columns)

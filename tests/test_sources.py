"""File sources: manifests, summaries with a default, run history, missing paths."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import summary
from tidemark.operators.asof import latest_per_key
from tidemark.plans import registry
from tidemark.sources import files, online, views


def test_manifest_skips_blank_lines(spark, tmp_path):
    path = str(tmp_path / "m")
    files.write_manifest(spark, ["a", "", "  ", "b"], path)
    assert sorted(r["feature"] for r in files.read_manifest(spark, path).collect()) == ["a", "b"]


def test_drift_summary_default_and_read(spark, tmp_path):
    none = files.read_drift_summary(spark, str(tmp_path / "nothing")).first()
    assert none["dataset_drift_detected"] is False and none["drift_share"] == 0.0
    found = spark.createDataFrame([(True, 0.6)], "dataset_drift_detected boolean, drift_share double")
    files.write_summary(found, str(tmp_path / "s"))
    assert files.read_drift_summary(spark, str(tmp_path / "s")).first()["drift_share"] == 0.6


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException) as e:
        files.read_parquet(spark, str(tmp_path / "gone"))
    assert e.value.getCondition() == "PATH_NOT_FOUND"


def test_run_history(spark, tmp_path):
    rows = "run_id string, run_name string, s long, kind string, key string, value string, step int"
    data = [
        ("r1", "perf-a", 10, "metric", "f1_score", "0.5", 1),
        ("r1", "perf-a", 10, "metric", "f1_score", "0.7", 2),
        ("r2", "drift-b", 30, "metric", "f1_score", "0.9", None),
        ("r3", "perf-c", 20, "param", "model_type", "XGBoost", None),
    ]
    df = spark.createDataFrame(data, rows).withColumn("start_time", F.timestamp_seconds("s"))
    for run in ("r1", "r2", "r3"):
        files.append_runs(df.where(F.col("run_id") == run), str(tmp_path / "runs"))
    runs = files.read_runs(spark, str(tmp_path / "runs"))
    assert {r["run_id"] for r in registry.latest_run(runs, "perf-%").collect()} == {"r3"}
    wide = {r["run_id"]: r for r in registry.runs_wide(runs, ["f1_score"], ["model_type"]).collect()}
    assert wide["r1"]["f1_score"] == 0.7 and wide["r3"]["model_type"] == "XGBoost"
    versions = spark.createDataFrame([(1, "None", "r3"), (2, "None", "lost")], "version int, stage string, run_id string")
    table = {r["version"]: r for r in registry.version_table(versions, runs).collect()}
    assert table[2]["model_type"] == "?" and table[2]["f1_score"] == 0.0


def test_unknown_feature_reference(spark):
    catalog = views.network_views("raw", "engineered")
    assert views.discover(spark, catalog).count() == 24
    with pytest.raises(KeyError):
        views.resolve(["network_raw_metrics:nope"], catalog)


def test_value_shares(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "x string")
    out = summary.value_shares(df, "x").collect()
    assert [(r["x"], r["count"], r["share"]) for r in out] == [("a", 2, 0.5), ("b", 1, 0.25), ("c", 1, 0.25)]


def test_online_table_in_intervals_equals_one_pass(spark, tmp_path):
    rng = random.Random(4)
    t = F.timestamp_seconds(F.col("s"))
    data = [(f"k{rng.randrange(60)}" if rng.random() < 0.95 else None, rng.randrange(1000), i, float(i)) for i in range(900)]
    rows = spark.createDataFrame(data, "k string, s int, tie int, v double").withColumn("t", t)
    late = rows.where("s > 700 and k in ('k1', 'k2', 'k3')").union(rows.where("s <= 700"))
    path, how = str(tmp_path / "online"), dict(key="k", ts="t", tie=["tie"], buckets=16)
    at = lambda s: F.timestamp_seconds(F.lit(s))

    def plain(df):
        return sorted(tuple(r) for r in latest_per_key(df, "k", "t", ["tie"]).select("k", "s", "tie", "v").collect())

    def table(version=None):
        return sorted(tuple(r) for r in online.online_table(spark, path, version).select("k", "s", "tie", "v").collect())

    first = online.materialize_interval(late, path, 1, after=None, upto=at(400), **how)
    assert table() == plain(late.where("s <= 400"))
    online.materialize_interval(late, path, 2, after=at(400), upto=at(700), **how)
    assert table() == plain(late.where("s <= 700")) and table(1) == plain(late.where("s <= 400"))
    third = online.materialize_interval(late, path, 3, after=at(700), upto=None, **how)
    assert table() == plain(late) and len(third) <= 3 < len(first)
    assert {int(p.name.split("=")[1]) for p in (tmp_path / "online" / "data").glob("bucket=*") if (p / "version=3").exists()} == set(third)
    assert online.materialize_interval(late, path, 3, after=at(700), upto=None, **how) == third and table() == plain(late)
    assert online.materialize_interval(late, path, 4, after=at(5000), upto=None, **how) == [] and table() == plain(late)

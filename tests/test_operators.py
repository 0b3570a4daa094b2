"""As-of joins, rules, splits, curves, drift and timelines on small tables with known answers."""

from __future__ import annotations

import datetime as dt
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import drift, ecdf, lineage, metrics, rules, splits, timeline
from tidemark.operators import asof
from tidemark.operators.asof import FeatureSource, asof_join, asof_join_all, latest_per_key, online_lookup
from tidemark.plans import monitoring, registry, scoring
from tidemark.sources.files import stored

T0 = dt.datetime(2026, 1, 5)
CASES = [
    ("Normal", 10.0, 0.02, 40.0, 500.0, 3.0),
    ("Spike", 800.0, 15.0, 98.0, 50.0, 100.0),
    ("Degraded", 120.0, 3.0, 88.0, 200.0, 25.0),
]
REQUEST = "name string, latency_ms double, packet_loss_pct double, cpu_utilization double, bandwidth_mbps double, error_rate double"


def test_asof_edges(spark):
    day = dt.timedelta(hours=24)
    features = spark.createDataFrame([("a", T0, 1, 1.0), ("a", T0, 2, 2.0), ("b", T0, 1, 9.0)], "k string, t timestamp, tie int, v double")
    entities = spark.createDataFrame(
        [(0, "a", T0), (1, "a", T0 + day), (2, "a", T0 + day + dt.timedelta(microseconds=1)), (3, "a", T0 - dt.timedelta(seconds=1)), (4, "x", T0)],
        "id int, k string, t timestamp",
    )
    for options in ({}, {"small_bytes": 0, "target_rows": 1}):
        out = asof_join(entities, features, key="k", entity_ts="t", feature_ts="t", columns=["v"], ttl="24 hours", tie=["tie"], prefix="f_", **options)
        assert {r["id"]: r["f_v"] for r in out.collect()} == {0: 2.0, 1: 2.0, 2: None, 3: None, 4: None}


def test_asof_hot_key_equals_brute_force(spark):
    rng = random.Random(3)
    facts = [("hot", T0 + dt.timedelta(seconds=rng.randrange(200_000)), i, float(i)) for i in range(400)]
    asks = [(i, "hot", T0 + dt.timedelta(seconds=rng.randrange(250_000))) for i in range(300)]
    features = spark.createDataFrame(facts, "k string, t timestamp, tie int, v double")
    entities = spark.createDataFrame(asks, "id int, k string, t timestamp")
    for ttl, limit in (("1 hours", dt.timedelta(hours=1)), (None, dt.timedelta(days=999))):
        out = asof_join(entities, features, key="k", entity_ts="t", feature_ts="t", columns=["v"], ttl=ttl, tie=["tie"], small_bytes=0, target_rows=40)
        got = {r["id"]: r["v"] for r in out.collect()}
        for i, _, at in asks:
            best = max(((t, tie, v) for _, t, tie, v in facts if t <= at), default=None)
            assert got[i] == (best[2] if best and best[0] >= at - limit else None)


def test_latest_and_unknown_keys(spark):
    rows = spark.createDataFrame([("a", T0, 1.0), ("a", T0 + dt.timedelta(minutes=1), 2.0), ("b", T0, 3.0)], "k string, t timestamp, v double")
    latest = latest_per_key(rows, "k", "t")
    asked = spark.createDataFrame([("a",), ("b",), ("zz",)], "k string")
    assert {r["k"]: r["v"] for r in online_lookup(asked, latest, "k", ["v"]).collect()} == {"a": 2.0, "b": 3.0, "zz": None}


def test_rule_sets(spark):
    df = spark.createDataFrame(CASES, REQUEST)
    found = {r["name"]: r for r in rules.rule_verdict(df).collect()}
    assert [(found[n]["num_rules_triggered"], found[n]["severity"], found[n]["confidence"]) for n in ("Normal", "Spike", "Degraded")] == [
        (0, "normal", 0.0),
        (8, "critical", 1.0),
        (4, "warning", 0.7),
    ]
    assert found["Degraded"]["triggered_rules"][1]["rule"] == "packet_loss_pct > 2.0"
    hits = {r["name"]: len(r["fallback_rules"]) for r in rules.fallback_verdict(df).collect()}
    assert hits == {"Normal": 0, "Spike": 4, "Degraded": 0}
    bare = rules.rule_verdict(df.select("name")).collect()
    assert all(r["num_rules_triggered"] == 0 for r in bare)


def test_validation_reasons(spark):
    df = spark.createDataFrame([("ok", 1.0, 0.0, 100.0, 0.0, 0.0), ("bad", -1.0, 101.0, None, 1.0, float("nan"))], REQUEST)
    out = {r["name"]: r for r in rules.validate(df).collect()}
    assert out["ok"]["valid"] and not out["bad"]["valid"]
    assert sorted(out["bad"]["errors"]) == ["cpu_utilization is required", "error_rate is required", "latency_ms must be >= 0", "packet_loss_pct must be <= 100"]


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    first = splits.assign_split(df, ["id"], 0.2, strata=["y"])
    counts = {(r["y"], r["split"]): r["count"] for r in first.groupBy("y", "split").count().collect()}
    assert counts == {(0, "test"): 180, (0, "train"): 720, (1, "test"): 20, (1, "train"): 80}
    again = splits.assign_split(df.repartition(7).orderBy(F.desc("id")), ["id"], 0.2, strata=["y"])
    assert first.exceptAll(again.select(first.columns)).count() == 0
    assert splits.sample_rows(df, ["id"], 77).count() == 77
    assert splits.sample_rows(df, ["id"], 5000).count() == 1000


def brute_auc(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("small", [1 << 70, 0])
def test_auc_with_ties(spark, small):
    rng = random.Random(4)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "s double, y int")
    out = metrics.ranking_scores(df, [], "s", "y", small_bytes=small).first()
    assert out["roc_auc"] == pytest.approx(brute_auc(rows))
    total, ap = sum(y for _, y in rows), 0.0
    for s in sorted({s for s, _ in rows}):
        above = [y for t, y in rows if t >= s]
        ap += sum(y for t, y in rows if t == s) / total * sum(above) / len(above)
    assert out["pr_auc"] == pytest.approx(ap)


def test_percentiles_binned_equal_builtin(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(i % 3, rng.gauss(0, 1)) for i in range(900)], "g int, v double")
    points = {"a": 0.0, "b": 0.5, "c": 0.95, "d": 1.0}
    plain = {r["g"]: r for r in ecdf.percentiles(df, ["g"], "v", points, small_bytes=1 << 70).collect()}
    binned = {r["g"]: r for r in ecdf.percentiles(df, ["g"], "v", points, small_bytes=0).collect()}
    for g, row in plain.items():
        assert [binned[g][p] for p in points] == pytest.approx([row[p] for p in points])


def test_running_totals_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("x", 1.0)], "g string, v double")
    for small in (1 << 70, 0):
        out = ecdf.running_totals(df, ["g"], "v", {"n": F.lit(1)}, small_bytes=small)
        assert sorted((r["g"] or "", r["v"], r["cum_n"], r["all_n"]) for r in out.collect()) == [("", 1.0, 1, 2), ("", 2.0, 2, 2), ("x", 1.0, 1, 1)]


def test_drift_verdicts(spark):
    base = spark.range(2000).select(
        F.col("id").alias("k"),
        *[(F.rand(i) * 40 + 20).alias(m) for i, m in enumerate(["latency_ms", "packet_loss_pct", "cpu_utilization", "bandwidth_mbps", "error_rate"])],
    ).persist()
    same = drift.drift_summary(drift.drift_details(base, drift.shifted_scenario(base, "none", ["k"]))).first()
    severe = drift.drift_summary(drift.drift_details(base, drift.shifted_scenario(base, "severe", ["k"]))).first()
    assert not same["dataset_drift_detected"] and same["num_drifted_features"] == 0
    assert severe["dataset_drift_detected"] and severe["drift_share"] == 1.0


@pytest.mark.parametrize("options", [{}, {"small_bytes": 0, "target_rows": 5}])
def test_episodes(spark, options):
    labels = ["none"] * 3 + ["spike"] * 20 + ["none"] + ["degradation"] * 2 + ["spike"] * 3
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(labels)], "k string, t int, label string")
    out = timeline.episodes(df, "k", ["t"], "label", **options).collect()
    assert sorted((r["start"], r["end"], r["length"], r["label"]) for r in out) == [(3, 22, 20, "spike"), (24, 25, 2, "degradation"), (26, 28, 3, "spike")]


def test_gap_report(spark):
    start, end = T0, T0 + dt.timedelta(minutes=10)
    keys = spark.createDataFrame([("a", start, end)], "k string, s timestamp, e timestamp")
    expected = timeline.spine(keys, "k", F.col("s"), F.col("e"))
    assert expected.count() == 10
    seen = spark.createDataFrame([("a", start), ("a", start), ("a", start + dt.timedelta(minutes=9))], "k string, timestamp timestamp")
    odd = seen.union(spark.createDataFrame([("a", end), ("a", start + dt.timedelta(seconds=30)), ("z", start)], seen.schema))
    report = timeline.gap_report(keys.union(spark.createDataFrame([("b", start, start)], keys.schema)), "k", F.col("s"), F.col("e"), odd)
    assert [tuple(r) for r in report.collect()] == [("a", 10, 8, 0.2)]
    assert timeline.gaps(expected, seen, "k").count() == 8


def test_registry_decisions(spark):
    table = spark.createDataFrame(
        [(1, "Archived", 0.5, "r1"), (10, "Archived", 0.4, "r2"), (9, "Production", 0.6, "r3"), (2, "None", 0.5, "r4")],
        "version int, stage string, f1_score double, run_id string",
    )
    assert registry.rollback_target(table).first()["version"] == 10
    candidate = registry.promotion_candidate(table).first()
    assert (candidate["version"], candidate["target_stage"]) == (1, "Staging")
    assert registry.rollback_target(table.where("stage = 'Production'")).count() == 0
    kept = registry.apply_rollback(table.where("stage = 'Production'"), registry.rollback_target(table.where("version = 9")))
    assert kept.first()["stage"] == "Production"
    zero = table.withColumn("f1_score", F.when(F.col("version") == 9, 0.0).otherwise(F.col("f1_score")))
    assert registry.improvement(zero).first()["improvement_pct"] == float("inf")


def test_decision_texts(spark):
    quiet = spark.createDataFrame([(False, 0.0)], "dataset_drift_detected boolean, drift_share double")
    perf = spark.createDataFrame([(1, 120.0, 0.6, 0.05), (2, 100.0, 0.5, None)], "id int, latency_p99_ms double, anomaly_rate double, error_rate double")
    out = {r["id"]: r for r in monitoring.decide(quiet, perf).collect()}
    assert out[1]["reasons"] == "P99 latency 120.0ms > 100ms; Anomaly rate 60.0% > 50.0%" and out[1]["action"] == "rollback"
    assert not out[2]["should_rollback"] and out[2]["action"] == "none"
    forced = monitoring.decide(quiet, perf, force=True, dry_run=True).where("id = 2").first()
    assert forced["reasons"] == "Forced by --force flag" and forced["action"] == "dry-run"


def test_scoring_falls_back_per_row(spark):
    df = spark.createDataFrame(CASES, REQUEST)
    out = scoring.score_records(df, ["name"], primary=None, challenger=None).collect()
    assert {r["name"]: (r["prediction"], r["method"]) for r in out}["Spike"] == (1, "rule-based-fallback")
    model = scoring.column_model(F.when(F.col("name") != "Normal", F.lit(1)))
    mixed = {r["name"]: r for r in scoring.score_records(df, ["name"], primary=model, challenger=model).collect()}
    assert mixed["Normal"]["model_used"] == "fallback" and mixed["Degraded"]["confidence"] == 0.9
    bare = scoring.score_records(df, ["name"], primary=None, challenger=None, fallback=False).collect()
    assert all(r["prediction"] is None for r in bare)


def test_routing_is_free_of_the_split(spark):
    df = spark.range(4000)
    test = splits.assign_split(df, ["id"], 0.2).where("split = 'test'")
    share = rules.route(test, ["id"], 0.8).where("model_used = 'challenger'").count() / 800
    assert 0.12 < share < 0.28
    assert rules.route(df, ["id"], has_challenger=False).where("model_used <> 'primary'").count() == 0


def test_fingerprint_ignores_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "i int, s string")
    a = lineage.fingerprint(df, ["i", "s"]).first()
    b = lineage.fingerprint(df.orderBy(F.desc("i")).repartition(3), ["i", "s"]).first()
    c = lineage.fingerprint(df.fillna("", ["s"]), ["i", "s"]).first()
    assert a["content_hash"] == b["content_hash"] != c["content_hash"]


def test_asof_missing_keys_and_times_match_nothing(spark):
    entities = spark.createDataFrame(
        [(1, "a", 10), (2, None, 10), (3, "a", None), (4, "b", 5)], "row int, node_id string, at int"
    ).withColumn("at", F.timestamp_seconds("at"))
    features = spark.createDataFrame(
        [("a", 9, 1.0), (None, 9, 2.0), ("a", None, 3.0), ("b", 6, 4.0), ("a", 99, 5.0)], "node_id string, ts int, v double"
    ).withColumn("ts", F.timestamp_seconds("ts"))
    for ttl in (None, "1 hour"):
        out = asof_join(entities, features, key="node_id", entity_ts="at", feature_ts="ts", columns=["v"], ttl=ttl)
        assert {r.row: r.v for r in out.collect()} == {1: 1.0, 2: None, 3: None, 4: None}
    assert asof_join(entities.limit(0), features, key="node_id", entity_ts="at", feature_ts="ts", columns=["v"]).count() == 0


def test_asof_reads_only_features_in_reach(spark, tmp_path):
    features = spark.range(1000).select(
        F.concat(F.lit("n"), (F.col("id") % 50).cast("string")).alias("node_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"),
        F.col("id").cast("double").alias("v"),
    )
    features.write.parquet(str(tmp_path / "f"))
    entities = spark.createDataFrame([("n3", 30000), ("n4", 33000)], "node_id string, at int").withColumn("at", F.timestamp_seconds("at"))
    out = asof_join(
        entities, spark.read.parquet(str(tmp_path / "f")), key="node_id", entity_ts="at", feature_ts="ts", columns=["v"], ttl="24 hours"
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = out._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(ts," in plan and "GreaterThanOrEqual(ts," in plan
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert {r.node_id: r.v for r in out.collect()} == {"n3": 453.0, "n4": 504.0}


def test_row_digest_does_not_collide(spark):
    rows = [("x|y", "z"), ("x", "y|z"), (None, "z"), ("\\N", "z"), ("", "z"), ("-", "z"), ("1:x", "z")]
    df = spark.createDataFrame(rows, "a string, b string").select(lineage.row_digest(["a", "b"]).alias("d"))
    assert len({r.d for r in df.collect()}) == len(rows)


def test_version_diff_counts_copies(spark):
    old = spark.createDataFrame([("g", 1), ("g", 1), ("g", 2), ("h", 5), (None, 1)], "g string, v int")
    new = spark.createDataFrame([("g", 1), ("g", 3), ("g", 3), ("h", 5), (None, 2)], "g string, v int")
    assert {r.g: (r.added, r.removed) for r in lineage.version_diff(old, new, ["g"]).collect()} == {"g": (2, 2), None: (1, 1)}


def test_spine_is_anchored_at_its_start(spark):
    keys = spark.createDataFrame([("a", "2024-01-01 00:07:30", "2024-01-01 00:10:30")], "k string, s string, e string")
    out = timeline.spine(keys, "k", F.col("s").cast("timestamp"), F.col("e").cast("timestamp"))
    assert [str(r.timestamp)[11:] for r in out.orderBy("timestamp").collect()] == ["00:07:30", "00:08:30", "00:09:30"]


def test_nan_is_missing_in_rules(spark):
    df = spark.createDataFrame([(float("nan"), 0.0, 0.0, 100.0, 0.0)], ", ".join(f"{m} double" for m in schema.METRICS))
    row = rules.fallback_verdict(rules.rule_verdict(df)).first()
    assert (row.is_anomaly, row.num_rules_triggered, row.fallback_anomaly) == (0, 0, 0)


def test_missing_predictions_stay_in_the_total(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (None, 0)], "p int, y int")
    row = metrics.classification_scores(df, [], "p", "y").first()
    assert (row.tp, row.fn, row.tn, row.total) == (1, 1, 1, 3)


def test_monitor_keeps_null_groups_at_every_size(spark):
    log = spark.createDataFrame(
        [(1, 10.0, 0, 0), (1, 30.0, 1, 0), (2, None, 0, 1), (None, 5.0, 1, 1)], "g int, ms double, flag int, failed int"
    )
    want = {1: (20.0, 2, 0.5), 2: (None, 1, 0.0), None: (5.0, 1, 1.0)}
    for small in (0, 1 << 70):
        out = monitoring.log_monitor(log, ["g"], "ms", "flag", "failed", small_bytes=small)
        assert {r.g: (r.p50_ms, r.total_requests, r.anomaly_rate) for r in out.collect()} == want


def test_binned_percentiles_keep_long_and_time_order(spark):
    big = 1 << 53
    rows = [(k, big + k, T0 + dt.timedelta(seconds=k)) for k in range(40)]
    df = spark.createDataFrame(rows, "k long, v long, t timestamp")
    for value in ("v", "t"):
        out = ecdf.running_totals(df, [], value, {"n": F.lit(1)}, small_bytes=0, bins=4).orderBy("cum_n").collect()
        assert [r.cum_n for r in out] == list(range(1, 41))
        assert len({r[value] for r in out}) == 40


def test_tags_have_no_trailing_zeros(spark):
    table = spark.createDataFrame([(1, "?", 0.85, 1.0)], "version int, model_type string, f1_score double, roc_auc double")
    out = registry.version_tags(table, F.lit("2026-01-01").cast("date"), F.lit("v"), author="a", project="p", anomaly_types="spike")
    tags = {r.tag: r.value for r in out.collect()}
    assert (tags["f1_score"], tags["roc_auc"], tags["model_type"]) == ("0.85", "1.0", "unknown")


def test_scoring_keeps_every_row_of_a_fitted_model(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rows = [(i, float(i % 10), float("nan") if i % 7 == 0 else None if i % 11 == 0 else 1.0, int(i % 10 > 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    df = df.withColumns({m: F.lit(0.0) for m in schema.METRICS})
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="skip"), LogisticRegression(labelCol="y", maxIter=3)]
    fitted = Pipeline(stages=stages).fit(df)
    for fill in (True, False):
        model = scoring.fitted_model(fitted, ["a", "b"], ["id"], fill=fill)
        out = scoring.score_records(df, ["id"], primary=model, challenger=None, uris={"primary": "models:/1"}).collect()
        assert sorted(r.id for r in out) == list(range(200))
        fell = {r.id for r in out if r.method == "rule-based-fallback"}
        assert fell == (set() if fill else {i for i in range(200) if i % 7 == 0 or i % 11 == 0})
        assert all(r.model_uri == ("rule-based" if r.id in fell else "models:/1") for r in out)


def test_column_models_score_in_one_pass(spark, tmp_path):
    spark.range(50).withColumns({m: F.lit(0.0) for m in schema.METRICS}).write.parquet(str(tmp_path / "r"))
    model = scoring.column_model(F.col("id") > 10)
    out = scoring.score_records(spark.read.parquet(str(tmp_path / "r")), ["id"], primary=model, challenger=model)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and out.count() == 50


def test_views_share_one_time_line(spark):
    """The shuffles of an as-of join do not grow with the number of its sources."""
    rng = random.Random(2)
    facts = [(rng.choice("abc"), T0 + dt.timedelta(seconds=rng.randrange(9000)), rng.randrange(3), float(i)) for i in range(300)]
    asks = [(i, rng.choice("abcd"), T0 + dt.timedelta(seconds=rng.randrange(9000))) for i in range(80)]
    features = spark.createDataFrame(facts, "k string, t timestamp, tie int, v double")
    entities = spark.createDataFrame(asks, "row int, k string, t timestamp")
    odd = features.where("v % 2 = 1").withColumnRenamed("v", "w")
    sources = [
        FeatureSource(features, "t", ["v"], "10 minutes", ["tie", "v"], "a_"), FeatureSource(odd, "t", ["w"], None, ["tie", "w"], "b_"),
        FeatureSource(features.where("k = 'a'"), "t", ["v", "tie"], "1 hour", ["tie", "v"], "c_"),
    ]

    def plan_of(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for options in ({}, {"small_bytes": 0, "target_rows": 15}):
        whole = asof_join_all(entities, sources, key="k", entity_ts="t", **options)
        alone = [asof_join_all(entities, [s], key="k", entity_ts="t", **options) for s in sources]
        got = {r.row: r for r in whole.collect()}
        assert len(got) == 80
        for s, one in zip(sources, alone):
            for r in one.collect():
                assert all(r[c] == got[r.row][c] for c in one.columns[3:]), s.prefix
        if not options:
            assert len({plan_of(d).count("Exchange hashpartitioning") for d in (whole, *alone)}) == 1


def test_many_keys_are_narrowed_by_hash_slot(spark, monkeypatch):
    monkeypatch.setattr(asof, "SMALL_SIDE_ROWS", 5)
    features = spark.range(3000).select((F.col("id") % 300).alias("k"), F.timestamp_seconds("id").alias("t"), F.col("id").alias("v"))
    entities = spark.createDataFrame([(k, 4000) for k in range(0, 300, 10)], "k long, s int").select("k", F.timestamp_seconds("s").alias("at"))
    reach = asof.reach_of(entities, "k", "at")
    assert reach.by_slot and reach.narrow(features, "k", "t").select("k").distinct().count() == 30
    out = asof_join(entities, features, key="k", entity_ts="at", feature_ts="t", columns=["v"])
    assert {r.k: r.v for r in out.collect()} == {k: 2700 + k for k in range(0, 300, 10)}
    monkeypatch.setattr(asof, "KEY_SLOTS", 8)  # the asked keys take most slots: no filter
    assert asof.reach_of(entities, "k", "at").keys is None


def test_value_bins_need_no_single_reducer(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 1000 / 7).alias("v"))
    plain = ecdf.running_totals(df, ["g"], "v", {"n": F.lit(1)}, descending=True, small_bytes=1 << 70)
    binned = ecdf.running_totals(df, ["g"], "v", {"n": F.lit(1)}, descending=True, small_bytes=0, bins=9)
    assert sorted(map(tuple, plain.select(sorted(plain.columns)).collect())) == sorted(map(tuple, binned.select(sorted(plain.columns)).collect()))
    plan = binned._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "percentile" not in plan
    widths = binned.groupBy("g").count().collect()
    assert {r["count"] for r in widths} == {1000}


def test_known_files_are_not_read_again(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60).select((F.col("id") % 3).alias("p"), "id", F.col("id").cast("string").alias("v"))
    rows.where("p < 2").repartition("p").write.partitionBy("p").parquet(path)
    first = stored(lineage.file_fingerprints(spark, path, ["id", "v"]), "prints")
    assert first.agg(F.sum("rows")).first()[0] == 40 and first.where("bytes > 0").count() == first.count()
    kept = next(f for f in (tmp_path / "t" / "p=0").glob("*.parquet") if f.stat().st_size > 0 and first.where(F.col("file").endswith(f.name)).first().rows)
    stat = kept.stat()
    kept.write_bytes(b"x" * stat.st_size)  # unreadable, but of the known size and time
    os.utime(kept, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    for gone in (tmp_path / "t" / "p=1").glob("*.parquet"):
        gone.unlink()
    rows.where("p = 2").coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    second = stored(lineage.file_fingerprints(spark, path, ["id", "v"], first), "prints")
    got = lineage.combined_fingerprint(second).first()
    want = lineage.fingerprint(rows.where("p <> 1"), ["id", "v"]).first()
    assert (got.rows, got.content_hash) == (40, want.content_hash)
    assert lineage.file_fingerprints(spark, path, ["id", "v"], second).count() == second.count()


@pytest.mark.parametrize("small", [1 << 70, 0])
def test_drift_reads_the_samples_once(spark, small):
    n = F.col("id") % 7
    side = F.when(F.col("id") % 3 == 0, "ref").otherwise("cur")
    ids = spark.range(300).select(side.alias("side"), (n * n * 0.5).alias("a"), F.lit(3.25).alias("k"))
    samples = ids.unpivot(["side"], ["a", "k"], "column", "value")
    out = drift.column_drift(samples, ["a", "k", "gone"], small)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in plan  # every later step reads the stored counts
    got = {r["column"]: r for r in out.collect()}
    ref = [(i % 7) ** 2 * 0.5 for i in range(300) if i % 3 == 0]
    cur = [(i % 7) ** 2 * 0.5 for i in range(300) if i % 3]
    assert got["a"].ref_mean == pytest.approx(sum(ref) / len(ref)) and got["a"].curr_mean == pytest.approx(sum(cur) / len(cur))
    apart = abs(sum(cur) / len(cur) - sum(ref) / len(ref)) / (statistics.stdev(ref) + 1e-10)
    assert got["a"].mean_shift_std == pytest.approx(apart) and (got["a"].ref_size, got["a"].cur_size) == (100, 200)
    assert got["k"].mean_shift_std == 0.0 and got["k"].wasserstein_norm == 0.0 and got["gone"].missing

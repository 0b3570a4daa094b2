"""Edge rows of the feature table, and the split plan against the plain one."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import series
from tidemark.operators.features import compute_features, output_columns
from tidemark.operators.series import slots_and_halo, split_hot_series, with_halo

COLUMNS = "timestamp timestamp, node_id string, " + ", ".join(f"{m} double" for m in schema.METRICS)


def make(spark, rows):
    """rows: (node, minute, latency, loss, cpu, bandwidth, errors)."""
    data = [(node, minute, *values) for node, minute, *values in rows]
    df = spark.createDataFrame(data, "node_id string, m int, " + ", ".join(f"{x} double" for x in schema.METRICS))
    return df.selectExpr("timestamp_seconds(1767571200 + m * 60) AS timestamp", "node_id", *schema.METRICS)


def by_minute(df):
    return {(r["node_id"], int(r["timestamp"].timestamp() - 1767571200) // 60): r for r in df.collect()}


def test_counts_of_features(spark):
    df = make(spark, [("a", 0, 1.0, 2.0, 3.0, 4.0, 5.0)])
    out = compute_features(df)
    assert len(schema.feature_columns(out.columns)) == 78
    names = output_columns(schema.METRICS)
    assert sum("roll_" in n for n in names) == 45
    assert sum("delta_" in n for n in names) == 15
    assert sum("zscore" in n for n in names) == 5


def test_first_row_and_constant_series(spark):
    rows = [("a", i, 7.1, 0.3, 0.0, 0.0, 5.0) for i in range(70)]
    out = by_minute(compute_features(make(spark, rows)))
    first = out["a", 0]
    assert first["latency_ms_delta_1m"] == 0 and first["latency_ms_roll_std_5min"] == 0
    assert first["cpu_bw_ratio"] == 0 and first["error_per_cpu"] == 0
    last = out["a", 69]
    assert last["latency_ms_roll_std_1hr"] == 0 and last["latency_ms_zscore"] == 0
    assert last["latency_cpu_corr_30m"] == 0
    assert last["latency_ms_roll_mean_1hr"] == pytest.approx(7.1)


def test_rolling_values_by_hand(spark):
    rng = random.Random(1)
    values = [round(rng.uniform(1, 100), 2) for _ in range(130)]
    others = [round(rng.uniform(1, 100), 2) for _ in range(130)]
    rows = [("a", i, v, 1.0, o, 10.0, 1.0) for i, (v, o) in enumerate(zip(values, others))]
    out = by_minute(compute_features(make(spark, rows)))
    for i in (0, 4, 8, 9, 16, 59, 60, 61, 129):
        row = out["a", i]
        for label, n in schema.ROLLING_ROWS.items():
            frame = values[max(0, i - n + 1) : i + 1]
            assert row[f"latency_ms_roll_mean_{label}"] == pytest.approx(statistics.fmean(frame))
            assert row[f"latency_ms_roll_max_{label}"] == max(frame)
            assert row[f"latency_ms_roll_std_{label}"] == pytest.approx(statistics.stdev(frame) if len(frame) > 1 else 0)
        frame = values[max(0, i - 59) : i + 1]
        z = (values[i] - statistics.fmean(frame)) / statistics.stdev(frame) if len(frame) >= 10 else 0
        assert row["latency_ms_zscore"] == pytest.approx(z)
        pair = list(zip(values, others))[max(0, i - 29) : i + 1]
        r = statistics.correlation(*zip(*pair)) if len(pair) >= 10 else 0
        assert row["latency_cpu_corr_30m"] == pytest.approx(r)
        assert row["latency_ms_delta_5m"] == pytest.approx(values[i] - values[i - 5] if i >= 5 else 0)


def test_missing_values_are_skipped(spark):
    rows = [("a", i, None if i == 3 else math.nan if i == 4 else float(i), 1.0, 2.0, 5.0, 1.0) for i in range(8)]
    out = by_minute(compute_features(make(spark, rows)))
    assert out["a", 5]["latency_ms_roll_mean_5min"] == pytest.approx((1 + 2 + 5) / 3)
    assert out["a", 5]["latency_ms_delta_1m"] == 0
    assert out["a", 3]["latency_ms"] is None and out["a", 3]["latency_x_loss"] is None


def test_calendar_edges(spark):
    # 1767571200 is Monday 2026-01-05 00:00 UTC.
    rows = [("a", h * 60, 1.0, 1.0, 1.0, 1.0, 1.0) for h in (7, 8, 18, 19, 5 * 24)]
    out = by_minute(compute_features(make(spark, rows)))
    assert [out["a", h * 60]["is_business_hours"] for h in (7, 8, 18, 19)] == [0, 1, 1, 0]
    assert out["a", 8 * 60]["day_of_week"] == 0 and out["a", 8 * 60]["is_weekend"] == 0
    assert out["a", 5 * 24 * 60]["day_of_week"] == 5 and out["a", 5 * 24 * 60]["is_weekend"] == 1


def test_hot_series_split_gives_the_same_rows(spark):
    rng = random.Random(2)
    rows = [("hot", i, rng.random() * 50, rng.random(), rng.random() * 90, rng.random() * 100, 1.0) for i in range(900)]
    rows += [(f"n{k}", i, rng.random(), 0.5, 1.0, 2.0, rng.random()) for k in range(5) for i in range(30)]
    df = make(spark, rows)
    plain = by_minute(compute_features(df))
    split = by_minute(compute_features(df, target_rows=100, small_bytes=0))
    assert plain.keys() == split.keys() and len(split) == len(rows)
    for key, row in plain.items():
        for name, value in row.asDict().items():
            assert split[key][name] == (pytest.approx(value) if isinstance(value, float) else value), (key, name)


def test_halo_covers_the_lookback():
    rng = random.Random(5)
    for _ in range(300):
        counts = [rng.choice([0, 1, 3, 20, 70]) for _ in range(rng.randint(1, 40))]
        least, lookback = rng.randint(1, 120), rng.randint(0, 90)
        slots, copied = slots_and_halo(counts, least, lookback)
        assert slots[0] == 0 and all(b - a in (0, 1) for a, b in zip(slots, slots[1:]))
        for slot in range(slots[-1]):
            inside = [k for k in range(len(counts)) if slots[k] == slot]
            halo = [k for k in inside if copied[k]]
            assert sum(counts[k] for k in inside) >= max(least, lookback)
            assert sum(counts[k] for k in halo) >= lookback and halo == inside[len(inside) - len(halo) :]
            assert not halo or sum(counts[k] for k in halo[1:]) < lookback
        assert not any(c for k, c in enumerate(copied) if slots[k] == slots[-1])


def test_hot_null_series_is_split_in_one_shuffle(spark):
    rng = random.Random(8)
    rows = [(None if i % 3 else "b", i, *(rng.random() * 50 for _ in range(5))) for i in range(1200)]
    df = spark.createDataFrame(rows, "node_id string, second int, " + ", ".join(f"{m} double" for m in schema.METRICS))
    df = df.withColumn("timestamp", F.timestamp_seconds("second")).repartition(4)
    split = compute_features(df, order=["timestamp", "second"], target_rows=100, small_bytes=0)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(node_id") == 1 and plan.count("BroadcastExchange") == 1
    widths = with_halo(df, "node_id", ["timestamp", "second"], 59, 100, 0).groupBy("node_id", "_slot").count()
    assert widths.agg(F.max("count")).first()[0] < 400 and widths.where("node_id is null").count() > 4
    plain = compute_features(df, order=["timestamp", "second"], small_bytes=1 << 70)
    key = lambda r: r["second"]
    for a, b in zip(sorted(split.collect(), key=key), sorted(plain.collect(), key=key), strict=True):
        assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(a, b) if isinstance(x, float)) and a["second"] == b["second"]


def test_many_cuts_meet_their_rows_in_a_shuffle(spark, monkeypatch):
    rng = random.Random(9)
    keys = [None, "a", "b", "c"]
    rows = [(keys[min(i % 7, 3)], i // 3, i, *(rng.random() * 50 for _ in range(5))) for i in range(1400)]
    df = spark.createDataFrame(rows, "node_id string, second int, n int, " + ", ".join(f"{m} double" for m in schema.METRICS))
    df = df.withColumn("timestamp", F.timestamp_seconds("second")).repartition(4)
    order = ["timestamp", "n"]
    few = with_halo(df, "node_id", order, 59, 40, 0)
    few_slots = split_hot_series(df, "node_id", order, 40, 0)
    monkeypatch.setattr(series, "BROADCAST_POINTS", 10)
    monkeypatch.setattr(series, "TARGET_ROWS", 300)  # a series is dealt over several tasks
    many = with_halo(df, "node_id", order, 59, 40, 0)
    many_slots = split_hot_series(df, "node_id", order, 40, 0)
    for a, b in ((few, many), (few_slots.df, many_slots.df)):
        assert "Broadcast" not in b._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert few_slots.slots == many_slots.slots > 20

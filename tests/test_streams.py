"""Streams over several files equal their batch twins."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.streaming import jobs


def test_keyed_state_goes_on_across_batches(spark, tmp_path):
    rows = spark.range(600).select(
        F.concat(F.lit("n"), (F.col("id") % 3).cast("string")).alias("node_id"),
        F.col("id").alias("seq"),
        *[F.when(F.col("id") % 17 != i, F.round(F.rand(i) * 100, 3)).alias(m) for i, m in enumerate(schema.METRICS)],
    ).persist()
    for part in range(4):
        rows.where((F.col("seq") >= part * 150) & (F.col("seq") < part * 150 + 150)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), rows.schema, files_per_trigger=1)
    jobs.finish(jobs.to_files(jobs.keyed_features(stream, "node_id", ["seq"]), str(tmp_path / "out"), str(tmp_path / "ck")))
    got = {r["seq"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["seq"]: r for r in jobs.batch_features(rows, "node_id", ["seq"]).collect()}
    assert got.keys() == want.keys()
    for seq, row in want.items():
        for c in jobs.stream_columns(schema.METRICS):
            if row[c] is None:
                assert got[seq][c] is None or got[seq][c] != got[seq][c], (seq, c)
            elif c.endswith("zscore") and row[c.replace("_zscore", "")] is None:
                continue
            else:
                assert got[seq][c] == pytest.approx(row[c], abs=1e-9), (seq, c)


@pytest.mark.parametrize("window", [1, 2, 5, 60])
def test_window_stats_of_all_metrics_come_from_few_frames(monkeypatch, window):
    rng = np.random.default_rng(window)
    joins, inner = [], jobs._joined
    monkeypatch.setattr(jobs, "_joined", lambda *a: joins.append(1) or inner(*a))
    for known in (0, 1, window - 1):
        line = np.round(rng.normal(1000, 3, (known + 150, 3)), 1)
        line[rng.random(line.shape) < 0.2] = np.nan
        line[:, 2] = 7.3
        joins.clear()
        got = jobs._window_stats(line[: min(known, window - 1)], line[min(known, window - 1) :], window)
        assert len(joins) <= 2 * window.bit_length()
        for m in range(3):
            for row in range(len(line) - min(known, window - 1)):
                at = row + min(known, window - 1)
                frame = line[max(0, at - window + 1) : at + 1, m]
                frame = frame[~np.isnan(frame)]
                want = [frame.mean(), frame.std() if np.ptp(frame) else 0.0, frame.max()] if len(frame) else [np.nan, 0.0, np.nan]
                assert [got[s][row, m] for s in ("roll_mean", "roll_std", "roll_max")] == pytest.approx(want, abs=1e-9, nan_ok=True)


def test_hourly_view_in_append_mode_leaves_open_windows(spark, tmp_path):
    rows = spark.range(300).select(F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.col("id").cast("double").alias("v"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), rows.schema)
    jobs.finish(jobs.to_files(jobs.hourly_view(stream, "k", "ts", ["v"], "10 minutes"), str(tmp_path / "out"), str(tmp_path / "ck")))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 4 and got.agg(F.sum("records")).first()[0] == 240
    assert jobs.hourly_view(rows, "k", "ts", ["v"]).count() == 5

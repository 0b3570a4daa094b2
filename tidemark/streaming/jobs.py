"""Structured Streaming jobs over telemetry.

Sources are file streams with a bounded number of files per trigger; sinks and checkpoints are
folders the caller names, which on a cluster lie in shared storage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark import schema
from tidemark.functions.expr import ratio_or_zero
from tidemark.operators.rolling import Rolling
from tidemark.operators.series import TARGET_ROWS, over_series

WINDOW_ROWS = 60
ALERT_LIMIT = 3.0
STREAM_STATS = ("roll_mean", "roll_std", "roll_max", "zscore", "delta")


def file_stream(spark: SparkSession, path: str, types: T.StructType, fmt: str = "parquet", files_per_trigger: int = 16) -> DataFrame:
    """Stream of the files of a folder or pattern, a bounded number per micro-batch."""
    return spark.readStream.schema(types).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


def stream_columns(metrics: list[str]) -> list[str]:
    return [f"{m}_{s}" for m in metrics for s in STREAM_STATS]


def _joined(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], length: int) -> tuple[np.ndarray, ...]:
    """Counts, sums, squared gaps, minima and maxima of frames: those of `a`, then `length` rows of `b`."""
    count, total, gaps, low, high = (x[: len(x) - length] for x in a)
    count2, total2, gaps2, low2, high2 = (x[len(x) - len(count) :] for x in b)
    n = count + count2
    apart = total2 * count - total * count2  # the means' difference times both counts
    weight = np.divide(1.0, count * count2 * n, out=np.zeros_like(n), where=(count > 0) & (count2 > 0))
    return n, total + total2, gaps + gaps2 + apart * apart * weight, np.minimum(low, low2), np.maximum(high, high2)


def _window_stats(tail: np.ndarray, fresh: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Statistics of the last `window` values at each fresh value, a column per metric; NaN marks missing values.

    A frame is put together from frames of a power of two of rows, each made of two of half its length.
    """
    lead = np.full((max(0, window - 1 - len(tail)), fresh.shape[1]), np.nan)
    line = np.concatenate([lead, tail[len(tail) - min(len(tail), window - 1) :], fresh])
    known = ~np.isnan(line)
    power = known.astype(float), np.where(known, line, 0.0), np.zeros_like(line), np.where(known, line, np.inf), np.where(known, line, -np.inf)
    frame, length, left = None, 1, window
    while left:
        if left & 1:
            frame = power if frame is None else _joined(power, frame, window & (length - 1))
        left >>= 1
        if left:
            power = _joined(power, power, length)
            length *= 2
    n, total, gaps, low, high = frame
    some = n > 0
    mean = np.divide(total, n, out=np.full_like(n, np.nan), where=some)
    spread = np.sqrt(np.divide(gaps, n, out=np.zeros_like(n), where=some))
    std = np.where(some & (high > low), spread, 0.0)
    out = {"roll_mean": mean, "roll_std": std, "roll_max": np.where(some, high, np.nan)}
    out["zscore"] = np.where(std > 0, np.divide(fresh - mean, std, out=np.zeros_like(n), where=std > 0), 0.0)
    step = fresh - line[window - 2 : len(line) - 1] if window > 1 else np.zeros_like(fresh)
    out["delta"] = np.where(np.isnan(step), 0.0, step)
    return out


def keyed_features(
    stream: DataFrame, key: str, order: list[str], metrics: list[str] | None = None, window: int = WINDOW_ROWS, idle: str | None = None
) -> DataFrame:
    """Per-key features over the last `window` records in arrival order, across micro-batches.

    State per key is the last `window` - 1 values of each metric. A key unknown so far starts with
    an empty buffer. Inside a micro-batch, records of a key are taken in `order`. With `idle`, for
    streams that run on, the buffer of a key without records for that long (processing time) is
    dropped. Spark then plans a batch whenever none is running, so a stream that is to end with the
    files present now needs None, which keeps all buffers.
    """
    metrics = metrics or schema.METRICS
    stats = stream_columns(metrics)
    output = T.StructType(list(stream.schema.fields) + [T.StructField(c, T.DoubleType()) for c in stats])
    state_type = T.StructType([T.StructField(m, T.ArrayType(T.DoubleType())) for m in metrics])
    names = stream.columns
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000) if idle else None

    def update(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches), ignore_index=True).sort_values(order, kind="stable", ignore_index=True)
        tails = state.get if state.exists else tuple([] for _ in metrics)
        old = np.array([[np.nan if v is None else v for v in tail] for tail in tails], dtype=float).reshape(len(metrics), -1).T
        fresh = np.stack([rows[metric].to_numpy(dtype=float) for metric in metrics], axis=1)
        found = _window_stats(old, fresh, window)
        both = np.concatenate([old, fresh])
        last = both[max(0, len(both) - (window - 1)) :].T
        kept = [[None if np.isnan(v) else float(v) for v in values] for values in last]
        state.update(tuple(kept))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        # One block of numbers a key: columns put in one by one would be copied one by one.
        shown = np.stack([found[stat] for stat in STREAM_STATS], axis=2).reshape(len(rows), -1)
        yield pd.concat([rows[names], pd.DataFrame(shown, columns=stats)], axis=1)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout
    return stream.groupBy(key).applyInPandasWithState(update, output, state_type, "append", timeout)


def batch_features(
    df: DataFrame, key: str, order: list[str], metrics: list[str] | None = None, target_rows: int = TARGET_ROWS, small_bytes: int | None = None
) -> DataFrame:
    """The stream's features over a finished table: population deviation, from the second row on."""
    metrics = metrics or schema.METRICS
    short, middle, long = schema.ROLLING_ROWS.values()

    def build(frame: DataFrame, partition: list[str]) -> DataFrame:
        keep = frame.columns
        roll = Rolling(partition, order, {m: m for m in metrics})
        frame = frame.selectExpr("*", *roll.lags(metrics, [1]))
        frame = frame.selectExpr(*keep, *[f"coalesce({m} - _ago1.{m}, 0D) AS {m}_delta" for m in metrics])
        frame = roll.extend(roll.extend(roll.base(frame, short), short, [middle]), middle, [long])
        frame = frame.selectExpr("*", *[f"{roll.std(m, long, population=True)} AS {m}_roll_std" for m in metrics])
        columns = []
        for m in metrics:
            columns += [
                f"{roll.stat(m, 'mean', long)} AS {m}_roll_mean",
                f"{m}_roll_std",
                f"{roll.stat(m, 'max', long)} AS {m}_roll_max",
                f"{roll.zscore(m, f'{m}_roll_std', long, 1)} AS {m}_zscore",
                f"{m}_delta",
            ]
        return frame.selectExpr(*keep, *columns)

    return over_series(df, key, order, WINDOW_ROWS - 1, build, target_rows, small_bytes)


def with_cross(df: DataFrame) -> DataFrame:
    """Products and ratios of the record itself."""
    return df.withColumns(
        {
            "latency_x_loss": F.col("latency_ms") * F.col("packet_loss_pct"),
            "cpu_bw_ratio": ratio_or_zero("cpu_utilization", "bandwidth_mbps"),
        }
    )


def alert(metrics: list[str] | None = None, limit: float = ALERT_LIMIT) -> Column:
    """True where the largest absolute z-score of a record is above the limit."""
    scores = [F.coalesce(F.abs(F.col(f"{m}_zscore")), F.lit(0.0)) for m in metrics or schema.METRICS]
    return (F.greatest(*scores) if len(scores) > 1 else scores[0]) > limit


def counters(df: DataFrame, key: str) -> DataFrame:
    """Records and alerts so far, per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("processed"), F.count_if(F.col("alert")).alias("alerts"))


def hourly_view(df: DataFrame, key: str, ts: str, metrics: list[str], late: str = "2 hours") -> DataFrame:
    """Hourly count, mean and maximum per key; rows later than `late` are dropped."""
    hour = F.window(ts, "1 hour")
    stats = [F.count(F.lit(1)).alias("records")]
    for m in metrics:
        stats += [F.avg(m).alias(f"{m}_mean"), F.max(m).alias(f"{m}_max")]
    rows = df.withWatermark(ts, late) if df.isStreaming else df
    return rows.groupBy(key, hour.alias("_w")).agg(*stats).select(
        key, F.col("_w.start").alias("hour"), *[c for c in ["records", *[f"{m}_{s}" for m in metrics for s in ("mean", "max")]]]
    )


def to_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to Parquet until the files present now are done."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def to_changes(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the rows that each micro-batch changed as `batch=<id>` (update mode).

    What is written grows with the changes and not with the keys so far; a retried batch overwrites
    its own folder, so reading the newest row per key is the same before and after a retry.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        df.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def merged_changes(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row per key out of the changes of all micro-batches, combined before the shuffle."""
    saved = spark.read.parquet(path)
    rest = [c for c in saved.columns if c not in (*keys, "batch")]
    newest = saved.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.`{c}`") for c in rest])


def compacted(spark: SparkSession, path: str, keys: list[str], target: str) -> None:
    """The merged changes of all batches so far as one batch in a new folder, which later batches go to."""
    last = spark.read.parquet(path).agg(F.max("batch").alias("b")).scalar()
    rows = merged_changes(spark, path, keys).withColumn("batch", last)
    rows.write.mode("overwrite").partitionBy("batch").parquet(target)


def score_stream(stream: DataFrame, load: Callable[[], Callable[[DataFrame], DataFrame]], path: str, checkpoint: str) -> StreamingQuery:
    """Score each micro-batch with the model `load` gives at that moment (models can be replaced
    while the stream runs). Each batch overwrites its own folder."""

    def save(batch: DataFrame, batch_id: int) -> None:
        load()(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish(query: StreamingQuery) -> None:
    """Wait for an availableNow stream; its error is raised here."""
    query.awaitTermination()

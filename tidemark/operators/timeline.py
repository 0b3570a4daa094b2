"""Label episodes, the expected minute spine and its gaps."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import SLOT, TARGET_ROWS, split_hot_series

STEPS_PER_PIECE = 1440


def _numbered(df: DataFrame, partition: list[str], order: list[str], name: str) -> DataFrame:
    """Number the runs of a series: a run starts where `_changed` holds."""
    upto = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.col("_changed").cast("int")).over(upto))


def episodes(
    df: DataFrame,
    key: str,
    order: list[str],
    label: str,
    *,
    normal: str = "none",
    target_rows: int = TARGET_ROWS,
    small_bytes: int | None = None,
) -> DataFrame:
    """Runs of consecutive rows with the same label other than `normal`: start, end, length.

    Hot series are cut into slots. Runs inside a slot are final; only the first and the last run
    of each slot can go on in a neighbour, and those few are joined up in a second step.
    """
    time = order[0]
    slotted = split_hot_series(df, key, order, target_rows, small_bytes)
    line = (df if slotted is None else slotted.df).withColumn("_label", F.coalesce(F.col(label), F.lit(normal)))
    partition = [key] if slotted is None else [key, SLOT]
    series = Window.partitionBy(*partition).orderBy(*order)
    before = F.lag("_label").over(series)
    marked = line.withColumn("_changed", before.isNull() | (before != F.col("_label")))
    numbered = _numbered(marked, partition, order, "_run")
    runs = numbered.groupBy(*partition, "_run").agg(
        F.first("_label").alias(label),
        F.min(time).alias("start"),
        F.max(time).alias("end"),
        F.count(F.lit(1)).alias("length"),
    )
    if slotted is not None:
        last_run = F.max("_run").over(Window.partitionBy(key, SLOT))
        placed = runs.withColumn("_edge", (F.col("_run") == 1) | (F.col("_run") == last_run))
        inner = placed.where(~F.col("_edge"))
        edges = placed.where(F.col("_edge"))
        along = Window.partitionBy(key).orderBy(SLOT, "_run")
        goes_on = (F.lag(label).over(along) == F.col(label)) & (F.lag(SLOT).over(along) != F.col(SLOT))
        linked = edges.withColumn("_changed", ~F.coalesce(goes_on, F.lit(False)))
        chained = _numbered(linked, [key], [SLOT, "_run"], "_chain")
        merged = chained.groupBy(key, "_chain").agg(
            F.first(label).alias(label),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("length").alias("length"),
        )
        columns = [key, label, "start", "end", "length"]
        runs = inner.select(*columns).unionByName(merged.select(*columns))
    return runs.where(F.col(label) != normal).select(key, label, "start", "end", "length")


def spine(keys: DataFrame, key: str, start: Column, end: Column, step: str = "1 minute") -> DataFrame:
    """Every expected time of every key in [start, end), right-open.

    Times are `start` plus whole steps, whatever the start. Steps are numbered and spread in pieces
    of STEPS_PER_PIECE first, so no row carries more than one piece.
    """
    micros = pd.Timedelta(step) // pd.Timedelta("1us")
    ends = keys.select(key, F.unix_micros(start.cast("timestamp")).alias("_from"), F.unix_micros(end.cast("timestamp")).alias("_to"))
    counted = ends.withColumn("_n", F.ceil((F.col("_to") - F.col("_from")) / micros)).where(F.col("_n") > 0)
    last_piece = F.floor((F.col("_n") - 1) / STEPS_PER_PIECE)
    pieces = counted.select(key, "_from", "_n", F.explode(F.sequence(F.lit(0).cast("long"), last_piece)).alias("_piece"))
    low = F.col("_piece") * STEPS_PER_PIECE
    steps = F.explode(F.sequence(low, F.least(low + STEPS_PER_PIECE, F.col("_n")) - 1)).alias("_step")
    return pieces.select(key, "_from", steps).select(
        key, F.timestamp_micros((F.col("_from") + F.col("_step") * micros).cast("long")).alias("timestamp")
    )


def gaps(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """Expected times without an observation. Both frames have `key` and `timestamp`."""
    return expected.join(observed.select(key, "timestamp").distinct(), [key, "timestamp"], "left_anti")


def gap_report(keys: DataFrame, key: str, start: Column, end: Column, observed: DataFrame, step: str = "1 minute") -> DataFrame:
    """Expected, missing and covered share per key of `keys`; `observed` has `key` and `timestamp`.

    The expected times are those of `spine`, which are counted and not built: an observation is
    expected if it lies in [start, end) a whole number of steps after `start`.
    """
    micros = pd.Timedelta(step) // pd.Timedelta("1us")
    ends = keys.select(
        key, F.unix_micros(start.cast("timestamp")).alias("_from"), F.unix_micros(end.cast("timestamp")).alias("_to")
    ).withColumn("expected", F.ceil((F.col("_to") - F.col("_from")) / micros)).where(F.col("expected") > 0)
    at = observed.select(key, F.unix_micros(F.col("timestamp").cast("timestamp")).alias("_at")).distinct()
    fits = (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to")) & ((F.col("_at") - F.col("_from")) % micros == 0)
    seen = ends.join(at, key, "left").groupBy(key, "expected").agg(F.count_if(fits).alias("_seen"))
    return seen.select(key, "expected", (F.col("expected") - F.col("_seen")).alias("missing"), (F.col("_seen") / F.col("expected")).alias("coverage"))

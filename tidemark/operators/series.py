"""Row-frame windows over time series, with hot series split.

A window with `partitionBy(key)` keeps a whole series in one task. That is the best plan while
every series is moderate: one shuffle and one sort serve all frames. A series that holds a large
part of all rows is cut into slots of about `target_rows` consecutive rows instead:

1. count rows per key; keys above `target_rows` are hot (a bounded list: rows / target_rows);
2. a deterministic hash sample of the hot keys' order columns cuts each series into short pieces,
   even whatever the time grain or the gaps, and slots are runs of pieces.

Frames then need the rows before their slot. The pieces are counted, and the last of a slot that
hold `lookback` rows are copied into the next slot as its halo. One shuffle takes every row to its
slots, frames run per (key, slot), and the halo is dropped. No step looks at a whole series.

The cuts are a stored table. Up to BROADCAST_POINTS of them are broadcast, more meet their rows in a
shuffle; they never come to the driver's Python.

Both ways give the same rows. A NULL key is a series like any other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import count_below
from tidemark.sizing import group_join, is_small
from tidemark.sources.files import stored

TARGET_ROWS = 2_000_000
MAX_SLOTS = 200_000
SAMPLES_PER_SLOT = 4
PIECES_PER_SLOT = 16
BROADCAST_POINTS = 50_000

SLOT = "_slot"
HOT = "_hot"
_HALO = "_halo"


@dataclass(frozen=True)
class Slotted:
    """A frame with its slot number and the flag of hot keys."""

    df: DataFrame
    slots: int


@dataclass(frozen=True)
class Cuts:
    """Stored rows (_hot_key, at: sorted sample of the order columns), one per hot key, and their measures."""

    table: DataFrame
    rows_per_slot: int
    keys: int
    points: int  # entries of all samples
    longest: int  # entries of the longest one
    largest: int  # rows of the largest series


def _hot_pieces(df: DataFrame, key: str, order: list[str], target_rows: int, per_slot: int) -> Cuts | None:
    """The cuts of the hot keys, and the rows of a slot.

    The sample is a pure function of the rows; its size is about `per_slot` rows a slot. It grows with
    the number of slots, so it stays a table: the driver gets its measures alone.
    """
    per_key = df.groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("n"))
    total, hot_keys, largest = per_key.agg(
        F.sum("n"), F.sum(F.when(F.col("n") > target_rows, 1).otherwise(0)), F.max("n")
    ).first()
    if not hot_keys:
        return None
    rows_per_slot = max(target_rows, -(-total // MAX_SLOTS))
    hot = per_key.where(F.col("n") > rows_per_slot).select("_hot_key")
    modulus = max(1, rows_per_slot // per_slot)
    picked = F.pmod(F.xxhash64(F.col(key), *[F.col(c) for c in order]), F.lit(modulus)) == 0
    sample = df.where(picked).select(F.col(key).alias("_of"), F.struct(*order).alias("at"))
    sample = sample.join(hot, F.col("_of").eqNullSafe(F.col("_hot_key")))
    table = stored(sample.groupBy("_hot_key").agg(F.sort_array(F.collect_list("at")).alias("at")), "series-cuts")
    keys, points, longest = table.agg(F.count(F.lit(1)), F.sum(F.size("at")), F.max(F.size("at"))).first()
    return Cuts(table, rows_per_slot, keys, points, longest, largest) if keys else None


def _met(rows: DataFrame, key: str, order: list[str], cuts: Cuts, table: DataFrame, how: str) -> DataFrame:
    """`rows` beside the row of `table` of their key: broadcast while all cuts are few, else shuffled.

    In the shuffle a very large series is dealt over several tasks, each with its own copy of the cuts.
    """
    same = rows[key].eqNullSafe(table["_hot_key"])
    if cuts.points <= BROADCAST_POINTS:
        return rows.join(F.broadcast(table), same, how)
    copies = -(-cuts.largest // TARGET_ROWS)
    if copies > 1:
        rows = rows.withColumn("_copy", F.pmod(F.xxhash64(*[rows[c] for c in order]), F.lit(copies)))
        table = table.withColumn("_of_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
        same &= F.col("_copy") == F.col("_of_copy")
    return rows.join(table.hint("shuffle_hash"), same, how)


def split_hot_series(
    df: DataFrame,
    key: str,
    order: list[str],
    target_rows: int = TARGET_ROWS,
    small_bytes: int | None = None,
) -> Slotted | None:
    """Number the slots of hot series, or None if no series is hot.

    The slot number never decreases along `order` within a key; other keys stay in slot 0.
    """
    if is_small(df, small_bytes):
        return None
    cuts = _hot_pieces(df, key, order, target_rows, SAMPLES_PER_SLOT)
    if cuts is None:
        return None
    ends = F.filter("at", lambda _, i: i % SAMPLES_PER_SLOT == SAMPLES_PER_SLOT - 1)
    table = cuts.table.select("_hot_key", ends.alias("_borders"))
    slots = table.agg(F.sum(F.size("_borders") + 1)).first()[0]
    slotted = _met(df, key, order, cuts, table, "left").select(
        *[df[c] for c in df.columns],
        F.coalesce(count_below(F.col("_borders"), max(cuts.longest, 1), F.struct(*[df[c] for c in order])), F.lit(0)).alias(SLOT),
        F.col("_borders").isNotNull().alias(HOT),
    )
    return Slotted(slotted, slots)


def slots_and_halo(counts: list[int], least: int, lookback: int) -> tuple[list[int], list[bool]]:
    """Per piece its slot, and whether the next slot needs a copy of it.

    A slot is as many pieces as hold `least` rows, and `lookback` at least, so that a halo never
    reaches beyond the slot before.
    """
    slots, held, slot = [], 0, 0
    for n in counts:
        if held >= max(least, lookback, 1):
            slot, held = slot + 1, 0
        slots.append(slot)
        held += n
    copied, after = [False] * len(counts), 0
    for k in reversed(range(len(counts))):
        if k + 1 < len(counts) and slots[k + 1] != slots[k]:
            after = 0
        if slots[k] < slot and after < lookback:
            copied[k] = True
            after += counts[k]
    return slots, copied


def with_halo(
    df: DataFrame, key: str, order: list[str], lookback: int, target_rows: int = TARGET_ROWS, small_bytes: int | None = None
) -> DataFrame | None:
    """`df` with its slot number and a flag: rows of hot series whose slot is followed by another come
    once more as the halo of that one. None if no series is hot."""
    if is_small(df, small_bytes):
        return None
    cuts = _hot_pieces(df, key, order, target_rows, PIECES_PER_SLOT)
    if cuts is None:
        return None

    def piece(rows: DataFrame) -> Column:
        return count_below(F.col("at"), cuts.longest, F.struct(*[rows[c] for c in order]))

    lines = df.select(key, *order)
    counted = _met(lines, key, order, cuts, cuts.table, "inner").select("_hot_key", piece(lines).alias("_piece"), F.lit(1).alias("n"))
    # Pieces without a row count as well.
    every = cuts.table.select("_hot_key", F.explode(F.sequence(F.lit(0), F.size("at"))).alias("_piece"), F.lit(0).alias("n"))
    per_piece = counted.unionByName(every).groupBy("_hot_key", "_piece").agg(F.sum("n").alias("n"))
    along = per_piece.groupBy("_hot_key").agg(F.sort_array(F.collect_list(F.struct("_piece", "n"))).alias("_counts"))
    least = cuts.rows_per_slot

    @F.pandas_udf("array<int>")
    def marks(counts: pd.Series) -> pd.Series:
        """Per piece twice its slot, and one more if the next slot needs a copy of it."""
        return counts.map(lambda c: [2 * slot + again for slot, again in zip(*slots_and_halo(list(c), least, lookback))])

    of_key = along.select("_hot_key", marks(F.col("_counts.n")).alias("_marks"))
    table = stored(group_join(cuts.table, of_key, ["_hot_key"]), "series-slots")
    placed = _met(df, key, order, cuts, table, "left").select(*[df[c] for c in df.columns], F.get("_marks", piece(df)).alias("_mark"))
    slot = F.coalesce((F.col("_mark") / 2).cast("int"), F.lit(0))
    copies = F.when(F.col("_mark") % 2 == 1, F.array(slot, slot + 1)).otherwise(F.array(slot))
    return placed.select(*df.columns, F.posexplode(copies).alias(_HALO, SLOT))


def over_series(
    df: DataFrame,
    key: str,
    order: list[str],
    lookback: int,
    build: Callable[[DataFrame, list[str]], DataFrame],
    target_rows: int = TARGET_ROWS,
    small_bytes: int | None = None,
) -> DataFrame:
    """Apply `build(df, partition_columns)`, which adds columns from frames of at most
    `lookback` preceding rows, to every series."""
    slotted = with_halo(df, key, order, lookback, target_rows, small_bytes)
    if slotted is None:
        return build(df, [key])
    return build(slotted, [key, SLOT]).where(F.col(_HALO) == 0).drop(SLOT, _HALO)

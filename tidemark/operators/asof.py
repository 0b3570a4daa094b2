"""Point-in-time (as-of) join and latest-value lookups.

Entities and the rows of all feature sources are put in one time line per key, and each entity row
takes the last row of every source before it: one shuffle and one sort whatever the number of
sources, no range join. A hot key is cut into slots of consecutive rows; the last feature rows of the
earlier slots are carried over in a table with one row per slot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import HOT, SLOT, TARGET_ROWS, split_hot_series
from tidemark.sizing import SMALL_SIDE_ROWS

KEY_SLOTS = 1 << 20


@dataclass(frozen=True)
class FeatureSource:
    """Feature rows with the columns to take from them. `narrowed` rows went through `Reach.narrow`."""

    features: DataFrame
    feature_ts: str
    columns: Sequence[str]
    ttl: str | None = None
    tie: Sequence[str] = ()
    prefix: str = ""
    narrowed: bool = False


@dataclass(frozen=True)
class Reach:
    """What entity rows can match: times up to `high`, from `low` less a time to live on, and keys.

    `keys` has the keys themselves if they are few, else the numbers of the hash slots that they
    take (bounded by KEY_SLOTS; other keys of those slots pass too), or is None if that would keep most.
    """

    low: Column | None
    high: Column | None
    keys: DataFrame | None
    by_slot: bool = False

    def narrow(self, rows: DataFrame, key: str, ts: str, ttl: str | None = None) -> DataFrame:
        if self.high is None:
            return rows.limit(0)
        rows = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull() & (F.col(ts) <= self.high))
        if ttl is not None:
            rows = rows.where(F.col(ts) >= self.low - F.expr(f"INTERVAL '{ttl}'"))
        return self.of_keys(rows, key)

    def of_keys(self, rows: DataFrame, key: str) -> DataFrame:
        if self.keys is None:
            return rows
        at = _slot(rows[key]) if self.by_slot else rows[key]
        return rows.join(F.broadcast(self.keys), at == self.keys["_asked"], "left_semi")


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_SLOTS)).cast("int")


def key_reach(keys: DataFrame, key: str) -> tuple[DataFrame | None, bool]:
    """A table to filter by, and whether it holds hash slots in place of keys."""
    known = keys.where(F.col(key).isNotNull())
    wanted = known.select(F.col(key).alias("_asked")).distinct()
    rows = wanted.limit(SMALL_SIDE_ROWS + 1).collect()
    spark = keys.sparkSession
    if len(rows) <= SMALL_SIDE_ROWS:
        return spark.createDataFrame(rows, wanted.schema), False
    slots = known.select(_slot(F.col(key)).alias("_asked")).distinct().collect()
    return (spark.createDataFrame(slots, "_asked int"), True) if 2 * len(slots) <= KEY_SLOTS else (None, False)


def reach_of(entities: DataFrame, key: str, entity_ts: str) -> Reach:
    """The reach of entity rows: one small aggregate for the times, and their keys."""
    bounds = time_bounds(entities, entity_ts)
    if bounds is None:
        return Reach(None, None, None)
    return Reach(*bounds, *key_reach(entities, key))


def asof_join_all(
    entities: DataFrame,
    sources: Sequence[FeatureSource],
    *,
    key: str,
    entity_ts: str,
    reach: Reach | None = None,
    target_rows: int = TARGET_ROWS,
    small_bytes: int | None = None,
) -> DataFrame:
    """Every entity row with the columns of the newest row of each source at or before it.

    * Both ends count: a feature at the entity's own timestamp matches, and so does one exactly
      `ttl` old. Older ones give NULL. `ttl` is an interval text such as "24 hours"; None = no limit.
    * Of several rows of a source with the same timestamp the one with the greatest `tie` wins.
    * `<prefix>feature_time` is the matched row's timestamp. Entity rows are never lost or doubled.
    * A feature row without key or time matches nothing; entity rows without them keep NULLs.

    Only features that can match are read: the entities' range of times and their keys (or the hash
    slots of these, if they are many) become filters of the feature side.
    """
    kept = entities.columns
    reach = reach or reach_of(entities, key, entity_ts)
    asking = F.col(key).isNotNull() & F.col(entity_ts).isNotNull()
    lines = [
        entities.where(asking).select(
            F.col(key).alias("_key"), F.col(entity_ts).alias("_ts"), F.lit(1).alias("_side"), F.struct(*kept).alias("_entity")
        )
    ]
    ties = []
    for i, source in enumerate(sources):
        rows = source.features if source.narrowed else reach.narrow(source.features, key, source.feature_ts, source.ttl)
        names = [f"_tie{i}_{k}" for k in range(len(source.tie))]
        ties += names
        lines.append(
            rows.where(F.col(key).isNotNull() & F.col(source.feature_ts).isNotNull()).select(
                F.col(key).alias("_key"),
                F.col(source.feature_ts).alias("_ts"),
                F.lit(0).alias("_side"),
                *[F.col(t).alias(n) for t, n in zip(source.tie, names)],
                F.struct(F.col(source.feature_ts).alias("at"), *source.columns).alias(f"_found{i}"),
            )
        )
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lines)
    # Rows of other sources have no tie of this one, so among its own rows only its ties decide.
    order = ["_ts", "_side", *ties]
    found = [f"_found{i}" for i in range(len(sources))]
    slotted = split_hot_series(rows, "_key", order, target_rows, small_bytes)
    partition = ["_key"] if slotted is None else ["_key", SLOT]
    upto = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    line = rows if slotted is None else slotted.df
    last = {f"_last{i}": F.last(f, ignorenulls=True).over(upto) for i, f in enumerate(found)}
    seen = line.withColumns(last).where(F.col("_side") == 1)
    if slotted is not None:
        carried = _carry_over(slotted.df, order, found)
        seen = seen.join(F.broadcast(carried), ["_key", SLOT], "left").withColumns(
            {f"_last{i}": F.coalesce(f"_last{i}", f"_carried{f}") for i, f in enumerate(found)}
        )
    matches, shown = [], []
    for i, source in enumerate(sources):
        fresh = F.lit(True)
        if source.ttl is not None:
            fresh = F.col(f"_last{i}.at") >= F.col("_ts") - F.expr(f"INTERVAL '{source.ttl}'")
        matches.append(F.when(fresh, F.col(f"_last{i}")).alias(f"_m{i}"))
        shown.append(F.col(f"_m{i}.at").alias(f"{source.prefix}feature_time"))
        shown += [F.col(f"_m{i}.{c}").alias(f"{source.prefix}{c}") for c in source.columns]
    answered = seen.select("_entity", *matches).select(*[F.col(f"_entity.`{c}`") for c in kept], *shown)
    kinds = [f.dataType for f in answered.schema.fields]
    blank = [F.lit(None).cast(kind).alias(c) for kind, c in zip(kinds[len(kept) :], answered.columns[len(kept) :])]
    return answered.union(entities.where(~asking).select(*kept, *blank))


def asof_join(
    entities: DataFrame,
    features: DataFrame,
    *,
    key: str,
    entity_ts: str,
    feature_ts: str,
    columns: list[str],
    ttl: str | None = None,
    tie: list[str] | None = None,
    prefix: str = "",
    **options,
) -> DataFrame:
    """`asof_join_all` with one source."""
    source = FeatureSource(features, feature_ts, columns, ttl, tie or [], prefix)
    return asof_join_all(entities, [source], key=key, entity_ts=entity_ts, **options)


def time_bounds(df: DataFrame, ts: str) -> tuple[Column, Column] | None:
    """Least and greatest time as constants, so that a filter on them reaches a scan; None without any."""
    kind = df.schema[ts].dataType
    row = df.agg(F.min(ts).cast("string").alias("low"), F.max(ts).cast("string").alias("high")).first()
    return None if row["low"] is None else (F.lit(row["low"]).cast(kind), F.lit(row["high"]).cast(kind))


def only_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of `df` whose key, or at least its hash slot, is among `keys`."""
    return Reach(None, None, *key_reach(keys, key)).of_keys(df, key)


def _carry_over(rows: DataFrame, order: list[str], found: list[str]) -> DataFrame:
    """Last row of each source before each slot of the hot keys: as many rows as there are slots."""
    last = [F.max_by(f, F.when(F.col(f).isNotNull(), F.struct(*order))).alias(f) for f in found]
    per_slot = rows.where(F.col(HOT)).groupBy("_key", SLOT).agg(*last)
    before = Window.partitionBy("_key").orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    return per_slot.select("_key", SLOT, *[F.last(f, ignorenulls=True).over(before).alias(f"_carried{f}") for f in found])


def latest_per_key(
    df: DataFrame,
    key: str,
    ts: str,
    tie: list[str] | None = None,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Newest row per key inside [start, end]; rows without key or time are not an answer.

    Spark keeps one row per key and task before the shuffle (a group limit), so a hot key costs
    as many rows as there are tasks.
    """
    df = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    if start is not None:
        df = df.where(F.col(ts) >= start)
    if end is not None:
        df = df.where(F.col(ts) <= end)
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in (ts, *(tie or []))])
    return df.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") == 1).drop("_place")


def online_lookup(entities: DataFrame, latest: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Latest values for the asked keys; unknown keys give NULL."""
    return entities.join(latest.select(key, *columns), key, "left")

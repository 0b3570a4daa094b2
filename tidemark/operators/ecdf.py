"""Cumulative counts over ordered values, and what is read off them.

ROC, average precision, exact percentiles, Kolmogorov-Smirnov and Wasserstein distances all need
running totals over the distinct values of a group. A window over a whole group is one task, so
beyond small inputs the values are cut into bins of about equal size first: rows are combined
per (group, value) before any shuffle, each (group, bin) gets its own window, and the totals of
the bins before it are added from a table with one row per (group, bin).

The bins are Spark's own range partitions of (group, value), whose borders come from samples of every
partition, larger ones for larger partitions. What is cut is the combined rows, so a value that fills
the input is one row of its bin. Their number follows `spark.sql.shuffle.partitions` and has no bound
of its own. Borders only steer the balance: any borders give the same totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sizing import group_join, is_small
from tidemark.sources.files import stored


def running_totals(
    df: DataFrame,
    groups: list[str],
    value: str,
    measures: dict[str, Column],
    *,
    descending: bool = False,
    small_bytes: int | None = None,
    bins: int | None = None,
) -> DataFrame:
    """One row per (group, distinct value) with, per measure m: `m` (sum at the value), `cum_m`
    (sum up to and including it in the chosen direction) and `all_m` (sum of the group).

    `next_value` is the value after it in that direction, NULL at the end. NULL values are left out.
    """
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(*groups, value).agg(*[F.sum(c).alias(m) for m, c in measures.items()])
    return totals_of_counts(counts, groups, value, list(measures), descending=descending, small=is_small(df, small_bytes), bins=bins)


def totals_of_counts(
    counts: DataFrame, groups: list[str], value: str, measures: list[str], *, descending: bool = False, small: bool = False, bins: int | None = None
) -> DataFrame:
    """`running_totals` of rows that are combined already: one per (group, value), with the sum of each measure.

    Unless `small` the rows are read twice, for the borders of the bins and for the bins.
    """

    def by(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    if small:
        group = Window.partitionBy(*groups)
        upto = group.orderBy(by(value))
        frame = upto.rowsBetween(Window.unboundedPreceding, 0)
        return counts.select(
            *groups,
            value,
            *measures,
            *[F.sum(m).over(frame).alias(f"cum_{m}") for m in measures],
            *[F.sum(m).over(group).alias(f"all_{m}") for m in measures],
            F.lead(value).over(upto).alias("next_value"),
        )
    parts = bins or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.repartitionByRange(parts, *[F.col(g) for g in groups], by(value))
    # Written, so that all who read it see the same rows in the same bin.
    binned = stored(dealt.withColumn("_bin", F.spark_partition_id()), "value-bins")
    per_bin = binned.groupBy(*groups, "_bin").agg(
        *[F.sum(m).alias(m) for m in measures],
        (F.max(value) if descending else F.min(value)).alias("_edge"),
    )
    across = Window.partitionBy(*groups)
    before = across.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    # The totals before a bin enter its window as one more row, ahead of all values: no join.
    carried = per_bin.select(
        *groups,
        "_bin",
        F.lit(None).cast(counts.schema[value].dataType).alias(value),
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(m) for m in measures],
        *[F.sum(m).over(across).alias(f"all_{m}") for m in measures],
        F.lead("_edge").over(across.orderBy("_bin")).alias("_next_edge"),
    )
    lines = binned.unionByName(carried, allowMissingColumns=True)
    value_order = F.desc_nulls_first(value) if descending else F.asc_nulls_first(value)
    inside = Window.partitionBy(*groups, "_bin").orderBy(value_order)
    frame = inside.rowsBetween(Window.unboundedPreceding, 0)
    return lines.select(
        *groups,
        value,
        *measures,
        *[F.sum(m).over(frame).alias(f"cum_{m}") for m in measures],
        *[F.first(f"all_{m}").over(frame).alias(f"all_{m}") for m in measures],
        F.coalesce(F.lead(value).over(inside), F.first("_next_edge").over(frame)).alias("next_value"),
    ).where(F.col(value).isNotNull())


def percentile_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def percentiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    points: dict[str, float],
    *,
    beside: dict[str, Column] | None = None,
    small_bytes: int | None = None,
) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group and one column per point.

    `beside` names further aggregates of the groups, made in the same pass where there is one pass.
    Groups whose values are all NULL are kept, with NULL percentiles.
    """
    others = [c.alias(n) for n, c in (beside or {}).items()]
    if is_small(df, small_bytes):
        # One aggregate for all points: they share a single count of the values.
        marks = F.percentile(value, list(points.values())).alias("_marks")
        found = df.groupBy(*groups).agg(marks, *others)
        return found.select(*groups, *[F.get("_marks", F.lit(i)).alias(n) for i, n in enumerate(points)], *(beside or {}))
    totals = running_totals(df, groups, value, {"n": F.lit(1)}, small_bytes=small_bytes)
    picks, finals = [], []
    for name, p in points.items():
        at = F.lit(p) * (F.col("all_n") - 1)
        low = F.min(F.when(F.col("cum_n") > F.floor(at), F.col(value)))
        high = F.min(F.when(F.col("cum_n") > F.ceil(at), F.col(value)))
        picks += [low.alias(f"_lo_{name}"), high.alias(f"_hi_{name}")]
        place = F.lit(p) * (F.col("_n") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        finals.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    found = totals.groupBy(*groups).agg(F.max("all_n").alias("_n"), *picks).select(*groups, *finals)
    if not groups:
        if not others:
            return found
        marks = found.select(F.struct(*points)).scalar()
        return df.agg(*others).select(*[marks[p].alias(p) for p in points], *beside)
    whole = df.groupBy(*groups).agg(*others) if others else df.select(*groups).distinct()
    joined = group_join(whole, found, groups, "left")
    return joined.select(*groups, *points, *(beside or {}))

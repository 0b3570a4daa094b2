"""Scalar expressions: safe arithmetic, hashing, search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """Missing doubles are NULL from ingest on, so the built-in aggregates skip them."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def ratio_or_zero(num: Column | str, den: Column | str, scale: float = 1.0) -> Column:
    """num / den * scale where den is positive, else 0 (also for a NULL den)."""
    num, den = col(num), col(den)
    quotient = F.try_divide(num, den)
    if scale != 1.0:
        quotient = quotient * F.lit(scale)
    return F.when(den > 0, quotient).otherwise(F.lit(0.0))


def share(num: Column, den: Column) -> Column:
    """num / den, 0 if den is 0 or NULL."""
    return or_zero(F.try_divide(num.cast("double"), den.cast("double")))


def clip(c: Column, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL (greatest/least alone would skip it)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def key_hash(keys: Sequence[Column | str], seed: int | str) -> Column:
    """md5 over the key columns and a seed: the same value on every run, retry and engine."""
    parts = [F.coalesce(col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def unit_hash(keys: Sequence[Column | str], seed: int | str) -> Column:
    """Uniform value in (0, 1) from the leading 32 bits of the key hash."""
    lead = F.conv(F.substring(key_hash(keys, seed), 1, 8), 16, 10).cast("double")
    return (lead + F.lit(0.5)) / F.lit(4294967296.0)


def exponential_hash(keys: Sequence[Column | str], seed: int | str, scale: float) -> Column:
    """Exponential noise by inversion of a key-hash uniform."""
    return -F.log(F.lit(1.0) - unit_hash(keys, seed)) * F.lit(scale)


def normal_hash(keys: Sequence[Column | str], seed: int | str, mean: float, std: float) -> Column:
    """Normal noise (Box-Muller) from two key-hash uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(unit_hash(keys, f"{seed}r")))
    angle = F.lit(6.283185307179586) * unit_hash(keys, f"{seed}a")
    return F.lit(mean) + F.lit(std) * radius * F.cos(angle)


def count_below(bounds: Column, size: int, value: Column) -> Column:
    """How many entries of a sorted array lie strictly below `value`.

    Binary search as an `aggregate` over step widths: log2(size) steps per row, JVM-side.
    `size` is the largest length the array can have; missing entries count as +infinity.
    """
    steps, width = [], 1
    while width <= size:
        steps.append(width)
        width *= 2
    loop = F.array(*[F.lit(s) for s in reversed(steps)])

    def advance(at: Column, step: Column) -> Column:
        probe = F.get(bounds, at + step - 1)
        return F.when(probe.isNotNull() & (probe < value), at + step).otherwise(at)

    return F.aggregate(loop, F.lit(0), advance)

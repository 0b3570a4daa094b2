"""Column expressions on texts shared by the native operators, and column names that cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, LOWER.upper(), LOWER)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` has it (names are case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name

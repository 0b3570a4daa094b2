"""Size checks that pick between a plain plan and a split one.

Two rules are used throughout the library:

* A plan that keeps one key in one task is only taken when the whole input is small, or when
  a count shows that no key is hot. Hot keys are split and put together again exactly.
* A side is broadcast only after its rows were counted against a fixed limit.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_INPUT_BYTES = 128 * 1024 * 1024
SMALL_SIDE_ROWS = 10_000
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def plan_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate (file sizes for scans); None if it is not available."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """True when the whole input is far below one task's memory, so no group can be too big.

    `limit` (or the session setting `spark.tidemark.smallInputBytes`) moves the border; 0 turns
    the short cut off, which is how tests and checks drive the split plans.
    """
    if limit is None:
        limit = int(df.sparkSession.conf.get("spark.tidemark.smallInputBytes", str(SMALL_INPUT_BYTES)))
    size = plan_bytes(df)
    return size is not None and size < limit


def counted_side(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> DataFrame:
    """Broadcast `df` if it has at most `max_rows` rows, else hand it back for a shuffle join.

    The rows are fetched once (at most `max_rows` + 1 of them), so the join uses exactly what
    was counted, also after a lost executor.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def group_join(left: DataFrame, right: DataFrame, groups: list[str], how: str = "inner") -> DataFrame:
    """Join two aggregates on their groups, where NULL is a group like any other."""
    named = right.select(*[F.col(g).alias(f"_right_{g}") for g in groups], *[c for c in right.columns if c not in groups])
    same = [F.col(g).eqNullSafe(F.col(f"_right_{g}")) for g in groups]
    return left.join(named, same, how).drop(*[f"_right_{g}" for g in groups])


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    `spark.checkpoint.dir` names it; a local temporary folder is used only where it is unset and
    driver and executors are one process. On a cluster without that setting this is an error:
    executors would write where nobody else can read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = os.path.join(tempfile.gettempdir(), "tidemark")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables written inside leave no shuffle files behind; else these stay on disk until the driver happens to
    collect its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)

"""Session settings the jobs are written for."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession


# A generated method above 8000 bytes of code is never compiled by the JVM. Past that size Spark
# should use its split projections instead of one whole-stage method; wide feature tables get there.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that may change on a running session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession, *beside: str) -> None:
    """Send this package to the workers, for clusters on which it is not installed, once a session.

    Jobs with Python functions (keyed stream state, isolation trees) import it there. `beside` names
    modules and packages in the folder that holds the package; missing ones are left out. The archive
    is made in a folder of the driver, whose file server the workers fetch it from.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(home)
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "tidemark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for name in (os.path.basename(home), *beside):
            top = os.path.join(root, name)
            files = [top] if os.path.isfile(top) else [os.path.join(at, f) for at, _, names in os.walk(top) for f in names]
            for path in files:
                if path.endswith(".py"):
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def build_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC time.

    Shuffle partitions start high and are merged by AQE, so the same setting serves small and
    large inputs; give `spark.sql.shuffle.partitions` explicitly for a fixed local size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **RUNTIME_SETTINGS,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

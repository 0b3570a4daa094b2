"""Package on workers and shared folders."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark import sizing
from tidemark.llm.components import written
from tidemark.sources.files import stored

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_workers_get_the_package_from_any_folder(tmp_path):
    """A job with a Python function, started elsewhere, on workers that know nothing of the repository."""
    script = tmp_path / "job.py"
    script.write_text(
        textwrap.dedent(
            f"""
            import sys
            sys.path.insert(0, {REPO!r})
            from tidemark.session import build_session, ship_package
            spark = build_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
            ship_package(spark)

            def where(_):
                import tidemark
                return [tidemark.__file__]

            print("WORKER", spark.sparkContext.parallelize([1], 1).mapPartitions(where).collect())
            """
        )
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "WORKER" in out.stdout, out.stderr[-2000:]


def test_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    conf = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sizing.shared_dir(SimpleNamespace(conf=conf, sparkContext=context), "x")


@pytest.mark.parametrize("hidden", ["tokenizers", "no_such_library"])
def test_core_queries_do_without_optional_libraries(tmp_path, hidden):
    """From another folder: the core queries are there when a library of the training-data part is not, and
    one with a Python function runs on workers that know nothing of the repository."""
    script = tmp_path / "job.py"
    script.write_text(
        textwrap.dedent(
            f"""
            import sys
            sys.modules[{hidden!r}] = None
            sys.path.insert(0, {REPO!r})
            from __spark_entry__ import queries
            found = queries()
            print("QUERIES", len(found), "features_all" in found)
            if {hidden!r} != "tokenizers":
                from tidemark.session import build_session
                spark = build_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
                print("ROWS", found["stream_keyed_features"](spark, "/root/testdata/sf0.001").count())
            """
        )
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "QUERIES" in out.stdout and "True" in out.stdout, out.stderr[-2000:]
    assert hidden == "tokenizers" or ("ROWS" in out.stdout and "ROWS 0" not in out.stdout), out.stderr[-2000:]


@pytest.mark.parametrize("keep", [written, stored])
def test_written_tables_leave_no_shuffle_files(spark, keep):
    """Those of a step that is over do not wait for the driver's garbage collection."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def held():
        return env.shuffleManager().shuffleBlockResolver().getStoredShuffles().size()

    before = held()
    for _ in range(3):
        assert set(keep(spark.range(1000).groupBy((F.col("id") % 7).alias("g")).count(), "groups").columns) == {"g", "count"}
    deadline = time.time() + 20
    while held() > before and time.time() < deadline:
        time.sleep(0.1)
    assert held() <= before
    assert spark.conf.get(sizing.DROP_SHUFFLES) == "false"

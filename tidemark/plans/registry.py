"""Run history and model versions as tables: leaderboard, promotion, rollback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.metrics import classification_scores, ranking_scores
from tidemark.sizing import group_join

# Library behind each model type, and the next stage of a version.
FRAMEWORKS = {"IsolationForest": "scikit-learn", "XGBoost": "xgboost", "Autoencoder": "pytorch"}
NEXT_STAGE = {"None": "Staging", "Staging": "Production"}
METRIC_NAMES = ["f1_score", "roc_auc", "precision", "recall"]


def _lookup(table: dict[str, str], key: Column, default: str) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def framework_of(model_type: Column) -> Column:
    return _lookup(FRAMEWORKS, model_type, "unknown")


def next_stage(stage: Column) -> Column:
    return _lookup(NEXT_STAGE, stage, "Staging")


def score_models(
    predictions: DataFrame, version: str, predicted: str, score: str, label: str, small_bytes: int | None = None
) -> DataFrame:
    """Evaluation of every model version from its scored rows; without a score its AUCs are NULL."""
    counts = classification_scores(predictions, [version], predicted, label)
    ranks = ranking_scores(predictions, [version], score, label, small_bytes)
    return group_join(counts, ranks, [version], "left")


def metric_rows(scores: DataFrame, run_id: Column, run_name: Column, start_time: Column, metrics: list[str]) -> DataFrame:
    """Metrics as run-history rows, one per (run, metric)."""
    long = scores.select(
        run_id.alias("run_id"),
        run_name.alias("run_name"),
        start_time.alias("start_time"),
        *[F.col(m).cast("string").alias(m) for m in metrics],
    ).unpivot(["run_id", "run_name", "start_time"], metrics, "key", "value")
    return long.select(
        "run_id", "run_name", "start_time", F.lit("metric").alias("kind"), "key", "value", F.lit(None).cast("int").alias("step")
    )


def runs_wide(runs: DataFrame, metrics: list[str], params: list[str]) -> DataFrame:
    """One row per run with the last value of each wanted metric and parameter."""

    def last(kind: str, key: str) -> Column:
        mine = (F.col("kind") == kind) & (F.col("key") == key)
        return F.max_by(F.when(mine, F.col("value")), F.when(mine, F.struct(F.coalesce("step", F.lit(-1)), "start_time")))

    return runs.groupBy("run_id").agg(
        *[last("metric", m).cast("double").alias(m) for m in metrics], *[last("param", p).alias(p) for p in params]
    )


def version_table(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Model versions with their run's scores; missing metrics count 0, missing parameters '?'."""
    wide = runs_wide(runs, METRIC_NAMES, ["model_type"])
    return versions.join(wide, "run_id", "left").select(
        "version",
        "stage",
        F.coalesce("model_type", F.lit("?")).alias("model_type"),
        *[F.coalesce(m, F.lit(0.0)).alias(m) for m in METRIC_NAMES],
        "run_id",
    )


def leaderboard(table: DataFrame) -> DataFrame:
    """Versions ranked by F1; the lower version first on equal F1.

    The rank is over one row per registered version, never over prediction rows.
    """
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("f1_score").desc(), "version"))
    return table.withColumn("place", place)


def improvement(table: DataFrame) -> DataFrame:
    """The best version beside Production, with its gain in percent (infinite from 0)."""
    best = table.orderBy(F.col("f1_score").desc(), "version").limit(1)
    production = table.where(F.col("stage") == "Production").orderBy("version").limit(1)
    base = production.select("f1_score").scalar()
    gain = F.col("f1_score") - base
    percent = F.when(base > 0, F.try_divide(gain, base) * 100).otherwise(F.lit(float("inf")))
    return best.select(
        F.col("version").alias("best_version"),
        F.col("f1_score").alias("best_f1"),
        production.select("version").scalar().alias("production_version"),
        base.alias("production_f1"),
        F.when(base.isNotNull(), F.when(gain > 0, percent).otherwise(F.lit(0.0))).alias("improvement_pct"),
    )


def promotion_candidate(table: DataFrame) -> DataFrame:
    """Best version outside Production and the stage it moves to."""
    return (
        table.where(F.col("stage") != "Production")
        .orderBy(F.col("f1_score").desc(), "version")
        .limit(1)
        .select("version", "stage", next_stage(F.col("stage")).alias("target_stage"), "f1_score")
    )


def apply_promotion(versions: DataFrame, candidate: DataFrame, archive: bool = True) -> DataFrame:
    """Version table after the promotion; earlier versions of the target stage are archived."""
    chosen = candidate.select(F.struct("version", "target_stage")).scalar()
    target = chosen["target_stage"]
    moved = F.col("version") == chosen["version"]
    stage = F.when(moved, target)
    if archive:
        stage = stage.when(F.col("stage") == target, "Archived")
    return versions.withColumn("stage", F.coalesce(stage, F.col("stage")))


def rollback_target(versions: DataFrame) -> DataFrame:
    """Newest archived version, else newest in Staging, else none. Versions compare as numbers."""
    turn = F.when(F.col("stage") == "Archived", 0).when(F.col("stage") == "Staging", 1)
    number = F.col("version").cast("int")
    return versions.where(turn.isNotNull()).orderBy(turn, number.desc()).limit(1)


def apply_rollback(versions: DataFrame, target: DataFrame) -> DataFrame:
    """Version table after the rollback: target in Production, the former one archived.

    Without a target nothing changes.
    """
    chosen = target.select("version").scalar()
    stage = (
        F.when(chosen.isNull(), F.col("stage"))
        .when(F.col("version") == chosen, "Production")
        .when(F.col("stage") == "Production", "Archived")
        .otherwise(F.col("stage"))
    )
    return versions.withColumn("stage", stage)


def version_tags(
    table: DataFrame, training_date: Column, data_version: Column, *, author: str, project: str, anomaly_types: str
) -> DataFrame:
    """Nine tags per version, one row each. Scores are rounded to 4 digits, without trailing zeros."""

    def score(name: str) -> Column:
        return F.regexp_replace(F.format_string("%.4f", F.col(name)), r"(\.\d+?)0+$", "$1")

    tags = {
        "model_type": F.when(F.coalesce(F.col("model_type"), F.lit("?")) == "?", "unknown").otherwise(F.col("model_type")),
        "training_date": F.date_format(training_date, "yyyy-MM-dd"),
        "author": F.lit(author),
        "project": F.lit(project),
        "data_version": data_version,
        "anomaly_types_detected": F.lit(anomaly_types),
        "f1_score": score("f1_score"),
        "roc_auc": score("roc_auc"),
        "framework": framework_of(F.col("model_type")),
    }
    pairs = F.create_map(*[x for k, v in tags.items() for x in (F.lit(k), v)])
    return table.select("version", F.explode(pairs).alias("tag", "value"))


def latest_run(runs: DataFrame, name_like: str) -> DataFrame:
    """All rows of the newest run whose name matches."""
    newest = (
        runs.where(F.col("run_name").like(name_like))
        .orderBy(F.col("start_time").desc(), F.col("run_id").desc())
        .limit(1)
        .select("run_id")
    )
    return runs.where(F.col("run_id") == newest.scalar())

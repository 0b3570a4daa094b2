"""Classifier evaluation from prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import count_below, share
from tidemark.operators.ecdf import percentile_name, percentiles, running_totals
from tidemark.sizing import counted_side, group_join


def confusion(df: DataFrame, groups: list[str], predicted: str, label: str) -> DataFrame:
    """tp, fp, fn, tn in one pass with map-side combine. Only 1 is a positive prediction or label: a
    missing prediction raises no alarm and counts among the negatives, so the four add up to all rows."""
    p, y = F.coalesce(F.col(predicted) == 1, F.lit(False)), F.coalesce(F.col(label) == 1, F.lit(False))
    return df.groupBy(*groups).agg(
        F.count_if(p & y).alias("tp"),
        F.count_if(p & ~y).alias("fp"),
        F.count_if(~p & y).alias("fn"),
        F.count_if(~p & ~y).alias("tn"),
    )


def f1_of(precision: Column, recall: Column) -> Column:
    return share(F.lit(2.0) * precision * recall, precision + recall)


def with_scores(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and accuracy beside confusion counts; 0 where undefined."""
    precision = share(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = share(F.col("tp"), F.col("tp") + F.col("fn"))
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return df.select(
        "*",
        precision.alias("precision"),
        recall.alias("recall"),
        f1_of(precision, recall).alias("f1_score"),
        share(F.col("tp") + F.col("tn"), total).alias("accuracy"),
        total.alias("total"),
    )


def classification_scores(df: DataFrame, groups: list[str], predicted: str, label: str) -> DataFrame:
    return with_scores(confusion(df, groups, predicted, label))


def score_totals(
    df: DataFrame, groups: list[str], score: str, label: str, small_bytes: int | None = None
) -> DataFrame:
    """Positives and negatives per distinct score, cumulative from the highest score down."""
    y = F.col(label) == 1
    return running_totals(
        df,
        groups,
        score,
        {"pos": F.when(y, 1).otherwise(0), "neg": F.when(y, 0).otherwise(1)},
        descending=True,
        small_bytes=small_bytes,
    )


def roc_points(
    df: DataFrame, groups: list[str], score: str, label: str, small_bytes: int | None = None
) -> DataFrame:
    """One ROC point per distinct threshold (rows with score >= threshold count as positive)."""
    return score_totals(df, groups, score, label, small_bytes).select(
        *groups,
        F.col(score).alias("threshold"),
        F.try_divide("cum_neg", "all_neg").alias("fpr"),
        F.try_divide("cum_pos", "all_pos").alias("tpr"),
    )


def ranking_scores(
    df: DataFrame, groups: list[str], score: str, label: str, small_bytes: int | None = None
) -> DataFrame:
    """ROC AUC (ties count half) and average precision (step sum over distinct scores)."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    cum_pos, cum_neg = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    wins = F.sum(neg * (cum_pos - pos / 2))
    steps = F.sum(pos * cum_pos / (cum_pos + cum_neg))
    all_pos, all_neg = F.max("all_pos").cast("double"), F.max("all_neg").cast("double")
    return (
        score_totals(df, groups, score, label, small_bytes)
        .groupBy(*groups)
        .agg(F.try_divide(wins, all_pos * all_neg).alias("roc_auc"), F.try_divide(steps, all_pos).alias("pr_auc"))
    )


def classification_report(df: DataFrame, predicted: str, label: str, names: dict[int, str]) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    counts = confusion(df, [], predicted, label)
    stats = {
        1: ("tp", "fp", "fn"),
        0: ("tn", "fn", "fp"),
    }
    classes = []
    for c, (hit, wrong, missed) in stats.items():
        precision = share(F.col(hit), F.col(hit) + F.col(wrong))
        recall = share(F.col(hit), F.col(hit) + F.col(missed))
        classes.append(
            F.struct(
                F.lit(names[c]).alias("class"),
                precision.alias("precision"),
                recall.alias("recall"),
                f1_of(precision, recall).alias("f1_score"),
                (F.col(hit) + F.col(missed)).alias("support"),
            )
        )
    kept = counts.select(
        F.array(*classes).alias("classes"),
        share(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"),
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"),
    )
    numbers = ("precision", "recall", "f1_score")
    first, second = F.col("classes")[0], F.col("classes")[1]

    def macro(stat: str) -> Column:
        return (first[stat] + second[stat]) / 2

    def weighted(stat: str) -> Column:
        return share(first[stat] * first["support"] + second[stat] * second["support"], F.col("n"))

    def line(name: str, fn) -> Column:
        return F.struct(
            F.lit(name).alias("class"), *[fn(s).alias(s) for s in numbers], F.col("n").alias("support")
        )

    accuracy = F.struct(
        F.lit("accuracy").alias("class"), *[F.col("accuracy").alias(s) for s in numbers], F.col("n").alias("support")
    )
    lines = F.concat("classes", F.array(accuracy, line("macro avg", macro), line("weighted avg", weighted)))
    return kept.select(F.inline(lines))


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive; 1 if there are no positives."""
    y = F.col(label) == 1
    counts = df.agg(F.count_if(y).alias("positives"), F.count_if(~y).alias("negatives"))
    return counts.select("*", F.coalesce(F.try_divide("negatives", "positives"), F.lit(1.0)).alias("pos_weight"))


# Candidate percentiles 90, 90.5, ... 99.5 of the normal scores.
SWEEP_POINTS = [(90 + i / 2) / 100 for i in range(20)]


def threshold_sweep(
    df: DataFrame, score: str, label: str, normal: Column | None = None, small_bytes: int | None = None, source: DataFrame | None = None
) -> DataFrame:
    """Confusion counts and scores of `score > t` for 20 candidate thresholds.

    The candidates are percentiles of the normal rows' scores, of `source` if given (such as the rows a
    model was fitted on) and else of `df`, which the counts are of. Scores are counted per interval
    between candidates, so the data is read once and 21 x 2 counts are shuffled, however many
    rows there are.
    """
    normal = normal if normal is not None else F.col(label) == 0
    names = {percentile_name(p): p for p in SWEEP_POINTS}
    marks = percentiles((df if source is None else source).where(normal), [], score, names, small_bytes=small_bytes)
    candidates = marks.select(F.array(*names).alias("t"))
    known = df.where(F.col(score).isNotNull()).select(
        candidates.scalar().alias("t"), F.col(score).alias("s"), F.col(label).alias("y")
    )
    at = known.select(count_below(F.col("t"), len(names), F.col("s")).alias("above"), "y")
    counts = at.groupBy("above").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")
    )
    cells = counts.agg(F.collect_list(F.struct("above", "pos", "neg")).alias("cells"))

    def total(stat: str, keep) -> Column:
        return F.aggregate(F.filter("cells", keep), F.lit(0).cast("long"), lambda a, c: a + c[stat])

    lines = cells.select("cells", F.posexplode(candidates.scalar()).alias("candidate", "threshold"))

    def over(c: Column) -> Column:
        return c["above"] > F.col("candidate")

    counted = lines.select(
        "candidate",
        "threshold",
        total("pos", over).alias("tp"),
        total("neg", over).alias("fp"),
        total("pos", lambda c: ~over(c)).alias("fn"),
        total("neg", lambda c: ~over(c)).alias("tn"),
    )
    return with_scores(counted)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The candidate with the highest F1; the first one on equal F1."""
    return sweep.orderBy(F.col("f1_score").desc(), F.col("candidate")).limit(1)


def density_histogram(df: DataFrame, groups: list[str], value: str, bins: int = 100) -> DataFrame:
    """Density per equal-width bin between each group's minimum and maximum (upper edge included)."""
    known = df.where(F.col(value).isNotNull())
    spans = known.groupBy(*groups).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(F.lit(1)).alias("_n")
    )
    width = (F.col("_high") - F.col("_low")) / bins
    slot = F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("_low"), width)).cast("int"), F.lit(0))
    # Rows meet the spans (one row per group) first, so the shuffle carries at most groups x bins rows a task.
    placed = group_join(known.select(*groups, value), counted_side(spans), groups).select(
        *groups, F.least(slot, F.lit(bins - 1)).alias("bin"), F.lit(1).alias("c"), "_n", width.alias("_w"), "_low"
    )
    return placed.groupBy(*groups, "bin").agg(
        F.sum("c").alias("count"),
        F.min(F.col("_low") + F.col("bin") * F.col("_w")).alias("bin_start"),
        F.try_divide(F.sum("c"), F.min(F.col("_n") * F.col("_w"))).alias("density"),
    )


def row_mse(actual: Column, expected: Column) -> Column:
    """Mean squared difference of two arrays of the same length."""
    squares = F.zip_with(actual, expected, lambda a, b: (a - b) * (a - b))
    return F.try_divide(F.aggregate(squares, F.lit(0.0), lambda s, q: s + q), F.size(actual))

"""Two-sample drift: Kolmogorov-Smirnov, mean shift, Wasserstein and histogram divergence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions.expr import clip, exponential_hash, normal_hash, share
from tidemark.operators.ecdf import totals_of_counts
from tidemark.sizing import is_small
from tidemark.sources.files import stored

P_LIMIT = 0.05
SHIFT_LIMIT = 1.0
WASSERSTEIN_LIMIT = 0.1
SERIES_TERMS = 20


def analysed_columns(reference: list[str], current: list[str]) -> list[str]:
    """Metrics and z-score columns of the reference; one that `current` lacks is analysed as missing."""
    wanted = dict.fromkeys(schema.METRICS + [c for c in reference if "zscore" in c])
    return [c for c in wanted if c in reference]


def two_samples(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Both sides in long form: side, column, value. A side without a column has no values of it."""
    kinds = {f.name: f.dataType for f in [*current.schema.fields, *reference.schema.fields]}
    reference, current = (
        df.withColumns({c: F.lit(None).cast(kinds[c]) for c in columns if c not in df.columns}) for df in (reference, current)
    )
    sides = reference.select(F.lit("ref").alias("side"), *columns).unionByName(
        current.select(F.lit("cur").alias("side"), *columns)
    )
    doubles = sides.select("side", *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(["side"], columns, "column", "value").where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def ks_pvalue(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sided p-value: 2 * sum (-1)^(k-1) exp(-2 k^2 x^2), x = D sqrt(nm/(n+m)).

    Below x = 0.2 the sum is 1 to machine precision. Exact small-sample values are not attempted.
    """
    n, m = n_ref.cast("double"), n_cur.cast("double")
    x = statistic * F.sqrt(F.try_divide(n * m, n + m))
    terms = F.lit(0.0)
    for k in range(1, SERIES_TERMS + 1):
        sign = 2.0 if k % 2 else -2.0
        terms = terms + F.lit(sign) * F.exp(F.lit(-2.0 * k * k) * x * x)
    return F.when(x < 0.2, F.lit(1.0)).when(x >= 0.2, F.greatest(F.lit(0.0), F.least(F.lit(1.0), terms)))


def weighted_moments(counts: DataFrame) -> DataFrame:
    """Per column the means and sizes of both sides and the sample deviation of the reference, from
    rows (column, value, ref, cur). Deviations are from the mean, so nothing cancels."""

    def total(side: str, value: Column) -> Column:
        return F.sum(F.when(F.col(side) > 0, value * F.col(side)))

    sums = counts.groupBy("column").agg(
        *[F.try_divide(total(side, F.col("value")), F.sum(side)).alias(f"_{side}_mean") for side in ("ref", "cur")],
        *[F.sum(side).alias(f"{side}_size") for side in ("ref", "cur")],
    )
    # One row per analysed column: bounded by the width of the schema.
    apart = F.col("value") - F.col("_ref_mean")
    spread = counts.join(F.broadcast(sums), "column").groupBy("column").agg(total("ref", apart * apart).alias("_squares"))
    return sums.join(spread, "column").select(
        "column", "_ref_mean", "_cur_mean", F.sqrt(F.try_divide("_squares", F.col("ref_size") - 1)).alias("_ref_std"), "ref_size", "cur_size"
    )


def column_drift(samples: DataFrame, columns: list[str], small_bytes: int | None = None) -> DataFrame:
    """One row per column of `columns` with both distances, means and the drift verdict.

    A column without values on one side or both is `missing`: it has no p-value and counts as not
    drifted, but it is in the result and so in the total of a summary.
    """
    # The samples are read once: both distances and all moments come from the counts per value.
    small = is_small(samples, small_bytes)
    per_value = samples.groupBy("column", "value").agg(
        F.count_if(F.col("side") == "ref").alias("ref"), F.count_if(F.col("side") == "cur").alias("cur")
    )
    counts = stored(per_value, "value-counts")
    totals = totals_of_counts(counts, ["column"], "value", ["ref", "cur"], small=small)
    gap = F.abs(F.try_divide("cum_ref", "all_ref") - F.try_divide("cum_cur", "all_cur"))
    distances = totals.groupBy("column").agg(
        F.max(gap).alias("_ks"),
        F.sum(gap * (F.col("next_value") - F.col("value"))).alias("_area"),
    )
    moments = weighted_moments(counts)
    asked = samples.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    # One row per analysed column: bounded by the width of the schema.
    joined = asked.join(moments, "column", "left").join(distances, "column", "left")
    shift = F.abs(F.col("_cur_mean") - F.col("_ref_mean")) / (F.col("_ref_std") + F.lit(1e-10))
    p = ks_pvalue(F.col("_ks"), F.col("ref_size"), F.col("cur_size"))
    return joined.select(
        "column",
        F.col("_ks").alias("ks_statistic"),
        p.alias("ks_pvalue"),
        shift.alias("mean_shift_std"),
        F.coalesce(F.try_divide("_area", "_ref_std"), F.lit(0.0)).alias("wasserstein_norm"),
        F.col("_ref_mean").alias("ref_mean"),
        F.col("_cur_mean").alias("curr_mean"),
        F.coalesce("ref_size", F.lit(0)).alias("ref_size"),
        F.coalesce("cur_size", F.lit(0)).alias("cur_size"),
        ((F.coalesce("ref_size", F.lit(0)) == 0) | (F.coalesce("cur_size", F.lit(0)) == 0)).alias("missing"),
        F.coalesce((p < P_LIMIT) | (shift > SHIFT_LIMIT), F.lit(False)).alias("drifted"),
    )


def drift_details(
    reference: DataFrame, current: DataFrame, columns: list[str] | None = None, small_bytes: int | None = None
) -> DataFrame:
    columns = columns or analysed_columns(reference.columns, current.columns)
    return column_drift(two_samples(reference, current, columns), columns, small_bytes)


def drift_summary(details: DataFrame, flag: str = "drifted") -> DataFrame:
    """Dataset verdict: drift when more than half of the columns drifted."""
    drifted = F.count_if(F.col(flag))
    total = F.count(F.lit(1))
    return details.agg(
        (drifted > total * 0.5).alias("dataset_drift_detected"),
        F.round(share(drifted, total), 4).alias("drift_share"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col(flag), F.col("column")))), ",").alias("drifted_features"),
        drifted.alias("num_drifted_features"),
        total.alias("total_features_analyzed"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("missing"), F.col("column")))), ",").alias("missing_features"),
        F.max("ref_size").alias("reference_size"),
        F.max("cur_size").alias("current_size"),
    )


def wasserstein_verdict(details: DataFrame, limit: float = WASSERSTEIN_LIMIT) -> DataFrame:
    """Verdict by normalised Wasserstein distance (our reading of the report library's default)."""
    return details.withColumn("drifted", F.col("wasserstein_norm") > limit)


def histogram_divergence(samples: DataFrame, bins: int = 20, smoothing: float = 1e-6) -> DataFrame:
    """Kullback-Leibler divergence of current from reference over common equal-width bins."""
    spans = samples.groupBy("column").agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    width = (F.col("_high") - F.col("_low")) / bins
    slot = F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("_low"), width)).cast("int"), F.lit(0))
    # One row per analysed column: bounded by the width of the schema.
    placed = samples.join(F.broadcast(spans), "column").withColumn("bin", F.least(slot, F.lit(bins - 1)))
    binned = placed.groupBy("column", "bin").agg(
        F.count_if(F.col("side") == "ref").alias("ref"), F.count_if(F.col("side") == "cur").alias("cur")
    )
    totals = binned.groupBy("column").agg(
        F.sum("ref").alias("n"), F.sum("cur").alias("m"), F.collect_list(F.struct("ref", "cur")).alias("cells")
    )

    def part(count: Column, total: Column) -> Column:
        return (count / total + smoothing) / (1.0 + bins * smoothing)

    def term(c: Column) -> Column:
        p, q = part(c["cur"], F.col("m")), part(c["ref"], F.col("n"))
        return p * F.log(p / q)

    # Bins empty on both sides hold equal smoothed shares and add nothing.
    both = (F.col("n") > 0) & (F.col("m") > 0)
    value = F.aggregate(F.transform("cells", term), F.lit(0.0), lambda a, t: a + t)
    return totals.select("column", F.when(both, value).alias("kl_divergence"))


def shifted_scenario(df: DataFrame, level: str, key: list[str], seed: int = 99) -> DataFrame:
    """What-if version of a telemetry table. Noise is a function of the row key and the seed."""
    latency, loss = F.col("latency_ms"), F.col("packet_loss_pct")
    cpu = F.col("cpu_utilization")
    if level == "none":
        noise = df.agg(*[F.stddev_samp(m).alias(m) for m in schema.METRICS])
        stds = noise.select(F.struct(*schema.METRICS).alias("s")).scalar()
        return df.withColumns(
            {m: F.col(m) + normal_hash(key, f"{seed}{m}", 0.0, 1.0) * F.lit(0.05) * stds[m] for m in schema.METRICS}
        )
    if level == "moderate":
        return df.withColumns(
            {
                "latency_ms": latency * 1.5,
                "packet_loss_pct": loss + exponential_hash(key, seed, 0.5),
                "cpu_utilization": clip(cpu + 10, 0.0, 100.0),
            }
        )
    if level == "severe":
        return df.withColumns(
            {
                "latency_ms": latency * 3,
                "packet_loss_pct": loss + exponential_hash(key, seed, 2.0),
                "cpu_utilization": clip(normal_hash(key, seed, 80.0, 10.0), 0.0, 100.0),
                "bandwidth_mbps": F.col("bandwidth_mbps") * 0.3,
                "error_rate": F.col("error_rate") * 5,
            }
        )
    raise ValueError(f"level must be none, moderate or severe, not {level!r}")

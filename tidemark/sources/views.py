"""Feature views: a small catalog that binds named features to a table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators.asof import FeatureSource, asof_join_all, latest_per_key, online_lookup, only_keys, reach_of

Reader = Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class FeatureView:
    """Features of an entity: where they are read, their time column and how long they are valid."""

    name: str
    entity: str
    source: str | Reader
    fields: dict[str, str]
    timestamp_field: str = "timestamp"
    ttl: str | None = "24 hours"
    tie: tuple[str, ...] = ()
    description: str = ""
    tags: dict[str, str] = field(default_factory=dict)
    online: bool = True
    narrows: bool = False

    def read(self, spark: SparkSession, narrow: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """The view's rows. `narrow` drops rows that nobody asks for; a computed view with `narrows`
        applies it to its raw rows, before the windows, else it is applied to the result."""
        if not callable(self.source):
            rows = spark.read.parquet(self.source)
        elif self.narrows and narrow is not None:
            return self.source(spark, narrow)
        else:
            rows = self.source(spark)
        return narrow(rows) if narrow is not None else rows


# The two views of the telemetry model and their fields.
RAW_VIEW = "network_raw_metrics"
ENGINEERED_VIEW = "network_engineered_features"
RAW_FIELDS = {m: "double" for m in schema.METRICS}
ENGINEERED_FIELDS = {
    **{f"{m}_roll_mean_5min": "double" for m in schema.METRICS},
    **{f"{m}_roll_std_5min": "double" for m in schema.METRICS[:3]},
    **{f"{m}_zscore": "double" for m in schema.METRICS},
    **{f"{m}_delta_1m": "double" for m in schema.METRICS[:2]},
    "latency_x_loss": "double",
    "cpu_bw_ratio": "double",
    "hour": "bigint",
    "is_business_hours": "bigint",
}


def network_views(
    raw: str | Reader, engineered: str | Reader, tie: tuple[str, ...] = (), narrows: bool = False, tags: dict[str, str] | None = None
) -> dict[str, FeatureView]:
    """The raw and the engineered view over the given sources. `tags` go on both, with the view's kind."""
    views = [
        FeatureView(
            RAW_VIEW, "node_id", raw, RAW_FIELDS, tie=tie,
            description="The five metrics as they were measured",
            tags={**(tags or {}), "kind": "measured"},
        ),
        FeatureView(
            ENGINEERED_VIEW, "node_id", engineered, ENGINEERED_FIELDS, tie=tie, narrows=narrows,
            description="Columns computed from the metrics of a node and its recent past",
            tags={**(tags or {}), "kind": "computed"},
        ),
    ]
    return {v.name: v for v in views}


def present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def view_table(features: DataFrame, view: FeatureView) -> DataFrame:
    """The columns a view serves, out of a wider feature table."""
    return present(features, [view.timestamp_field, view.entity, *view.tie, *view.fields])


def resolve(references: list[str], views: dict[str, FeatureView]) -> dict[str, list[str]]:
    """`"view:feature"` names to features per view, in the order given."""
    wanted: dict[str, list[str]] = {}
    for reference in references:
        view, _, feature = reference.partition(":")
        if view not in views or feature not in views[view].fields:
            raise KeyError(f"unknown feature {reference!r}")
        wanted.setdefault(view, []).append(feature)
    return wanted


def historical_features(
    entities: DataFrame,
    references: list[str],
    views: dict[str, FeatureView],
    *,
    entity_ts: str = "timestamp",
    **options,
) -> DataFrame:
    """Point-in-time values from several views: one output row per entity row.

    Each view is matched with its own time to live, so features of one row may come from
    different times in different views. Views of one entity share one time line, so the shuffles do
    not grow with their number. Rows after the last entity time and of keys that nobody asks for are
    left out before a view is computed: its frames only look back.
    """
    spark, out = entities.sparkSession, entities
    wanted = resolve(references, views)
    for entity in dict.fromkeys(views[name].entity for name in wanted):
        reach = reach_of(entities, entity, entity_ts)
        sources = []
        for name in (n for n in wanted if views[n].entity == entity):
            view = views[name]
            # The frames of a computed view look back from its raw rows, so these have no lower end.
            lower = None if view.narrows else view.ttl
            rows = view.read(spark, lambda rows, at=view.timestamp_field, lower=lower: reach.narrow(rows, entity, at, lower))
            if view.narrows and view.ttl is not None and reach.low is not None:
                rows = rows.where(F.col(view.timestamp_field) >= reach.low - F.expr(f"INTERVAL '{view.ttl}'"))
            sources.append(FeatureSource(rows, view.timestamp_field, wanted[name], view.ttl, view.tie, f"_{name}_", narrowed=True))
        before = out.columns
        joined = asof_join_all(out, sources, key=entity, entity_ts=entity_ts, reach=reach, **options)
        taken = [F.col(f"_{n}_{c}").alias(c) for n in wanted if views[n].entity == entity for c in wanted[n]]
        out = joined.select(*before, *taken)
    return out


def materialize(view: FeatureView, spark: SparkSession, start=None, end=None, keys: DataFrame | None = None) -> DataFrame:
    """Online table of a view: newest row per entity in the time range, of the asked `keys` only if given."""

    def narrow(rows: DataFrame) -> DataFrame:
        rows = rows if end is None else rows.where(F.col(view.timestamp_field) <= end)
        return rows if keys is None else only_keys(rows, keys, view.entity)

    return latest_per_key(
        view_table(view.read(spark, narrow), view), view.entity, view.timestamp_field, list(view.tie), start, end
    )


def online_features(
    entities: DataFrame, references: list[str], views: dict[str, FeatureView], tables: dict[str, DataFrame]
) -> DataFrame:
    """Latest values from materialized view tables."""
    out = entities
    for name, columns in resolve(references, views).items():
        out = online_lookup(out, tables[name], views[name].entity, columns)
    return out


def discover(spark: SparkSession, views: dict[str, FeatureView]) -> DataFrame:
    """Catalog as a table: one row per field."""
    rows = [
        (v.name, v.description, v.entity, v.ttl, f, t, v.tags, v.online)
        for v in views.values()
        for f, t in v.fields.items()
    ]
    return spark.createDataFrame(
        rows,
        "view string, description string, entity string, ttl string, feature string, dtype string, "
        "tags map<string,string>, online boolean",
    )


def coverage(spark: SparkSession, views: dict[str, FeatureView]) -> DataFrame:
    """The catalog with the number of known values of every field in its source."""
    counted = None
    for v in views.values():
        names = list(v.fields)
        one = v.read(spark).agg(*[F.count(c).alias(c) for c in names])
        long = one.unpivot([], names, "feature", "known_values").withColumn("view", F.lit(v.name))
        counted = long if counted is None else counted.unionByName(long)
    return discover(spark, views).join(counted, ["view", "feature"])

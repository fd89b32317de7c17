"""Configuration-driven dimension routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.codes import BOOTSTRAP_INSERT, DELETE, INSERT, UPDATE
from millrace.operators.as_of import as_of_join
from millrace.operators.dedup import dedup_latest

DEFAULT_PK = "id"


def current_routes(route_changes: DataFrame) -> DataFrame:
    """The routes in force: the last change per source table; a deletion removes the route."""
    source = F.coalesce(F.col("after.source_table"), F.col("before.source_table"))
    return (
        route_changes.groupBy(source.alias("source_table"))
        .agg(F.max_by(F.struct("op", "after"), "ts_ms").alias("_last"))
        .where((F.col("_last.op") != "d") & F.col("_last.after").isNotNull())
        .select(
            "source_table",
            F.col("_last.after.sink_table").alias("sink_table"),
            F.col("_last.after.sink_columns").alias("sink_columns"),
            F.coalesce(
                F.nullif(F.col("_last.after.sink_pk"), F.lit("")), F.lit(DEFAULT_PK)
            ).alias("sink_pk"),
        )
    )


def snapshot_then_feed(snapshot: DataFrame, feed: DataFrame, position_ms: int) -> DataFrame:
    """The configuration table as it was at ``position_ms``, and the changes after it, as one feed.

    ``snapshot`` has the columns of the table.  Changes up to the position are in it already and
    are left out, so nothing counts twice and a row deleted before it does not come back.
    """
    taken = snapshot.select(
        F.lit(None).cast(feed.schema["before"].dataType).alias("before"),
        F.struct(*[
            (F.col(f.name) if f.name in snapshot.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in feed.schema["after"].dataType
        ]).alias("after"),
        F.lit("r").alias("op"), F.lit(position_ms).cast("bigint").alias("ts_ms"),
    )
    return taken.unionByName(feed.where(F.col("ts_ms") > position_ms).select("before", "after", "op", "ts_ms"))


def route_versions(route_changes: DataFrame) -> DataFrame:
    """``source_table, ts_ms, route``: each version of the configuration; a deletion has an empty route."""
    source = F.coalesce(F.col("after.source_table"), F.col("before.source_table"))
    gone = (F.col("op") == "d") | F.col("after").isNull()
    return route_changes.select(
        source.alias("source_table"), "ts_ms",
        F.struct(
            F.when(~gone, F.col("after.sink_table")).alias("sink_table"),
            F.when(~gone, F.col("after.sink_columns")).alias("sink_columns"),
            F.when(~gone, F.coalesce(F.nullif(F.col("after.sink_pk"), F.lit("")), F.lit(DEFAULT_PK))).alias("sink_pk"),
        ).alias("route"),
    )


def route_by_time(
    cdc: DataFrame, versions: DataFrame, types: Sequence[str] = (INSERT, UPDATE, BOOTSTRAP_INSERT)
) -> DataFrame:
    """As :func:`route_dimensions`, each record by the configuration in force at its commit time.

    ``versions`` is the history from :func:`route_versions`.  A record older than the first
    version of its table, or within a deletion, has no route.  Which records come together
    does not matter: micro-batches give what one batch gives.
    """
    records = cdc.where(F.col("type").isin(*types)).withColumns(
        {"source_table": F.col("table"), "_ms": F.col("ts") * 1000}
    )
    routed = as_of_join(records, versions, ["source_table"], "_ms", "route", "ts_ms")
    out = routed.where("route.sink_table IS NOT NULL").select(
        F.col("route.sink_table").alias("sink_table"), F.col("route.sink_columns").alias("sink_columns"),
        F.col("data")[F.col("route.sink_pk")].alias("pk"), "type", "ts", "xid",
        project_keys(F.col("data"), F.col("route.sink_columns")).alias("data"),
    )
    return out.where(F.col("pk").isNotNull())


def project_keys(data: Column, column_list: Column) -> Column:
    """Only the map entries whose key stands in the comma-separated ``column_list``."""
    allowed = F.split(column_list, ",")
    return F.map_filter(data, lambda k, _: F.array_contains(allowed, k))


def route_dimensions(
    cdc: DataFrame,
    routes: DataFrame,
    types: Sequence[str] = (INSERT, UPDATE, BOOTSTRAP_INSERT),
) -> DataFrame:
    """Change records of routed tables: ``sink_table``, primary key value and kept columns.

    Records of tables without a route are dropped, and so are records without a primary
    key value, which cannot be stored.
    """
    routed = (
        cdc.where(F.col("type").isin(*types))
        .join(routes, F.col("table") == F.col("source_table"), "inner")
        .select(
            "sink_table",
            "sink_columns",
            F.col("data")[F.col("sink_pk")].alias("pk"),
            "type",
            "ts",
            "xid",
            project_keys(F.col("data"), F.col("sink_columns")).alias("data"),
        )
    )
    return routed.where(F.col("pk").isNotNull())


def latest_dimensions(routed: DataFrame, drop_deleted: bool = True) -> DataFrame:
    """The newest record per sink table and primary key.

    Records without a primary key value cannot be stored and are left out.
    """
    kept = dedup_latest(
        routed.where(F.col("pk").isNotNull()), ["sink_table", "pk"], "ts", ("xid",)
    )
    return kept.where(F.col("type") != DELETE) if drop_deleted else kept


def dimension_table(latest: DataFrame, sink_table: str, columns: Sequence[str]) -> DataFrame:
    """One dimension as a flat table of text columns."""
    return latest.where(F.col("sink_table") == sink_table).select(
        *[F.col("data")[c].alias(c) for c in columns]
    )


def empty_dimension(spark, column_list: str) -> DataFrame:
    """The empty table a route creates before its first record arrives."""
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in column_list.split(",")))

"""The newest index row per id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entidex.schemas import INDEX_COLUMNS


def newest_event_per_load(index: DataFrame) -> DataFrame:
    """Newest event time of each (id, feature table, creation time, file)."""
    return index.groupBy("id", "feature_table", "created_timestamp", "path").agg(
        F.max("event_timestamp").alias("event_timestamp")
    )


def latest(index: DataFrame) -> DataFrame:
    """One row per id over all feature tables, with `rk` = 1.

    Newest creation time first, then greatest path (NULL counts as greatest), then
    greatest feature table. The event time does not choose the load: it is the
    newest one *within* the chosen load. As the last field of the struct it comes
    out the same as from `newest_event_per_load`, without that shuffle. Each input
    partition hands on one row per id, so an id with very many rows stays cheap.

    Takes for granted what the checks of ingest ensure: only `path` may be NULL.
    """
    load = F.struct(
        F.col("created_timestamp"),
        F.col("path").isNull().alias("path_is_null"),
        F.col("path"),
        F.col("feature_table"),
        F.col("event_timestamp"),
    )
    return (
        index.groupBy("id")
        .agg(F.max(load).alias("load"))
        .select(
            "id",
            "load.feature_table",
            "load.event_timestamp",
            "load.created_timestamp",
            "load.path",
            F.lit(1).cast("bigint").alias("rk"),
        )
    )


def latest_by_window(index: DataFrame) -> DataFrame:
    """The same rows, ranked by a window; NULL comes before everything in all columns.

    Also one shuffle after a first cut per partition, but its sort compares all
    columns, which makes it slower than `latest`.
    """
    newest_first = Window.partitionBy("id").orderBy(
        F.desc_nulls_first("created_timestamp"),
        F.desc_nulls_first("path"),
        F.desc_nulls_first("feature_table"),
        F.desc_nulls_last("event_timestamp"),
    )
    return (
        index.select(*INDEX_COLUMNS, F.row_number().over(newest_first).alias("rk"))
        .filter(F.col("rk") == 1)
        .withColumn("rk", F.col("rk").cast("bigint"))
    )

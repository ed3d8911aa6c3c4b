"""The registry: five tables that say which file location belongs to which feature table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entidex.functions.values import json_field

TABLES = ["data_sources", "feature_tables", "feature_tables_entities_v2", "entities_v2", "projects"]


@dataclass(frozen=True)
class Registry:
    data_sources: DataFrame
    feature_tables: DataFrame
    feature_tables_entities_v2: DataFrame
    entities_v2: DataFrame
    projects: DataFrame


def read_registry(spark: SparkSession, root: str) -> Registry:
    """Registry tables as Parquet datasets below one folder."""
    return Registry(**{name: spark.read.parquet(f"{root}/{name}") for name in TABLES})


def read_registry_jdbc(spark: SparkSession, url: str, schema: str = "public", **options: str) -> Registry:
    """Registry tables of a live database; needs its JDBC driver on the class path."""
    reader = spark.read.format("jdbc").options(url=url, **options)
    return Registry(**{name: reader.option("dbtable", f"{schema}.{name}").load() for name in TABLES})


def located_sources(registry: Registry) -> DataFrame:
    """Data sources with their `file_url`. One whose configuration is no JSON has none and matches nothing."""
    return registry.data_sources.select(
        "id",
        json_field(F.col("config"), "file_url").alias("file_url"),
        "timestamp_column",
        "created_timestamp_column",
    ).filter(F.col("file_url").isNotNull())


def live_tables(registry: Registry, located: DataFrame | None = None) -> DataFrame:
    """One row per located source and live feature table of it in an active project.

    Columns: those of `located` but its id, then `table` (id of the feature table) and
    `feature_table` (its name). A flag that is NULL counts as not live. Projects that
    share a name are one project, active if any of them is.
    """
    located = located_sources(registry) if located is None else located
    active = registry.projects.filter(~F.col("archived")).select(F.col("name").alias("project_name"))
    tables = registry.feature_tables.filter(~F.col("is_deleted")).join(active, "project_name", "left_semi")
    named = tables.select(F.col("batch_source_id").alias("id"), F.col("id").alias("table"), F.col("name").alias("feature_table"))
    return located.join(named, "id").drop("id")


def table_entities(registry: Registry) -> DataFrame:
    """(table, entity_name, entity_type) of the entities of every feature table."""
    entities = registry.entities_v2.select(
        F.col("id").alias("entity_v2_id"), F.col("name").alias("entity_name"), F.col("type").alias("entity_type")
    )
    of = registry.feature_tables_entities_v2.select(F.col("feature_table_id").alias("table"), "entity_v2_id")
    return of.join(entities, "entity_v2_id").drop("entity_v2_id")


def registered_sources(registry: Registry, located: DataFrame | None = None) -> DataFrame:
    """One row per (source, entity) of live feature tables in active projects.

    Columns: file_url, entity_name, entity_type, feature_table, timestamp_column,
    created_timestamp_column. With `located`, only those of the located sources, whose
    further columns are kept.
    """
    tables = live_tables(registry, located)
    kept = [c for c in tables.columns if c not in ("table", "feature_table")]
    return tables.join(table_entities(registry), "table").select(*kept, "entity_name", "entity_type", "feature_table")

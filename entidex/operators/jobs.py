"""The job log: one row per created event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUCCESS, FAILED = "success", "failed"


def names_of(entities: str) -> Column:
    """Names of a route's entities, in their order."""
    return F.transform(entities, lambda e: e["name"])


def job_rows(outcomes: DataFrame, started: Column, ended: Column, names: Column | None = None) -> DataFrame:
    """Job rows of files with the columns seq, key, problem, entities, feature_table.

    `problem` says why the file was refused; NULL means it was loaded. Without a
    route, entity names and feature table are NULL. With `names`, these are the entity
    names, such as those found once per route, and `entities` is not read.
    """
    return outcomes.select(
        F.col("seq").alias("id"),
        started.alias("started"),
        ended.alias("ended"),
        F.when(F.col("problem").isNull(), SUCCESS).otherwise(FAILED).alias("status"),
        F.col("problem").alias("status_msg"),
        (names_of("entities") if names is None else names).alias("entity_names"),
        F.col("feature_table"),
        F.col("key").alias("path"),
    )


def failures(jobs: DataFrame) -> DataFrame:
    """Failed attempts."""
    return jobs.filter(F.col("status") == FAILED)


def job_summary(jobs: DataFrame) -> DataFrame:
    """Attempts, first start, last end and seconds spent, per feature table, status and message.

    Files that were handled together share their times; such a span counts once.
    """
    group = ["feature_table", "status", "status_msg"]
    micros = F.timestamp_diff("MICROSECOND", F.col("started"), F.col("ended"))
    spans = jobs.groupBy(*group, "started", "ended").agg(F.count("*").alias("n"))
    return spans.groupBy(*group).agg(
        F.sum("n").alias("n_jobs"),
        F.min("started").alias("first_started"),
        F.max("ended").alias("last_ended"),
        (F.sum(micros) / 1_000_000).alias("seconds"),
    )

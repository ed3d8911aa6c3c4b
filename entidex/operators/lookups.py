"""What users ask of the index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entidex.functions.keys import normalized
from entidex.operators.latest import latest


def in_span(rows: DataFrame, start, end) -> DataFrame:
    """Rows whose event time lies in the span, both ends included.

    Over an entity table the filter reaches the Parquet scan; over the latest view
    it stays above it, since it must not change which row is the latest.
    """
    rows = rows.filter(F.col("event_timestamp").between(_time(start), _time(end)))
    if "event_month" in rows.columns:
        rows = rows.filter(F.col("event_month").between(month_of(_time(start)), month_of(_time(end))))
    return rows


def _time(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def month_of(time: Column) -> Column:
    """Storage month of an event time, such as 202401."""
    return F.year(time) * 100 + F.month(time)


def entity_ids(index: DataFrame) -> DataFrame:
    """All known ids."""
    return index.select("id").distinct()


def latest_in_span(index: DataFrame, start, end) -> DataFrame:
    """Latest rows, of those whose event time lies in the span."""
    return in_span(latest(index), start, end)


def rows_for_ids(index: DataFrame, ids: DataFrame) -> DataFrame:
    """Index rows of the ids in `ids`."""
    return index.join(ids.select("id"), "id", "left_semi")


def paths_for_ids(index: DataFrame, ids: DataFrame) -> DataFrame:
    """Files that hold any of the ids."""
    return rows_for_ids(index.select("id", "path"), ids).select("path").distinct()


def without_removed(index: DataFrame, removed: DataFrame) -> DataFrame:
    """Index rows whose file is not among the removed keys (column `key`), however these are spelt.

    A removed file stays out for good; `EntityIndex.live` knows which loads came later.
    """
    gone = removed.select(normalized(F.col("key")).alias("__file")).distinct()
    return index.join(gone, normalized(F.col("path")) == F.col("__file"), "left_anti")


def features_for_rows(
    rows: DataFrame, features: DataFrame, entity: str, timestamp_column: str, created_timestamp_column: str
) -> DataFrame:
    """Feature rows of the looked-up index rows, with the `feature_table` each belongs to.

    `features` holds the columns of the feature files and the `path` of each row's file; its
    time columns are wall times already. All its columns are kept. A row is found in the
    file that the index names for it: other files may hold the same id and times.
    """
    wanted = rows.select("id", "event_timestamp", "created_timestamp", "path", "feature_table").distinct().alias("wanted")
    found = features.alias("features").join(
        wanted,
        (_feature("path") == F.col("wanted.path"))
        & (_feature(entity) == F.col("wanted.id"))
        & (_feature(timestamp_column) == F.col("wanted.event_timestamp"))
        & (_feature(created_timestamp_column) == F.col("wanted.created_timestamp")),
    )
    return found.select("features.*", "wanted.feature_table")


def _feature(name: str) -> Column:
    return F.col("features.`" + name.replace("`", "``") + "`")

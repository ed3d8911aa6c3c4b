"""From feature rows to index rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_id(column: Column, spark_type: str, id_type: str) -> Column:
    """An entity column, by its type in the file, as the id type; NULL if the value is none."""
    if spark_type == id_type:
        return column
    if id_type == "boolean" and spark_type != "string":
        return F.when(column.isin(0, 1), column == 1)
    return column.try_cast(id_type)


def entity_rows(
    rows: DataFrame, ids: dict[str, Column], event_time: Column, created_time: Column, *kept: Column
) -> DataFrame:
    """One row per input row and entity: (entity, id, event and creation time, *kept).

    All entities come out of one scan. Their ids share one type here.
    """
    per_entity = F.array(*[F.struct(F.lit(name).alias("entity"), c.alias("id")) for name, c in ids.items()])
    return rows.select(
        F.inline(per_entity), event_time.alias("event_timestamp"), created_time.alias("created_timestamp"), *kept
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by name, as a balanced tree, since there may be many frames."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return union_all(frames[:half]).unionByName(union_all(frames[half:]))

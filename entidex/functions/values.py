"""Type mapping, event times and JSON fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from entidex.schemas import ID_TYPES


def id_type(registry_type: Column) -> Column:
    """Spark type name for a registry type in any case; NULL if it cannot be indexed."""
    return reduce(
        lambda acc, item: acc.when(F.upper(registry_type) == item[0], F.lit(item[1])),
        ID_TYPES.items(),
        F.when(F.lit(False), F.lit(None).cast("string")),
    )


def from_epoch_micros(micros: Column) -> Column:
    """UTC wall time of epoch microseconds, whatever the session's time zone."""
    return F.timestamp_add("MICROSECOND", micros.try_cast("bigint"), _epoch())


def to_epoch_micros(wall_time: Column) -> Column:
    """Epoch microseconds of UTC wall time."""
    return F.timestamp_diff("MICROSECOND", _epoch(), wall_time)


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def as_wall_time(column: Column, spark_type: str) -> Column:
    """A time column of a feature file, by its type in the file, as UTC wall time."""
    if spark_type == "timestamp_ntz":
        return column
    if spark_type == "timestamp":
        return from_epoch_micros(F.unix_micros(column))
    return from_epoch_micros(column)


def json_field(document: Column, field: str) -> Column:
    """Text of one top-level field; NULL if it is missing or the JSON is invalid."""
    return F.get_json_object(document, f"$.{field}")

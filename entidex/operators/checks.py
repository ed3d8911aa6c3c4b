"""What can be wrong with a load, set by set. A *load* is one file's rows; `load` numbers it.

Rows to check have the columns load, entity and the row key. All checks yield
loads, and all of them combine before they shuffle, so one load or one key with
very many rows is no bottleneck.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entidex.functions.values import id_type
from entidex.schemas import MAX_NAME_LENGTH, ROW_KEY

KEY = ["entity", *ROW_KEY]

# Bits of Spark's bitmap functions (fixed value): most loads that can be compared at once.
MAX_LOADS = 32_768

NO_ROUTE = "no route"
BLANK_COLUMN = "time column not named"
TWICE_NAMED = "column named twice"
LONG_NAME = "feature table name too long"
NO_FILE = "file not found"
REMOVED_FILE = "file removed"
UNREADABLE = "unreadable file"
NULL_KEY = "null in key"
DUPLICATE_KEY = "duplicate key in file"
STORED_KEY = "key already indexed"


def unsupported_type(registry_type: str | Column):
    text = "unsupported entity type: "
    return text + registry_type if isinstance(registry_type, str) else F.concat(F.lit(text), registry_type)


def route_problem(entities: str, feature_table: str, timestamp_column: str, created_timestamp_column: str) -> Column:
    """Why a route cannot be loaded, or NULL. Takes the names of its columns."""
    names = F.transform(entities, lambda e: e["name"])
    times = F.array(timestamp_column, created_timestamp_column)
    columns = F.concat(names, times)
    unsupported = F.filter(entities, lambda e: id_type(e["type"]).isNull())
    return (
        F.when(F.col(entities).isNull(), F.lit(NO_ROUTE))
        .when(F.size(unsupported) > 0, unsupported_type(F.coalesce(F.get(unsupported, F.lit(0))["type"], F.lit(""))))
        .when(F.length(feature_table) > MAX_NAME_LENGTH, F.lit(LONG_NAME))
        .when(F.exists(times, lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""), F.lit(BLANK_COLUMN))
        .when(F.size(F.array_distinct(columns)) < F.size(columns), F.lit(TWICE_NAMED))
    )


def has_null_key() -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ROW_KEY])


def null_key_loads(rows: DataFrame) -> DataFrame:
    """(load, n_rows): loads with NULL in a key, and in how many rows."""
    return rows.filter(has_null_key()).groupBy("load").agg(F.count("*").alias("n_rows"))


def key_holders(rows: DataFrame) -> DataFrame:
    """(key, load, n): the rows that each load has of each key with more than one row in all.

    Keys with NULL are left out. The rows are read once: counted per key and load, then
    those counts per key, whose loads are at most `MAX_LOADS`.
    """
    counts = rows.filter(~has_null_key()).groupBy(*KEY, "load").agg(F.count("*").alias("n"))
    held = counts.groupBy(*KEY).agg(F.sum("n").alias("total"), F.collect_list(F.struct("load", "n")).alias("held"))
    return held.filter(F.col("total") > 1).select(*KEY, F.inline("held"))


def duplicate_key_loads(holders: DataFrame) -> DataFrame:
    """(load, n_keys): loads that hold a key twice, and how many such keys."""
    return holders.filter(F.col("n") > 1).groupBy("load").agg(F.count("*").alias("n_keys"))


def stored_key_loads(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """(load, n_rows): loads with keys of the stored index, and in how many rows.

    Stored keys are unique, so an inner join adds no rows, and Spark may broadcast
    or split whichever side its size suggests.
    """
    return rows.join(stored.select(*KEY), KEY).groupBy("load").agg(F.count("*").alias("n_rows"))


def key_sharers(holders: DataFrame) -> DataFrame:
    """(load, sharers): bitmap of the loads that share a key with the load, itself included.

    Loads must be numbered below `MAX_LOADS`. Keys held by the same loads collapse
    into one set first, then each load's sets are united bit by bit, so copies of a
    file in any number never become pairs of rows.
    """
    sets = (
        holders.groupBy(*KEY)
        .agg(F.sort_array(F.collect_set("load")).alias("members"))
        .filter(F.size("members") > 1)
        .select("members")
        .distinct()
    )
    bitmaps = (
        sets.select("members", F.explode("members").alias("load"))
        .groupBy("members")
        .agg(F.bitmap_construct_agg("load").alias("bitmap"))
    )
    return (
        bitmaps.select(F.explode("members").alias("load"), "bitmap")
        .groupBy("load")
        .agg(F.bitmap_or_agg("bitmap").alias("sharers"))
    )


def refused_by_earlier(sharers: dict[int, bytes]) -> set[int]:
    """Loads that share a key with an accepted load before them.

    Goes through the loads in order, since a load only counts against later ones
    if it was accepted itself: at most `MAX_LOADS` bitmaps.
    """
    accepted, refused = 0, set()
    for load in sorted(sharers):
        if int.from_bytes(sharers[load], "little") & accepted:
            refused.add(load)
        else:
            accepted |= 1 << load
    return refused

"""Schemas of the tables that the index keeps."""

from __future__ import annotations

from pyspark.sql import types as T

ENTITY = T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType())])

NOTIFICATION = T.StructType(
    [
        T.StructField("event_name", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("received_at", T.TimestampNTZType()),
        T.StructField("seq", T.LongType()),
    ]
)

ROUTE = T.StructType(
    [
        T.StructField("parent", T.StringType()),
        T.StructField("feature_table", T.StringType()),
        T.StructField("timestamp_column", T.StringType()),
        T.StructField("created_timestamp_column", T.StringType()),
        T.StructField("entities", T.ArrayType(ENTITY)),
        T.StructField("n_candidates", T.LongType()),
    ]
)

JOBS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("started", T.TimestampNTZType()),
        T.StructField("ended", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("status_msg", T.StringType()),
        T.StructField("entity_names", T.ArrayType(T.StringType())),
        T.StructField("feature_table", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)

MALFORMED = T.StructType([T.StructField("text", T.StringType()), T.StructField("received_at", T.TimestampNTZType())])

# `file` is the normalised key.
REMOVALS = T.StructType([T.StructField("file", T.StringType()), T.StructField("seq", T.LongType())])

# Registry types that can be indexed, and the Spark type of their `id` column (fixed values).
ID_TYPES = {"INT64": "bigint", "BOOL": "boolean"}

# Longest feature table name (fixed value).
MAX_NAME_LENGTH = 255

# What makes an index row unique. The path is not part of it.
ROW_KEY = ["id", "feature_table", "event_timestamp", "created_timestamp"]

INDEX_COLUMNS = [*ROW_KEY, "path"]


def entity_schema(id_type: str) -> T.StructType:
    """Schema of an entity table whose ids have the Spark type `id_type`."""
    return T.StructType(
        [
            T.StructField("id", T.BooleanType() if id_type == "boolean" else T.LongType()),
            T.StructField("feature_table", T.StringType()),
            T.StructField("event_timestamp", T.TimestampNTZType()),
            T.StructField("created_timestamp", T.TimestampNTZType()),
            T.StructField("path", T.StringType()),
        ]
    )

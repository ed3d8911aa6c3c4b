"""Bucket notifications, one JSON object each: `EventName`, `Key`, maybe `Records`."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entidex.functions.keys import bucket_of
from entidex.functions.values import from_epoch_micros

MESSAGE = T.StructType(
    [
        T.StructField("EventName", T.StringType()),
        T.StructField("Key", T.StringType()),
        T.StructField("Records", T.ArrayType(T.StructType([T.StructField("eventTime", T.StringType())]))),
    ]
)

# Event names and file suffix of the subscription (fixed values).
CREATED = "s3:ObjectCreated:"
REMOVED = "s3:ObjectRemoved:"
SUFFIX = ".parquet"


def _parsed(messages: DataFrame, value: Column, arrived: Column) -> DataFrame:
    """Columns event_name, key, received_at, and of malformed messages their text.

    Broken JSON has neither name nor key.
    """
    message = F.from_json(value, MESSAGE)
    read = messages.select(message.alias("m"), value.alias("text"), arrived.alias("arrived"))
    sent = F.try_to_timestamp(F.get(F.col("m.Records"), F.lit(0))["eventTime"])
    name, key = F.col("m.EventName"), F.col("m.Key")
    return read.select(
        name.alias("event_name"),
        key.alias("key"),
        F.coalesce(from_epoch_micros(F.unix_micros(sent)), F.col("arrived")).alias("received_at"),
        F.when(name.isNull() | key.isNull(), F.col("text")).alias("text"),
    )


def _files(reader, path: str) -> DataFrame:
    """Lines of the files; blank ones are no messages."""
    lines = reader.text(path).filter(F.trim("value") != "")
    return _parsed(lines, F.col("value"), from_epoch_micros(F.unix_micros(F.col("_metadata.file_modification_time"))))


def read_notifications(spark: SparkSession, path: str) -> DataFrame:
    """Notifications in a folder of JSON files, one per line."""
    return _files(spark.read, path)


def stream_notifications(spark: SparkSession, path: str, max_files_per_trigger: int = 10_000) -> DataFrame:
    """The same as a stream."""
    return _files(spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger), path)


def parse_notifications(messages: DataFrame, value: str = "value", arrived: str = "timestamp") -> DataFrame:
    """Notifications in a text column of a message queue, such as Kafka's `value`.

    `arrived` is the queue's time stamp; it counts where the message has none.
    """
    zoned = F.col(arrived).cast("timestamp")
    return _parsed(messages, F.col(value).cast("string"), from_epoch_micros(F.unix_micros(zoned)))


def malformed(notifications: DataFrame) -> DataFrame:
    """Messages without an event name or a key: broken JSON or a missing field. Their `text` is kept."""
    return notifications.filter(F.col("event_name").isNull() | F.col("key").isNull())


def is_subscribed(event_name: Column, key: Column, bucket: str | None = None) -> Column:
    """Whether the bucket's subscription would send this event."""
    wanted = (event_name.startswith(CREATED) | event_name.startswith(REMOVED)) & key.endswith(SUFFIX)
    return wanted if bucket is None else wanted & (bucket_of(key) == bucket)


def is_removal(event_name: Column) -> Column:
    return event_name.startswith(REMOVED)


def subscribed(notifications: DataFrame, bucket: str | None = None) -> DataFrame:
    return notifications.filter(is_subscribed(F.col("event_name"), F.col("key"), bucket))


def created(notifications: DataFrame) -> DataFrame:
    """Events to ingest: well-formed ones that are no removal."""
    return notifications.filter(F.col("key").isNotNull() & ~is_removal(F.col("event_name")))


def removed(notifications: DataFrame) -> DataFrame:
    return notifications.filter(F.col("key").isNotNull() & is_removal(F.col("event_name")))


def sequenced(notifications: DataFrame, batch_id: int, scratch: str) -> DataFrame:
    """Adds `seq`, the arrival order: batch_id * 2^32 + rank by (received_at, key).

    The rank is counted per sorted partition and shifted by the sizes of the
    partitions before it, so no task sees all notifications. The tie breaker only
    spreads equal notifications, whose order does not matter.
    """
    order = ["received_at", "key", "tie"]
    spark = notifications.sparkSession
    ranged = f"{scratch}/ranged"
    (
        notifications.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .withColumn("slot", F.spark_partition_id())
        .write.mode("overwrite")
        .parquet(ranged)
    )
    rows = spark.read.parquet(ranged)
    # One number per sorted partition.
    sizes = {row.slot: row["count"] for row in rows.groupBy("slot").count().collect()}
    starts = zip(sorted(sizes), accumulate((sizes[slot] for slot in sorted(sizes)), initial=0))
    offsets = spark.createDataFrame(list(starts), "slot int, offset bigint")
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(*order)) + F.col("offset")
    return rows.join(offsets, "slot").select(
        "event_name", "key", "received_at", (F.lit(batch_id).cast("bigint") * F.lit(2**32) + rank).alias("seq")
    )

"""The events table as a stream of feature files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entidex.functions.values import from_epoch_micros, to_epoch_micros
from entidex.plans import inputs
from entidex.sources.notifications import stream_notifications
from entidex.sources.registry import Registry
from entidex.storage import scratch_root
from entidex.store import EntityIndex
from entidex.streaming.ingest import ingest_batch, start_ingest


def _kept(frame: DataFrame, path: str) -> DataFrame:
    """The frame, written and read again, so that what reads it several times computes it once."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def event_registry(events: DataFrame, flagged: str | None = None) -> Registry:
    """One source per event type and day; the event types are the feature tables.

    All have the entity `user`; with `flagged`, that one also has the entity `big`. The
    days are kept as a table: each batch reads the registry several times, the events are
    read once.
    """
    spark = events.sparkSession
    days = events.select("event_type", F.col("ts").cast("date").alias("day")).distinct().withColumn("day", F.col("day").cast("string"))
    days = _kept(days.withColumn("id", F.xxhash64("event_type", "day")), f"{scratch_root(spark)}/days")
    entities = F.when(F.col("event_type") == flagged, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    url = [F.lit('{"file_url": "s3a://lake/event_type='), "event_type", F.lit("/day="), "day", F.lit('/"}')]
    return Registry(
        data_sources=days.select(
            "id",
            F.concat(*url).alias("config"),
            F.lit("event_ts").alias("timestamp_column"),
            F.lit("created_ts").alias("created_timestamp_column"),
        ),
        feature_tables=days.select(
            "id",
            F.col("event_type").alias("name"),
            F.col("id").alias("batch_source_id"),
            F.lit("p").alias("project_name"),
            F.lit(False).alias("is_deleted"),
        ),
        feature_tables_entities_v2=days.select(
            F.col("id").alias("feature_table_id"), F.explode(entities).alias("entity_v2_id")
        ),
        entities_v2=spark.createDataFrame([(1, "user", "INT64"), (2, "big", "bool")], "id int, name string, type string"),
        projects=spark.range(1).select(F.lit("p").alias("name"), F.lit(False).alias("archived")),
    )


def feature_rows(events: DataFrame) -> DataFrame:
    """Rows of the feature files, all regular."""
    day = F.col("ts").cast("date")
    return events.select(
        F.col("user_id").alias("user"),
        to_epoch_micros(F.col("ts")).alias("event_ts"),
        to_epoch_micros(day.cast("timestamp_ntz")).alias("created_ts"),
        "value",
        "event_type",
        day.cast("string").alias("day"),
    )


def irregular_rows(events: DataFrame) -> list[DataFrame]:
    """The same per event type, each in a way of its own.

    Clicks above 100 come twice; errors below 1 have no user; purchases lack the
    creation time; sign-ups have wall times and a flag; views are regular.
    """
    rows = feature_rows(events)
    of = {kind: rows.filter(F.col("event_type") == kind) for kind in ("click", "error", "purchase", "signup", "view")}
    wall_time = from_epoch_micros(F.col("event_ts"))
    return [
        of["click"].unionByName(of["click"].filter(F.col("value") > 100)),
        of["error"].withColumn("user", F.when(F.col("value") >= 1, F.col("user"))),
        of["purchase"].drop("created_ts"),
        of["signup"].withColumn("event_ts", wall_time).withColumn("big", F.col("value") > 50),
        of["view"],
    ]


def write_files(rows: DataFrame, root: str) -> None:
    """Writes one feature file per event type and day to the bucket `lake`."""
    files = rows.repartition("event_type", "day").write.partitionBy("event_type", "day")
    files.mode("append").parquet(f"{root}/lake")


def written_files(spark: SparkSession, root: str) -> DataFrame:
    """Event type, day and key of all files."""
    files = spark.read.parquet(f"{root}/lake").select("event_type", "day", F.col("_metadata.file_path").alias("uri"))
    # The names need no escapes, so a URI ends in the key.
    keyed = files.distinct().select("event_type", "day", F.regexp_replace("uri", "^.*/lake/", "lake/").alias("key"))
    return _kept(keyed, f"{root}/files")


def write_notifications(files: DataFrame, folder: str, event_name: str = "s3:ObjectCreated:Put") -> None:
    """Appends a notification per file."""
    sent = F.struct(F.concat("day", F.lit("T00:00:00Z")).alias("eventTime"))
    files.select(
        F.lit(event_name).alias("EventName"), F.col("key").alias("Key"), F.array(sent).alias("Records")
    ).write.mode("append").json(folder)


def _stream(index: EntityIndex, registry: Registry, files: DataFrame, root: str, removed: bool = False, **options) -> None:
    write_notifications(files, f"{root}/notifications", *(["s3:ObjectRemoved:Delete"] if removed else []))
    start_ingest(
        stream_notifications(index.spark, f"{root}/notifications"),
        index,
        lambda: registry,
        f"{root}/data/",
        f"{root}/checkpoint",
        trigger={"availableNow": True},
        bucket="lake",
        **options,
    ).awaitTermination()


def streamed_index(spark: SparkSession, sf_dir: str) -> EntityIndex:
    """Streams all event files into a new index, then the files of one type once more."""
    root = scratch_root(spark)
    events = inputs.table(spark, sf_dir, "events")
    write_files(feature_rows(events), f"{root}/data")
    files = written_files(spark, f"{root}/data")
    index = EntityIndex(spark, f"{root}/index")
    registry = event_registry(events)
    for arrived in (files, files.filter(F.col("event_type") == "click")):
        _stream(index, registry, arrived, root)
    return index


def irregular_index(spark: SparkSession, sf_dir: str) -> EntityIndex:
    """Streams irregular files into a new index."""
    root = scratch_root(spark)
    events = inputs.table(spark, sf_dir, "events")
    for rows in irregular_rows(events):
        write_files(rows, f"{root}/data")
    index = EntityIndex(spark, f"{root}/index")
    _stream(index, event_registry(events, flagged="signup"), written_files(spark, f"{root}/data"), root)
    return index


def late_index(spark: SparkSession, sf_dir: str) -> EntityIndex:
    """Streams the files of the later days first, then those of the earlier days."""
    root = scratch_root(spark)
    events = inputs.table(spark, sf_dir, "events")
    write_files(feature_rows(events), f"{root}/data")
    files = written_files(spark, f"{root}/data")
    index = EntityIndex(spark, f"{root}/index")
    registry = event_registry(events)
    for arrived in (files.filter("day >= '2024-01-16'"), files.filter("day < '2024-01-16'")):
        _stream(index, registry, arrived, root)
    return index


def removals_index(spark: SparkSession, sf_dir: str) -> EntityIndex:
    """Streams all files, then the removal of all clicks, then the later clicks again."""
    root = scratch_root(spark)
    events = inputs.table(spark, sf_dir, "events")
    write_files(feature_rows(events), f"{root}/data")
    files = written_files(spark, f"{root}/data")
    clicks = files.filter("event_type = 'click'")
    index = EntityIndex(spark, f"{root}/index")
    registry = event_registry(events)
    for arrived, removed in ((files, False), (clicks, True), (clicks.filter("day >= '2024-01-16'"), False)):
        _stream(index, registry, arrived, root, removed, removals=True)
    return index


def state_index(spark: SparkSession, sf_dir: str) -> EntityIndex:
    """Keeps the latest state over late files, the removal of all clicks with the return of some, and a replay of that."""
    root = scratch_root(spark)
    events = inputs.table(spark, sf_dir, "events")
    write_files(feature_rows(events), f"{root}/data")
    files = written_files(spark, f"{root}/data")
    index, registry = EntityIndex(spark, f"{root}/index"), event_registry(events)

    def told(files: DataFrame, kind: str, time: str) -> DataFrame:
        return files.select(F.lit(f"s3:Object{kind}").alias("event_name"), "key", F.lit(time).cast("timestamp_ntz").alias("received_at"))

    late = F.col("day") < "2024-01-16"
    clicks = files.filter("event_type = 'click'")
    returned = told(clicks, "Removed:Delete", "2024-02-03").unionByName(told(clicks.filter(~late), "Created:Put", "2024-02-04"))
    batches = [told(files.filter(~late), "Created:Put", "2024-02-01"), told(files.filter(late), "Created:Put", "2024-02-02"), returned, returned]
    for batch_id, events_of in zip((0, 1, 2, 2), batches):
        ingest_batch(events_of, batch_id, index, registry, f"{root}/data/", bucket="lake", removals=True, keep_latest=True)
    return index


def clocked_index(spark: SparkSession, sf_dir: str, clock, **options) -> EntityIndex:
    """One batch of the files of one type, loaded by the given clock."""
    root = scratch_root(spark)
    events = inputs.table(spark, sf_dir, "events")
    write_files(feature_rows(events).filter("event_type = 'signup'"), f"{root}/data")
    index = EntityIndex(spark, f"{root}/index")
    told = written_files(spark, f"{root}/data").select(
        F.lit("s3:ObjectCreated:Put").alias("event_name"), "key", F.lit("2024-02-01").cast("timestamp_ntz").alias("received_at")
    )
    ingest_batch(told, 0, index, event_registry(events), f"{root}/data/", bucket="lake", clock=clock, **options)
    return index


def malformed_index(spark: SparkSession, sf_dir: str) -> EntityIndex:
    """Streams files, with broken and incomplete messages among their notifications."""
    root = scratch_root(spark)
    events = inputs.table(spark, sf_dir, "events")
    write_files(feature_rows(events), f"{root}/data")
    number = F.col("event_id").cast("string")
    broken = F.when(F.col("value") < 2, F.concat(F.lit("{broken "), number)).otherwise(
        F.concat(F.lit('{"EventName": "s3:ObjectCreated:Put", "size": '), number, F.lit("}"))
    )
    events.filter("value < 4").select(broken.alias("value")).write.mode("append").text(f"{root}/notifications")
    index = EntityIndex(spark, f"{root}/index")
    _stream(index, event_registry(events), written_files(spark, f"{root}/data").filter("event_type = 'view'"), root)
    return index


#: Feature tables with the same ids and times, their factor on the value, and how their
#: files hold the times.
SHARED = {"int96": (1, "INT96"), "micros": (2, None), "millis": (3, "TIMESTAMP_MILLIS")}


def shared_files(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Writes the events as files of the `SHARED` feature tables; returns the root and their index."""
    root = scratch_root(spark)
    day = F.date_trunc("day", F.col("ts"))
    rows = inputs.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("user"), F.date_trunc("second", F.col("ts")).alias("event_ts"), day.alias("created_ts"), "value"
    )
    setting = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(setting)
    for name, (factor, kind) in SHARED.items():
        made = rows.withColumn("value", F.col("value") * factor).withColumn("day", F.col("created_ts").cast("date").cast("string"))
        zoned = {c: F.timestamp_micros(to_epoch_micros(F.col(c).cast("timestamp_ntz"))) for c in ("event_ts", "created_ts")}
        made = made.withColumns({c: F.unix_micros(t) if kind is None else t for c, t in zoned.items()})
        try:
            spark.conf.set(setting, kind or before)
            made.withColumn("table", F.lit(name)).repartition("day").write.partitionBy("table", "day").mode("append").parquet(f"{root}/data/lake")
        finally:
            spark.conf.set(setting, before)
    files = spark.read.schema("value double").parquet(f"{root}/data/lake").select(F.col("_metadata.file_path").alias("uri")).distinct()
    keys = files.select(F.regexp_replace("uri", "^.*/lake/", "lake/").alias("path"))
    keys = keys.select("path", F.regexp_extract("path", "table=([^/]*)/", 1).alias("feature_table"), F.regexp_extract("path", "day=([^/]*)/", 1).alias("day"))
    times = [F.col(c).cast("timestamp_ntz").alias(n) for c, n in (("event_ts", "event_timestamp"), ("created_ts", "created_timestamp"))]
    index = rows.select(F.col("user").alias("id"), *times, F.col("created_ts").cast("date").cast("string").alias("day")).join(keys, "day")
    return f"{root}/data/", index.select("id", "feature_table", "event_timestamp", "created_timestamp", "path")

"""The index at rest: plain Parquet below one folder.

    entity_<name>/event_month=<yyyymm>/batch_id=<n>/   index rows
    jobs/batch_id=<n>/                                 job log
    malformed/batch_id=<n>/                            messages that are no notification
    removals/batch_id=<n>/                             removed files, if they are kept
    files_<name>/event_month=<yyyymm>/batch_id=<n>/    bounds of the index files, if they are kept
    latest_<name>/of=<buckets>/bucket=<b>/whole=<0|1>/batch_id=<n>/    latest rows, if they are kept
    ids_<name>/batch_id=<n>/                           sets of ids, if they are kept
    definitions/batch_id=<n>/                          entity name and id type, as first seen

Index rows are partitioned by event month, so span lookups and key checks list
and open only the months they need, however old the index is. Everything a
micro-batch writes carries its batch id, so a replay starts by deleting that.
"""

from __future__ import annotations

from collections.abc import Container
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entidex import storage
from entidex.functions.keys import normalized
from entidex.id_files import IdFiles, among
from entidex.latest_state import LatestState
from entidex.operators.latest import latest
from entidex.operators.lookups import in_span, month_of, rows_for_ids
from entidex.schemas import INDEX_COLUMNS, JOBS, MALFORMED, REMOVALS, entity_schema

_PARTITIONS = T.StructType([T.StructField("event_month", T.IntegerType()), T.StructField("batch_id", T.LongType())])
_BATCH = T.StructType([T.StructField("batch_id", T.LongType())])
_TYPES = T.StructType([T.StructField("entity", T.StringType()), T.StructField("id_type", T.StringType())])


# What a batch may write.
_WRITTEN = ("entity_*/event_month=*", "jobs", "definitions", "malformed", "removals", "latest_*/of=*/bucket=*/whole=*", "files_*/event_month=*", "ids_*")


def _escaped(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _both(a: T.StructType, b: T.StructType) -> T.StructType:
    return T.StructType([*a.fields, *b.fields])


#: Most rows of an index file.
FILE_ROWS = 10_000_000


class EntityIndex:
    def __init__(self, spark: SparkSession, root: str, file_rows: int = FILE_ROWS):
        self.spark = spark
        self.root = storage.qualified(spark, root)
        self.file_rows = file_rows

    def _table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        if not storage.exists(self.spark, self._table(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(storage.literal_path(self._table(name)))

    # definitions

    def entity_types(self) -> dict[str, str]:
        """Id type of each entity table; bounded by the registry."""
        return {r.entity: r.id_type for r in self._read("definitions", _both(_TYPES, _BATCH)).collect()}

    def define(self, id_types: dict[str, str], batch_id: int) -> dict[str, str]:
        """Defines the entity tables that do not exist yet; returns the types of all."""
        known = self.entity_types()
        new = {name: kind for name, kind in id_types.items() if name not in known}
        if new:
            self.spark.createDataFrame(list(new.items()), _TYPES).coalesce(1).write.mode("append").parquet(
                f"{self._table('definitions')}/batch_id={batch_id}"
            )
        return known | new

    # reads

    def entity(self, name: str, months: Container[int] | None = None, id_type: str | None = None) -> DataFrame:
        """Index rows of an entity, with the partition columns event_month and batch_id.

        With `months` (such as 202401), only the folders of those months are listed at all.
        """
        id_type = id_type or self.entity_types().get(name)
        if id_type is None:
            raise ValueError(f"no entity table: {name}")
        schema = _both(entity_schema(id_type), _PARTITIONS)
        if months is None:
            return self._read(f"entity_{name}", schema)
        table = self._table(f"entity_{name}")
        folders = storage.matching(self.spark, f"{storage.literal_path(table)}/event_month=*")
        wanted = [f for f in folders if int(f.rsplit("=", 1)[1]) in months]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", table)
        return reader.parquet(*map(storage.literal_path, wanted))

    def span(self, name: str, start: datetime, end: datetime) -> DataFrame:
        """Index rows of an entity whose event time lies in the span, both ends included."""
        first, last = (t.year * 100 + t.month for t in (start, end))
        return in_span(self.entity(name, range(first, last + 1)), start, end)

    def batches(self, name: str) -> set[int]:
        """Numbers of the batches that an entity has rows of."""
        table = storage.literal_path(self._table(f"entity_{name}"))
        return {_number(path) for path in storage.matching(self.spark, f"{table}/event_month=*/batch_id=*")}

    def batch_rows(self, name: str, batches: Container[int]) -> DataFrame:
        """Index rows of some batches; only their folders are listed."""
        found = storage.matching(self.spark, f"{storage.literal_path(self._table(f'entity_{name}'))}/event_month=*/batch_id=*")
        return self.read_folders(name, [f for f in found if _number(f) in batches])

    def read_folders(self, name: str, paths: list[str], id_type: str | None = None) -> DataFrame:
        """Index rows of some folders and files of an entity."""
        schema = _both(entity_schema(id_type or self.entity_types()[name]), _PARTITIONS)
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self._table(f"entity_{name}"))
        return reader.parquet(*map(storage.literal_path, paths))

    def rows_for_ids(self, name: str, ids: DataFrame, months: Container[int] | None = None) -> DataFrame:
        """Index rows of the ids (column id), of some months if given.

        Opens only files that can hold one of the ids, as far as `files_<name>` describes
        them. Few ids go into the scan as well, where row groups without them are skipped.
        """
        rows = IdFiles(self, name).rows(ids, months)
        few = among(ids)
        return rows_for_ids(rows if few is None else rows.filter(few), ids)

    def paths_for_ids(self, name: str, ids: DataFrame) -> DataFrame:
        """Feature files that hold any of the ids."""
        return self.rows_for_ids(name, ids).select("path").distinct()

    def latest(self, name: str) -> DataFrame:
        """Latest row per id of an entity, from all its rows."""
        return latest(self.entity(name))

    def latest_from_state(self, name: str) -> DataFrame:
        """The same (of live rows alone) from the state that ingest keeps with `keep_latest`: one row per id
        and a few runs are read, however long the history is."""
        state = LatestState(self, name)
        if not state.exists:
            raise ValueError(f"no latest state is kept of {name}")
        return state.read()

    def jobs(self) -> DataFrame:
        return self._read("jobs", _both(JOBS, _BATCH))

    def malformed(self) -> DataFrame:
        """Messages that could not be read: their text and time of arrival."""
        return self._read("malformed", _both(MALFORMED, _BATCH))

    def removals(self) -> DataFrame:
        """Removed files, as far as ingest was told to keep them."""
        return self._read("removals", _both(REMOVALS, _BATCH))

    def live(self, rows: DataFrame) -> DataFrame:
        """Index rows (with batch_id) whose file was not removed after they were loaded.

        A batch never loads a file that it then sees removed, so batches tell the order.
        """
        last = self.removals().groupBy("file").agg(F.max("batch_id").alias("removed_in"))
        marked = rows.withColumn("file", normalized(F.col("path"))).join(last, "file", "left")
        return marked.filter(F.coalesce("removed_in", F.lit(-1)) <= F.col("batch_id")).select(*rows.columns)

    def create_views(self) -> None:
        """Temporary views `jobs` and, per entity, `entity_<name>` and `max_entity_<name>`."""
        self.jobs().drop("batch_id").createOrReplaceTempView("jobs")
        for name in self.entity_types():
            self.entity(name).select(*INDEX_COLUMNS).createOrReplaceTempView(_escaped(f"entity_{name}"))
            self.latest(name).createOrReplaceTempView(_escaped(f"max_entity_{name}"))

    def publish(self, database: str = "entity_lookup") -> None:
        """Makes the index a database of the session's catalog, with the same names as `create_views`.

        Tables and views that exist stay as they are; tables learn their new
        partitions. Call it again after new batches. Catalogs take names of letters,
        digits and underscores only.
        """
        sql = self.spark.sql
        in_database = lambda name: f"{_escaped(database)}.{_escaped(name)}"
        sql(f"CREATE DATABASE IF NOT EXISTS {_escaped(database)} LOCATION {_literal(self.root)}")
        tables = {f"entity_{name}": entity_schema(kind) for name, kind in self.entity_types().items()}
        for name, schema in {"jobs": JOBS, **tables}.items():
            partitions = _BATCH if name == "jobs" else _PARTITIONS
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _both(schema, partitions).fields)
            sql(
                f"CREATE TABLE IF NOT EXISTS {in_database(name)} ({columns}) USING parquet "
                f"PARTITIONED BY ({', '.join(partitions.fieldNames())}) LOCATION {_literal(self._table(name))}"
            )
            if storage.exists(self.spark, self._table(name)):
                sql(f"MSCK REPAIR TABLE {in_database(name)}")
        for name in tables:
            sql(
                f"""CREATE VIEW IF NOT EXISTS {in_database(f"max_{name}")} AS
                SELECT id, load.feature_table, load.event_timestamp, load.created_timestamp, load.path, 1L AS rk
                FROM (SELECT id, max(struct(created_timestamp, path IS NULL, path, feature_table, event_timestamp)) AS load
                      FROM {in_database(name)} GROUP BY id)"""
            )

    # writes

    def last_batch(self) -> int | None:
        """Highest batch id of any table, or None in a new index."""
        found = [p for t in _WRITTEN for p in storage.matching(self.spark, f"{self.root}/{t}/batch_id=*")]
        return max((int(path.rsplit("=", 1)[1]) for path in found), default=None)

    def clear_batch(self, batch_id: int) -> None:
        """Deletes what an earlier attempt at this batch wrote."""
        for pattern in _WRITTEN:
            for path in storage.matching(self.spark, f"{self.root}/{pattern}/batch_id={batch_id}"):
                storage.delete(self.spark, path)

    def append_entity(self, name: str, rows: DataFrame, batch_id: int) -> None:
        """Appends canonical rows.

        Each month gets few files of a good size, mostly of one feature table and of a range
        of ids each; what is too big for one file is split, also an id of very many rows.
        Sorted ids and Bloom filters let a lookup of ids skip pages and row groups.
        """
        ranged = rows.select(*INDEX_COLUMNS, *_partition_values(batch_id)).repartitionByRange("event_month", "feature_table", "id", "event_timestamp")
        self._write_rows(ranged.sortWithinPartitions("event_month", "batch_id", "id"), self._table(f"entity_{name}"), "event_month", "batch_id")

    def _write_rows(self, rows: DataFrame, path: str, *partitions: str) -> None:
        writer = rows.write.mode("append").option("maxRecordsPerFile", self.file_rows)
        if rows.schema["id"].dataType != T.BooleanType():
            # Sized by the ids that there are; those of a dictionary are looked up there.
            writer = writer.option("parquet.bloom.filter.enabled#id", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.partitionBy(*partitions).parquet(path)

    def append_jobs(self, jobs: DataFrame, batch_id: int) -> None:
        """Appends the job rows of one part, at most `max_files`, as one file."""
        jobs.select(*JOBS.fieldNames()).coalesce(1).write.mode("append").parquet(f"{self._table('jobs')}/batch_id={batch_id}")

    def append_malformed(self, messages: DataFrame, batch_id: int) -> None:
        """Appends messages that are no notification, with their text."""
        messages.select(*MALFORMED.fieldNames()).write.mode("append").parquet(f"{self._table('malformed')}/batch_id={batch_id}")

    def append_removals(self, removed: DataFrame, batch_id: int) -> None:
        removed.select(*REMOVALS.fieldNames()).hint("rebalance").write.mode("append").parquet(f"{self._table('removals')}/batch_id={batch_id}")

    def compact(self, before_batch: int, least: int = 2) -> None:
        """Merges the folders of closed batches, those below `before_batch`, month by month.

        Only batches that no stream will run again are closed. Months with fewer than
        `least` such folders stay as they are. Rows of removed files are dropped for good.
        Merged rows are written aside, then take the place of the old folders under the
        highest merged batch id. A run that broke off is finished by the next one. Run it
        while nothing reads or writes the index: between delete and rename, rows are missing.
        """
        aside = f"{self.root}/_compact"
        self._finish_compaction(aside)
        for name, id_type in self.entity_types().items():
            table = self._table(f"entity_{name}")
            for month in storage.matching(self.spark, f"{storage.literal_path(table)}/event_month=*"):
                folders = storage.matching(self.spark, f"{storage.literal_path(month)}/batch_id=*")
                closed = [f for f in folders if _number(f) < before_batch]
                if len(closed) < least:
                    continue
                rows = self.live(self.read_folders(name, closed, id_type)).select(*INDEX_COLUMNS)
                to = f"{aside}/entity_{name}/{month.rsplit('/', 1)[1]}/batch_id={max(map(_number, closed))}"
                ranged = rows.repartitionByRange("feature_table", "id", "event_timestamp").sortWithinPartitions("id")
                self._write_rows(ranged, to)
        self._finish_compaction(aside)

    def _finish_compaction(self, aside: str) -> None:
        """Puts what was written whole in its place; deletes what was not."""
        for path in storage.matching(self.spark, f"{storage.literal_path(aside)}/entity_*/event_month=*/batch_id=*"):
            if storage.exists(self.spark, f"{path}/_SUCCESS"):
                month = path.rsplit("/", 1)[0]
                place = self.root + month.split("/_compact", 1)[1]
                files = IdFiles(self, place.rsplit("/", 2)[1].removeprefix("entity_"))
                files.forget(_number(place), _number(path))
                for old in storage.matching(self.spark, f"{storage.literal_path(place)}/batch_id=*"):
                    if _number(old) <= _number(path):
                        storage.delete(self.spark, old)
                storage.move(self.spark, path, f"{place}/batch_id={_number(path)}")
                if storage.exists(self.spark, files.root):
                    files.describe(_number(path), {_number(place)})
        storage.delete(self.spark, aside)


def _number(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1])


def _partition_values(batch_id: int) -> list[Column]:
    return [
        month_of(F.col("event_timestamp")).alias("event_month"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    ]

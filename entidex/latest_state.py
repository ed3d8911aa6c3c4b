"""The latest row per id, kept up to date batch by batch.

    latest_<entity>/of=<buckets>/bucket=<b>/whole=<0|1>/batch_id=<n>/

Ids are dealt to buckets by hash. A batch adds one *run* (whole=0) to each bucket it has ids
of: its own latest row per id. A bucket with `most_runs` runs is merged into one *whole*
version (whole=1) instead, which stands for all before it. What a bucket holds is thus its
newest whole version and the runs after it; the latest of these is the latest of all.

A removed file can take away rows that were the latest. Their ids are computed anew from
the index, and their buckets get a whole version.

Versions carry their batch's number, and what a whole version replaced stays until a later
batch has another one. So the replay of a batch deletes its versions and finds those before.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entidex import storage
from entidex.functions.keys import normalized
from entidex.operators.extract import union_all
from entidex.schemas import INDEX_COLUMNS, entity_schema

#: Buckets of a new state, and runs of a bucket that are merged by the next batch.
BUCKETS, MOST_RUNS = 16, 8

_PLACE = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("whole", T.IntegerType()), T.StructField("batch_id", T.LongType())])


def newest_first() -> Column:
    """Rows as structs whose greatest is the latest; of equal ones, that of the later batch."""
    return F.struct(
        "created_timestamp", F.col("path").isNull().alias("path_is_null"), "path", "feature_table", "event_timestamp", "loaded_in"
    )


def latest_of(rows: DataFrame) -> DataFrame:
    """One row per id of rows with `loaded_in`. Combines before it shuffles."""
    best = rows.groupBy("id").agg(F.max(newest_first()).alias("load"))
    return best.select("id", *(f"load.{c}" for c in (*INDEX_COLUMNS[1:], "loaded_in")))


class LatestState:
    """The state of one entity. `index`: an `EntityIndex`."""

    def __init__(self, index, entity: str, buckets: int = BUCKETS, most_runs: int = MOST_RUNS):
        self.index, self.entity, self.spark = index, entity, index.spark
        self.most_runs = most_runs
        self.table = f"{index.root}/latest_{entity}"
        found = storage.matching(self.spark, f"{storage.literal_path(self.table)}/of=*")
        self.exists = bool(found)
        self.buckets = int(found[0].rsplit("=", 1)[1]) if found else buckets
        self.root = f"{self.table}/of={self.buckets}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _schema(self) -> T.StructType:
        id_type = self.index.entity_types()[self.entity]
        return T.StructType([*entity_schema(id_type).fields, T.StructField("loaded_in", T.LongType())])

    def versions(self, before: int | None = None) -> dict[int, list[tuple[int, int]]]:
        """(batch, whole) of all versions of each bucket, oldest first; of batches before one, if given."""
        held = defaultdict(list)
        for path in storage.matching(self.spark, f"{storage.literal_path(self.root)}/bucket=*/whole=*/batch_id=*"):
            bucket, whole, batch = (int(part.rsplit("=", 1)[1]) for part in path.rsplit("/", 3)[1:])
            if before is None or batch < before:
                held[bucket].append((batch, whole))
        return {bucket: sorted(found) for bucket, found in held.items()}

    @staticmethod
    def valid(versions: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Those that make up a bucket: the newest whole version and the runs after it."""
        last = max((batch for batch, whole in versions if whole), default=-1)
        return [(batch, whole) for batch, whole in versions if batch > last or (whole and batch == last)]

    def _read(self, versions: dict[int, list[tuple[int, int]]]) -> DataFrame:
        paths = [f"{self.root}/bucket={b}/whole={whole}/batch_id={batch}" for b, found in sorted(versions.items()) for batch, whole in self.valid(found)]
        schema = T.StructType([*self._schema().fields, *_PLACE.fields])
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.root)
        # A whole version of an empty bucket is one row without an id.
        return reader.parquet(*map(storage.literal_path, paths)).filter(F.col("id").isNotNull())

    def read(self) -> DataFrame:
        """The latest row per id, as `operators.latest.latest` of all (live) rows gives it."""
        return latest_of(self._read(self.versions())).select(*INDEX_COLUMNS, F.lit(1).cast("bigint").alias("rk"))

    def merge(self, batch_id: int, scratch: str) -> None:
        """Takes in what came to the index since the last version before the batch, up to the batch.

        That is the batch alone, unless some were not merged. Of the state, the buckets alone
        are read that have new ids in full buckets or lost their latest rows; to find the
        latter, the paths of all buckets are read if files were removed.
        """
        before = self.versions(before=batch_id)
        through = max((batch for found in before.values() for batch, _ in found), default=-1)
        new = {b for b in self.index.batches(self.entity) if through < b <= batch_id}
        lost = self._lost(before, through, batch_id, scratch)
        if not new and lost is None:
            return
        arrived = self.index.live(self.index.batch_rows(self.entity, new)).withColumn("loaded_in", F.col("batch_id"))
        fresh = self._staged(latest_of(arrived), f"{scratch}/latest-{self.entity}")
        touched = {r.bucket for r in fresh.select("bucket").distinct().collect()}
        anew = set() if lost is None else {r.bucket for r in lost.select("bucket").distinct().collect()}
        full = {b for b in touched if sum(1 for _, whole in self.valid(before.get(b, [])) if not whole) >= self.most_runs}
        merged = sorted(anew | full)
        parts = [fresh.filter(~F.col("bucket").isin(merged)).withColumn("whole", F.lit(0))]
        if merged:
            kept = self._read({b: before[b] for b in merged if b in before}).drop(*_PLACE.names)
            rows = kept.unionByName(fresh.filter(F.col("bucket").isin(merged)).drop("bucket"))
            if anew:
                # The latest row of an id decides whether it is lost; its older rows in the state may be too.
                history = self.index.live(self.index.entity(self.entity).filter(F.col("batch_id") <= batch_id))
                again = history.join(lost.select("id"), "id", "left_semi").withColumn("loaded_in", F.col("batch_id"))
                rows = rows.join(lost.select("id"), "id", "left_anti").unionByName(again.select(*rows.columns))
            parts.append(latest_of(rows).withColumn("whole", F.lit(1)))
        self._write(union_all([p.select(*self._schema().names, "whole") for p in parts]), batch_id, merged)
        self._forget(before)

    def _staged(self, rows: DataFrame, path: str) -> DataFrame:
        made = rows.select("*", self._bucket())
        made.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(made.schema).parquet(path)

    def _lost(self, before: dict, through: int, batch_id: int, scratch: str) -> DataFrame | None:
        """Ids (with their bucket) whose latest row so far is of a file removed since it was loaded; None without any."""
        removals = self.index.removals().filter(F.col("batch_id").between(through + 1, batch_id))
        gone = removals.groupBy("file").agg(F.max("batch_id").alias("removed_in"))
        if not before or gone.isEmpty():
            return None
        rows = latest_of(self._read(before)).withColumn("file", normalized(F.col("path"))).join(gone, "file")
        lost = self._staged(rows.filter("loaded_in < removed_in").select("id"), f"{scratch}/lost-{self.entity}")
        return None if lost.isEmpty() else lost

    def _write(self, rows: DataFrame, batch_id: int, whole) -> None:
        """Appends versions; buckets in `whole` get one even where no row is left."""
        schema = T.StructType([*self._schema().fields, *_PLACE.fields])
        empty = self.spark.createDataFrame([(*[None] * 6, b, 1, batch_id) for b in sorted(whole)], schema)
        placed = rows.select(*self._schema().names, self._bucket(), "whole", F.lit(batch_id).cast("bigint").alias("batch_id"))
        placed.unionByName(empty).hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "whole", "id").write.mode("append").partitionBy(
            *_PLACE.names
        ).parquet(self.root)

    def _forget(self, before: dict[int, list[tuple[int, int]]]) -> None:
        """Deletes what whole versions of earlier batches replaced; no replay needs it any more."""
        for bucket, versions in before.items():
            for batch, whole in set(versions) - set(self.valid(versions)):
                storage.delete(self.spark, f"{self.root}/bucket={bucket}/whole={whole}/batch_id={batch}")

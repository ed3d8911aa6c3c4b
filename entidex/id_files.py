"""Which index files can hold which ids.

    files_<entity>/event_month=<yyyymm>/batch_id=<n>/

One row per index file: its name, number of rows, and bounds of its ids and feature tables.
Files are written from ranges of ids, so a file's bounds are narrow where a month is large.
A lookup first finds the files whose bounds hold one of its ids, then opens only these;
inside of them, Bloom filters and sorted ids skip row groups. Folders that are not described
(yet) are read whole, so a lookup never misses rows.
"""

from __future__ import annotations

from collections.abc import Container

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entidex import storage

#: Most files that a lookup names one by one, and most ids that it sends into the scan.
MOST_FILES, MOST_SENT = 20_000, 200
#: Ids of one IN that Spark hands to Parquet as they are (`parquet.pushdown.inFilterThreshold`).
SENT_AT_ONCE = 10
#: Ranges that ids are dealt to when they are matched with bounds.
RANGES = 64

FILES = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        *(T.StructField(c, T.LongType()) for c in ("min_id", "max_id")),
        *(T.StructField(c, T.StringType()) for c in ("min_table", "max_table")),
        T.StructField("event_month", T.IntegerType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def described(rows: DataFrame) -> DataFrame:
    """Bounds of each file of a scan of index rows; only ids and feature tables are read."""
    number = F.col("id").cast("bigint")
    file = F.regexp_extract(F.col("_metadata.file_name"), "[^/]*$", 0).alias("file")
    read = rows.select("event_month", "batch_id", file, number.alias("id"), "feature_table")
    return read.groupBy("event_month", "batch_id", "file").agg(
        F.count("*").alias("n_rows"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
        F.min("feature_table").alias("min_table"),
        F.max("feature_table").alias("max_table"),
    )


def next_ids(starts: DataFrame, ids: DataFrame) -> DataFrame:
    """(min_id, next_id): per distinct `min_id` the least id that is not below it, null without any.

    Ids are cut into ranges of about equal size; in each, starts and ids are sorted together
    and the last id seen from above is the next. Beyond its range, a start's next id is the
    least of the next ranges, one number for each of `RANGES`.
    """
    values = ids.select(F.col("id").cast("bigint").alias("value")).filter("value is not null").distinct()
    cuts = sorted(set(values.approxQuantile("value", [i / RANGES for i in range(1, RANGES)], 0.01)))
    bounds = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<double>")
    in_range = F.size(F.filter(bounds, lambda c: c <= F.col("value"))).alias("range")
    held = values.select("value", in_range, F.lit(True).alias("known"))
    asked = starts.select(F.col("min_id").alias("value")).distinct().select("value", in_range, F.lit(False).alias("known"))
    least = {r["range"]: r["value"] for r in held.groupBy("range").agg(F.min("value").alias("value")).collect()}
    after = [min((v for k, v in least.items() if k > i), default=None) for i in range(len(cuts) + 1)]
    beyond = F.get(F.array(*[F.lit(v).cast("bigint") for v in after]), F.col("range"))
    from_above = Window.partitionBy("range").orderBy(F.desc("value"), F.desc("known")).rowsBetween(Window.unboundedPreceding, 0)
    here = F.min(F.when(F.col("known"), F.col("value"))).over(from_above)
    both = held.unionByName(asked).select("value", "known", F.coalesce(here, beyond).alias("next_id"))
    return both.filter(~F.col("known")).select(F.col("value").alias("min_id"), "next_id")


def files_with(files: DataFrame, ids: DataFrame) -> DataFrame:
    """Those files (min_id, max_id) whose bounds hold at least one of the ids."""
    return files.join(next_ids(files, ids), "min_id").filter(F.col("next_id") <= F.col("max_id")).drop("next_id")


def among(ids: DataFrame, column: str = "id") -> Column | None:
    """A condition that Parquet's row groups are tested with, if the ids are few."""
    few = [r[0] for r in ids.select("id").filter("id is not null").distinct().limit(MOST_SENT + 1).collect()]
    if len(few) > MOST_SENT:
        return None
    condition = F.lit(False)
    for start in range(0, len(few), SENT_AT_ONCE):
        condition = condition | F.col(column).isin(few[start : start + SENT_AT_ONCE])
    return condition


class IdFiles:
    """The files of one entity. `index`: an `EntityIndex`."""

    def __init__(self, index, entity: str):
        self.index, self.entity, self.spark = index, entity, index.spark
        self.root = f"{index.root}/files_{entity}"
        self.rows_root = f"{index.root}/entity_{entity}"

    def kept(self) -> bool:
        return storage.exists(self.spark, self.root)

    def _folders(self, root: str, months: Container[int] | None, batch: str = "*") -> dict[tuple[int, int], str]:
        found = storage.matching(self.spark, f"{storage.literal_path(root)}/event_month=*/batch_id={batch}")
        numbered = {tuple(int(part.rsplit("=", 1)[1]) for part in f.rsplit("/", 2)[1:]): f for f in found}
        return {at: f for at, f in numbered.items() if months is None or at[0] in months}

    def describe(self, batch_id: int, months: Container[int] | None = None) -> None:
        """Describes the files that a batch wrote, anew if it was done before."""
        for old in self._folders(self.root, months, str(batch_id)).values():
            storage.delete(self.spark, old)
        folders = self._folders(self.rows_root, months, str(batch_id))
        if folders:
            rows = self.index.read_folders(self.entity, list(folders.values()))
            described(rows).coalesce(1).write.mode("append").partitionBy("event_month", "batch_id").parquet(self.root)

    def forget(self, month: int, up_to: int) -> None:
        """Drops what is known of a month's batches up to one, before their files go."""
        for (_, batch), folder in self._folders(self.root, {month}).items():
            if batch <= up_to:
                storage.delete(self.spark, folder)

    def files(self, months: Container[int] | None = None) -> DataFrame:
        """The described files of the index, or of some months."""
        here = self._folders(self.rows_root, months)
        known = [f for at, f in self._folders(self.root, months).items() if at in here]
        if not known:
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).option("basePath", self.root).parquet(*map(storage.literal_path, known))

    def rows(self, ids: DataFrame, months: Container[int] | None = None) -> DataFrame:
        """Index rows of all files that can hold one of the ids (more rows than the ids' own)."""
        here, known = self._folders(self.rows_root, months), self._folders(self.root, months)
        found = files_with(self.files(months), ids).limit(MOST_FILES + 1).collect() if known else []
        if len(found) > MOST_FILES:
            return self.index.read_folders(self.entity, list(here.values()))
        named = [f"{here[r.event_month, r.batch_id]}/{r.file}" for r in found]
        whole = [f for at, f in here.items() if at not in known]
        return self.index.read_folders(self.entity, sorted(named) + sorted(whole))

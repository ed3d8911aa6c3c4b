"""Exact sets of ids, kept batch by batch.

    ids_<entity>/batch_id=<n>/

Ids are dealt to buckets of 32,768 consecutive numbers, negative ones to buckets of their
own. Of each batch and feature table, a bucket with `DENSE` ids or more is one bitmap of
4 KB; the ids of thinner ones are a row each, so ids that lie far apart cost no bitmaps.

Which ids there are, and how many, is then answered without the index rows: bitmaps of
one bucket are united by OR, and only thin ids that no bitmap holds are counted besides.
The sets hold all ids that were ever loaded, also those of files that were removed later.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entidex import storage

#: Ids of a bucket from which on a bitmap is smaller than rows of 8 bytes.
DENSE = 512

SETS = T.StructType(
    [
        T.StructField("feature_table", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def packed(rows: DataFrame) -> DataFrame:
    """`feature_table`, `bucket`, and either an `id` or the `bits` of a dense bucket, of index rows."""
    ids = rows.select("feature_table", F.col("id").cast("bigint").alias("id")).distinct()
    # At most 32,768 rows of one feature table have the same bucket.
    in_bucket = Window.partitionBy("feature_table", "bucket")
    marked = ids.withColumn("bucket", F.bitmap_bucket_number("id")).withColumn("n", F.count("*").over(in_bucket))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")
    dense = marked.filter(F.col("n") >= DENSE).groupBy("feature_table", "bucket").agg(bits)
    return marked.filter(F.col("n") < DENSE).select("feature_table", "bucket", "id").unionByName(dense, allowMissingColumns=True)


def _byte(bits: str, number: str) -> str:
    return f"cast(conv(hex(substring({bits}, cast({number} as int) + 1, 1)), 16, 10) as int)"


def _holds(bits: str, number: str) -> Column:
    position = f"bitmap_bit_position({number})"
    return F.expr(f"(shiftright({_byte(bits, f'{position} div 8')}, cast({position} % 8 as int)) & 1) = 1")


def united(sets: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """One bitmap per `keys` (which have the bucket), and the ids beside them that are in none."""
    dense = sets.filter("bits is not null").groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))
    thin = sets.filter("bits is null").select(*keys, "id").distinct()
    of = dense.select(*(F.col(k).alias(f"{k}_of") for k in keys), "bits")
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys))
    beside = thin.join(of, same, "left").filter(F.col("bits").isNull() | ~_holds("bits", "id"))
    return dense, beside.select(*keys, "id")


def members(dense: DataFrame) -> DataFrame:
    """`id` of every bit that is set."""
    bytes_set = dense.select("bucket", "bits", F.expr("explode(filter(sequence(0, 4095), i -> substring(bits, i + 1, 1) != X'00'))").alias("i"))
    each = bytes_set.select("bucket", "i", F.expr(_byte("bits", "i")).alias("byte"))
    each = each.select("bucket", "i", F.expr("explode(filter(sequence(0, 7), b -> (shiftright(byte, b) & 1) = 1))").alias("b"))
    # Buckets from 1 on count up from their first id, the others down.
    position = F.col("i") * 8 + F.col("b")
    return each.select(F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * 32768 + position + 1).otherwise(F.col("bucket") * 32768 - position).alias("id"))


class IdSets:
    """The sets of one entity of an index."""

    def __init__(self, index, entity: str):
        self.index, self.entity = index, entity
        self.root = f"{index.root}/ids_{entity}"

    def keep(self, batch_id: int) -> None:
        """Keeps the ids of the rows that a batch has written."""
        if batch_id in self.index.batches(self.entity):
            sets = packed(self.index.batch_rows(self.entity, {batch_id})).hint("rebalance")
            sets.sortWithinPartitions("feature_table", "bucket", "id").write.mode("append").parquet(f"{self.root}/batch_id={batch_id}")

    def _sets(self) -> DataFrame:
        if not storage.exists(self.index.spark, self.root):
            raise ValueError(f"no ids are kept of {self.entity}")
        return self.index.spark.read.schema(SETS).parquet(storage.literal_path(self.root))

    def ids(self, feature_tables: list[str] | None = None) -> DataFrame:
        """All ids, once each; of some feature tables if given."""
        sets = self._sets()
        if feature_tables is not None:
            sets = sets.filter(F.col("feature_table").isin(feature_tables))
        dense, beside = united(sets, ["bucket"])
        number = F.col("id").cast(self.index.entity_types()[self.entity])
        return members(dense).unionByName(beside.select("id")).select(number.alias("id"))

    def counts(self) -> DataFrame:
        """`feature_table` and `n_ids`, its number of different ids; no bitmap is taken apart."""
        dense, beside = united(self._sets(), ["feature_table", "bucket"])
        known = dense.select("feature_table", F.bitmap_count("bits").alias("n"))
        known = known.unionByName(beside.select("feature_table", F.lit(1).cast("bigint").alias("n")))
        return known.groupBy("feature_table").agg(F.sum("n").alias("n_ids"))

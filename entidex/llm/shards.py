"""Proportional stratified interleaving of rows into shards, all in DataFrame functions.

Rows of each source are shuffled by a seeded hash and ranked; rank r of n gives the
fraction (2r + 1) / 2n. Sorted by fraction, every stretch holds the sources in their
proportions, so cutting the order into equal parts makes every shard match the mixture.

Ranks are never taken by sorting a whole source in one task: rows fall into buckets of
about `BUCKET_ROWS` by the leading bits of their hash (or of their fraction), buckets are
counted, and a row's rank is what lies in earlier buckets plus its rank in its own. A
source with a third of all rows has a third of all buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entidex.llm.common import scratch, written

#: Law of the cut: counts of the shards differ by one at most.
LAW = "rows"
SEED = "s1"
#: Rows per bucket, on average; bounds what one task sorts at a time.
BUCKET_ROWS = 2_000
#: Bytes counted for a row besides its text.
ROW_BYTES = 16


def shuffle_key(id_col: str, seed: str) -> Column:
    """Seeded hash of an id: 32 hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))


def ranked(rows: DataFrame, group: list[str], bucket: Column, order: list) -> DataFrame:
    """`rows` with `rank` (from 0) within `group` by `order`.

    bucket: a non-decreasing function of `order` that splits a group into small parts.
    """
    keys = [*group, "bucket"]
    rows = rows.withColumn("bucket", bucket)
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("rows_in"))
    before = F.sum("rows_in").over(Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(*(F.col(c).alias(f"{c}_of") for c in keys), F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in keys))
    placed = rows.withColumn("within", within).join(offsets, same)
    return placed.withColumn("rank", F.col("offset") + F.col("within")).drop(*(f"{c}_of" for c in keys), "bucket", "offset", "within")


def interleave(docs: DataFrame, shards: int, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """One row per document: `id_col`, `size`, `text_crc32`, `source`, `shard`, `slot`.

    size: UTF-8 bytes of the text (null: none) plus 16. slot: place within the shard, from 0
    without gaps. Shard counts differ by one at most; with fewer rows than shards some
    stay empty. Null sources are a source of their own; rows with equal ids are told
    apart by their text hash, and rows equal in all of that may trade places. An empty
    table gives no rows. Other columns are not read. Texts are read once and not shuffled.
    """
    folder = scratch(docs.sparkSession)
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        shuffle_key(id_col, seed).alias("key"),
    )
    rows = written(rows, folder, "rows")
    counts = rows.groupBy("source").agg(F.count("*").alias("n"))
    of = counts.select(F.col("source").alias("source_of"), "n")
    rows = rows.join(of, F.col("source").eqNullSafe(F.col("source_of"))).drop("source_of")

    # The hash is uniform: its first 32 bits times the number of buckets.
    uniform = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    buckets = F.floor((F.col("n") - 1) / BUCKET_ROWS).cast("long") + 1
    in_source = ranked(rows, ["source"], F.floor(uniform * buckets / F.lit(2.0**32)).cast("long"), ["key", "id", "text_crc32", "size"])
    in_source = written(in_source, folder, "in_source")

    # Second rank: over all sources, by fraction.
    total = written(rows.agg(F.count("*").alias("total")), folder, "total").scalar()
    mixed = in_source.withColumn("fraction", (2 * F.col("rank") + 1) / (2 * F.col("n"))).withColumn("all", F.lit(0)).drop("rank")
    bucket = F.floor(F.col("fraction") * (F.floor((total - 1) / BUCKET_ROWS) + 1)).cast("long")
    place = ranked(mixed, ["all"], bucket, ["fraction", "source", "key", "id", "text_crc32", "size"])
    place = place.withColumn("total", total).withColumn("shard", F.expr(f"cast(rank * {shards} div total as int)"))
    # The first rank of a shard is the least r with r * shards div total = shard.
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return place.select(F.col("id").alias(id_col), "size", "text_crc32", "source", "shard", (F.col("rank") - first).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", **named: str) -> None:
    """`docs` as Parquet, one folder per shard, rows in slot order within a file.

    `id_col` must be unique; the text goes through one shuffle, by shard and slot range.
    """
    places = interleave(docs, shards, id_col=id_col, **named).select(F.col(id_col).alias("__id"), "shard", "slot")
    both = docs.join(places, F.col(id_col).eqNullSafe(F.col("__id"))).drop("__id")
    both.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

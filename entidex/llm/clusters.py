"""Lloyd's clustering with the dimensions dealt to shards, exact in integers.

Vectors are cut into column blocks and stored by block, in tiles of `TILE` vectors. In each
round a task of a block computes the partial distances of its tiles to its slice of the
centroids; the partial distances of a tile meet by key, are added, and each vector takes the
nearest centroid. The choices go back to the blocks by tile; each block sums its own slice
per cluster and so makes its slice of the next centroids.

A tile has a fixed size, whatever the vectors are, so equal vectors and large clusters make
no task larger. Only centroids (clusters times components) reach the driver. The choices of
each round are a written table; a task that is run again finds the same tiles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from entidex.llm.common import importable, scratch, tidied, written
from entidex.llm.vectors import integers, is_whole, narrow, squared_distances, wide
from entidex.storage import delete

#: Vectors of a tile; components of a block; the scale of the integers.
TILE, WIDTH, SCALE = 1024, 32, 64
CLUSTERS, ROUNDS, SEED = 16, 3, 1


def first_centroids(kept: DataFrame, id_col: str, vector_col: str, clusters: int, components: int, scale: int, seed: int) -> np.ndarray:
    """The vectors of the smallest hashes of `seed:id`, in their order; of equal ids, that of the smallest vector first."""
    key = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    first = kept.select(key.alias("key"), F.col(vector_col).alias("vector")).orderBy("key", "vector").limit(clusters).select("vector").collect()
    values = pa.array([r["vector"] for r in first], pa.list_(pa.float64()))
    return integers(values, components, scale)


def tiles(kept: DataFrame, id_col: str, vector_col: str, components: int, width: int, scale: int) -> DataFrame:
    """Rows of `tile`, `block`, `n`; block -1 has the tile's `ids`, the others their `values` and the `kind` of these."""
    schema = T.StructType([*T.StructType.fromDDL("tile bigint, block int, n int, kind string, values binary").fields, T.StructField("ids", T.ArrayType(kept.schema[id_col].dataType))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, TILE):
                part = batch.slice(start, TILE)
                tile, n = (task << 32) | number, part.num_rows
                number += 1
                rows = integers(part.column(1), components, scale)
                out = [{"tile": tile, "block": -1, "n": n, "ids": part.column(0).to_pylist()}]
                for block, at in enumerate(range(0, components, width)):
                    values, kind = narrow(rows[:, at : at + width])
                    out.append({"tile": tile, "block": block, "n": n, "kind": kind, "values": values})
                yield pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in arrow} for r in out], schema=arrow)

    return importable(kept).select(id_col, vector_col).mapInArrow(tidied(run), schema)


_PARTIAL = "tile bigint, n int, kind string, values binary"
_CHOSEN = "tile bigint, clusters binary, distances binary"


def partial_distances(blocks: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    """Per tile and block, the distances of its vectors to all centroids within the block's components."""
    schema = to_arrow_schema(T.StructType.fromDDL(_PARTIAL))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own = centroids[:, r["block"] * width : (r["block"] + 1) * width]
                values, kind = narrow(squared_distances(wide(r["values"], r["kind"], own.shape[1]), own))
                yield pa.RecordBatch.from_pylist([{"tile": r["tile"], "n": r["n"], "kind": kind, "values": values}], schema=schema)

    return importable(blocks).select("tile", "block", "n", "kind", "values").mapInArrow(tidied(run), _PARTIAL)


def nearest(partials: DataFrame, clusters: int) -> DataFrame:
    """Per tile, the nearest centroid of each vector (the smaller number of equally near ones) and the distance to it."""
    schema = to_arrow_schema(T.StructType.fromDDL(_CHOSEN))

    def add(rows: pa.Table) -> pa.Table:
        total = sum(wide(r["values"], r["kind"], clusters) for r in rows.to_pylist())
        best = total.argmin(1)
        row = {"tile": rows.column("tile")[0].as_py(), "clusters": best.astype(np.int32).tobytes(), "distances": total[np.arange(len(best)), best].tobytes()}
        return pa.Table.from_pylist([row], schema=schema)

    return partials.groupBy("tile").applyInArrow(add, _CHOSEN)


def moved(blocks: DataFrame, chosen: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """The centroids after one update: each block adds its own components per cluster."""
    clusters, components = centroids.shape
    schema = to_arrow_schema(T.StructType.fromDDL("cluster int, component int, n bigint, total bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((clusters, components), np.int64), np.zeros((clusters, components), np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                own = slice(r["block"] * width, min(components, (r["block"] + 1) * width))
                values, to = wide(r["values"], r["kind"], own.stop - own.start), np.frombuffer(r["clusters"], np.int32)
                np.add.at(totals[:, own], to, values)
                counts[:, own] += np.bincount(to, minlength=clusters)[:, None]
        c, i = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(counts[c, i]), pa.array(totals[c, i])], schema=schema)

    both = blocks.select("tile", "block", "kind", "values").join(chosen.select("tile", "clusters"), "tile")
    sums = both.mapInArrow(tidied(run), "cluster int, component int, n bigint, total bigint")
    after = centroids.copy()
    for r in sums.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        after[r["cluster"], r["component"]] = r["total"] // r["n"]
    return after


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = 64,
    scale: int = SCALE,
    seed: int = SEED,
    width: int = WIDTH,
) -> tuple[DataFrame, np.ndarray]:
    """Per vector `id_col`, cluster and distance (squared); and the centroids as integers.

    Kept are vectors of exactly `components` components, none null, NaN or infinite; each
    becomes floor(scale * x), beyond 2^27 counts as 2^27. First centroids: the kept vectors
    of the smallest sha256 of `seed:id`, fewer where fewer are kept. Ties go to the smaller
    number; an empty cluster keeps its centroid. A null id hashes as an empty text; rows
    repeat as they are and count as often; without kept vectors there are no rows and no
    centroids. Other columns are not read. `width` (components of a block) changes no result.
    """
    spark, folder = vectors.sparkSession, scratch(vectors.sparkSession)
    kept = vectors.filter(is_whole(F.col(vector_col), components))
    centroids = first_centroids(kept, id_col, vector_col, clusters, components, scale, seed)
    made = tiles(kept, id_col, vector_col, components, width, scale)
    made.write.partitionBy("block").parquet(f"{folder}/tiles")
    stored = spark.read.schema(made.schema).parquet(f"{folder}/tiles")
    blocks = stored.filter("block >= 0")
    for number in range(rounds + 1):
        chosen = written(nearest(partial_distances(blocks, centroids, width), max(1, len(centroids))), folder, f"chosen-{number}")
        if number < rounds and len(centroids):
            centroids = moved(blocks, chosen, centroids, width)

    schema = T.StructType([kept.schema[id_col], *T.StructType.fromDDL("cluster int, distance bigint").fields])
    arrow = to_arrow_schema(schema)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                columns = [batch.column(0)[i].values, pa.array(np.frombuffer(batch.column(1)[i].as_py(), np.int32)), pa.array(np.frombuffer(batch.column(2)[i].as_py(), np.int64))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow)], schema=arrow)

    of_tile = stored.filter("block = -1").select("tile", "ids").join(chosen, "tile")
    result = written(of_tile.select("ids", "clusters", "distances").mapInArrow(tidied(spread), schema), folder, "clustered")
    for used in ("tiles", *(f"chosen-{i}" for i in range(rounds + 1))):
        delete(spark, f"{folder}/{used}")
    return result, centroids


def with_inertia(clustered: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds cluster_inertia, inertia (distances summed over the cluster and over all) and centroid_sha256.

    clustered, centroids: as `cluster` returns them. One row per cluster at most is broadcast.
    """
    spark = clustered.sparkSession
    per = clustered.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    whole = sum(r["cluster_inertia"] for r in per)
    rows = [(r["cluster"], r["cluster_inertia"], whole, centroid_digest(centroids[r["cluster"]])) for r in per]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return clustered.join(F.broadcast(facts), "cluster")

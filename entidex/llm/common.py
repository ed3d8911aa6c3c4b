"""What the text operators share: reading tables, mapping texts in Arrow batches, scratch tables."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from entidex.storage import scratch_root

#: Texts handled at once inside a task; bounds what a worker holds besides one Arrow batch.
CHUNK_CHARS = 4_000_000


def importable(frame: DataFrame) -> DataFrame:
    """The frame; its Python workers look for this package where the driver found it.

    Where it is installed elsewhere on the executors, the extra entry does nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = frame.sparkSession.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    return frame


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return importable(frame.select(*columns) if columns else frame)


def written(frame: DataFrame, folder: str, name: str, few: bool = False) -> DataFrame:
    """The frame, written below a scratch folder and read again: cuts the lineage.

    few: for tables of few rows, which need no more files than there are cores.
    """
    path = f"{folder}/{name}"
    (frame.coalesce(frame.sparkSession.sparkContext.defaultParallelism) if few else frame).write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def scratch(spark: SparkSession) -> str:
    """A new folder for tables of one run, below `spark.checkpoint.dir`."""
    return scratch_root(spark)


def text_chunks(column: pa.Array, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list]]:
    """(first row, values) of parts of a column whose bytes add up to about `limit`.

    A larger value stands alone. Only one part at a time is held as Python objects. Columns
    other than strings are cut by rows.
    """
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    else:
        sizes = np.full(len(column), 4000)
    ends = np.cumsum(sizes + 16)
    start = 0
    while start < len(column):
        base = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, column.slice(start, end - start).to_pylist()
        start = end


def tidied(run: Callable) -> Callable:
    """A task's function that gives freed memory back when it ends: Python workers live on."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not on every system
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return wrapped


def map_texts(docs: DataFrame, id_col: str, text_col: str, make: Callable[[], Callable[[list], Iterable]], columns: str) -> DataFrame:
    """`id_col` and the columns made from each text; other columns are not read.

    make: called once per task; what it returns takes a list of texts (None where null)
    and returns one Arrow array for each of `columns` (a DDL list).
    """
    schema = T.StructType([docs.schema[id_col], *T.StructType.fromDDL(columns).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for start, texts in text_chunks(batch.column(1)):
                arrays = [batch.column(0).slice(start, len(texts)), *apply(texts)]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, arrow)], schema=arrow)

    return importable(docs).select(id_col, text_col).mapInArrow(tidied(run), schema)


def replace_texts(docs: DataFrame, text_col: str, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """`docs` with each text replaced; all other columns pass through, whatever their names."""
    at = docs.columns.index(text_col)
    arrow = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for start, texts in text_chunks(batch.column(at)):
                part = batch.slice(start, len(texts))
                new = pa.array(apply(texts), pa.string())
                arrays = [new if i == at else part.column(i) for i in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, arrow)], schema=arrow)

    # A dot in a column's name would be taken for a field of it.
    return importable(docs).toDF(*(f"c{i}" for i in range(len(docs.columns)))).mapInArrow(tidied(run), docs.schema)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def span_array(rows: list[list[tuple[str, int, int]]]) -> pa.Array:
    """Lists of (kind, start, end) as an Arrow array of Spark's `SPANS`."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in rows], pa.list_(kind))


def joined(spans: Column) -> Column:
    """Spans as `kind:start:end`, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_digest(spans: str, kinds: tuple[str, ...], counts: tuple[str, ...]) -> list[Column]:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return [
        *(of(kind).alias(name) for kind, name in zip(kinds, counts)),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col(spans)).alias("spans"),
    ]

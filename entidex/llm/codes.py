"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

Codebooks are trained on the distinct parts of all vectors. Parts are written as keys whose
byte order is the order of their integers, counted, dealt by ranges and sorted, so that
neighbours share long prefixes. Each task reads its sorted range as a sequence of tries: a
depth-first walk keeps, per branching node, the distances of the prefix to all entries; a
child adds only its own components. Leaves add their rest, take the least, and count with
their weight towards that entry's sums.

A vector that occurs very often is one leaf with a large weight. Only sums per entry and the
codebooks (256 entries of 16 components for each of 4 parts) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from entidex.llm.common import importable, scratch, tidied, written
from entidex.llm.vectors import integers, is_whole, squared_distances
from entidex.storage import delete

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Distinct parts of one trie, and leaves whose distances are computed at once.
TRIE, LEAVES = 16_384, 2_048
#: Added to an integer, so that it is written unsigned.
BIAS = 1 << 31


def keys_of(parts: np.ndarray) -> np.ndarray:
    """Rows of integers as bytes that sort alike."""
    whole = np.ascontiguousarray((parts + BIAS).astype(">u4"))
    return whole.view(f"V{4 * parts.shape[1]}").ravel()


def parts_of(keys: pa.Array, width: int) -> np.ndarray:
    data = b"".join(keys.to_pylist())
    return np.frombuffer(data, ">u4").astype(np.int64).reshape(-1, width) - BIAS


def distinct_rows(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, and the place of each row among them."""
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    first = np.append(True, (ordered[1:] != ordered[:-1]).any(1)) if len(parts) else np.empty(0, bool)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(first) - 1
    return ordered[first], place


def walk(parts: np.ndarray, entries: np.ndarray, leaf: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> None:
    """Depth-first walk over the trie of distinct, sorted parts.

    leaf: gets places of parts, the nearest entry of each (the smaller number of equally near
    ones) and the squared distance. Chains without a branch are taken in one step.
    """
    n, width = parts.shape
    if not n:
        return
    differ = parts[1:] != parts[:-1]
    shared = np.append(differ.argmax(1), -1)  # components that a part shares with the next one
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []  # depth, places, distances of the prefix
    held = 0

    def finish() -> None:
        nonlocal held
        for depth in sorted({w[0] for w in waiting}):
            own = [w for w in waiting if w[0] == depth]
            places = np.concatenate([w[1] for w in own])
            prefix = np.repeat(np.stack([w[2] for w in own]), [len(w[1]) for w in own], axis=0)
            total = prefix + squared_distances(parts[places, depth:], entries[:, depth:])
            best = total.argmin(1)
            leaf(places, best, total[np.arange(len(best)), best])
        waiting.clear()
        held = 0

    stack = [(0, n, 0, np.zeros(len(entries), np.int64))]
    while stack:
        low, high, depth, prefix = stack.pop()
        # The prefix grows up to the next branch.
        branch = int(shared[low : high - 1].min()) if high - low > 1 else depth
        if branch > depth:
            step = parts[low, depth:branch] - entries[:, depth:branch]
            prefix, depth = prefix + (step * step).sum(1), branch
        cuts = low + 1 + np.flatnonzero(shared[low : high - 1] == depth)
        edges = np.concatenate(([low], cuts, [high]))
        single = np.diff(edges) == 1
        alone = edges[:-1][single]
        for start in range(0, len(alone), LEAVES):
            some = alone[start : start + LEAVES]
            waiting.append((depth, some, prefix))
            held += len(some)
            if held >= LEAVES:
                finish()
        stack += [(a, b, depth, prefix) for a, b in zip(edges[:-1][~single].tolist(), edges[1:][~single].tolist())]
    finish()


def counted_parts(kept: DataFrame, vector_col: str, components: int, parts: int, scale: int) -> DataFrame:
    """`position`, `key`, `n` of the distinct parts, sorted within ranges of both.

    Equal parts of an Arrow batch are counted before anything is shuffled.
    """
    schema = "position int, key binary, n bigint"
    arrow, width = to_arrow_schema(T.StructType.fromDDL(schema)), components // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = integers(batch.column(0), components, scale)
            for position in range(parts):
                different, place = distinct_rows(rows[:, position * width : (position + 1) * width])
                n = np.bincount(place, minlength=len(different))
                keys = pa.array(keys_of(different).tolist(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(different), position, np.int32)), keys, pa.array(n)], schema=arrow)

    made = importable(kept).select(vector_col).mapInArrow(tidied(run), schema)
    return made.repartitionByRange("position", "key").groupBy("position", "key").agg(F.sum("n").alias("n")).sortWithinPartitions("position", "key")


def first_codebooks(kept: DataFrame, id_col: str, vector_col: str, components: int, parts: int, entries: int, scale: int) -> np.ndarray:
    """Parts of the vectors with the smallest ids; of equal ids, the smallest vector first."""
    first = kept.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    rows = integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), components, scale)
    return np.stack(np.split(rows, parts, axis=1))


def trained(counted: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all distinct parts."""
    parts, entries, width = codebooks.shape
    schema = "position int, entry int, component int, n bigint, total bigint"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(codebooks.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            positions = batch.column(0).to_numpy()
            for position in np.unique(positions).tolist():
                low, high = np.searchsorted(positions, [position, position + 1]).tolist()
                for start in range(low, high, TRIE):
                    piece = batch.slice(start, min(TRIE, high - start))
                    rows, weights = parts_of(piece.column(1), width), piece.column(2).to_numpy()

                    def leaf(places, best, _, rows=rows, weights=weights, position=position):
                        np.add.at(totals[position], best, rows[places] * weights[places][:, None])
                        np.add.at(counts[position], best, weights[places])

                    walk(rows, codebooks[position], leaf)
        p, e = np.nonzero(counts)
        n = len(p)
        column = lambda values, kind: pa.array(np.ascontiguousarray(values).astype(kind))
        yield pa.RecordBatch.from_arrays(
            [
                column(np.repeat(p, width), np.int32), column(np.repeat(e, width), np.int32), column(np.tile(np.arange(width), n), np.int32),
                column(np.repeat(counts[p, e], width), np.int64), column(totals[p, e].ravel(), np.int64),
            ],
            schema=arrow,
        )

    sums = importable(counted).select("position", "key", "n").mapInArrow(tidied(run), schema)
    after = codebooks.copy()
    for r in sums.groupBy("position", "entry", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        after[r["position"], r["entry"], r["component"]] = r["total"] // r["n"]
    return after


def train(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 64, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> np.ndarray:
    """Codebooks as integers: parts x entries x components of a part.

    Learnt from every vector of `components` components (divisible by `parts`), none null,
    NaN or infinite, as floor(scale * x). They start as the parts of the smallest ids (nulls
    last), fewer where fewer are kept. An entry becomes the floor of the mean of its parts; one
    that no part is nearest to stays.
    """
    if components % parts:
        raise ValueError(f"{components} components are no {parts} equal parts")
    kept = vectors.filter(is_whole(F.col(vector_col), components))
    codebooks = first_codebooks(kept, id_col, vector_col, components, parts, entries, scale)
    if not codebooks.shape[1]:
        return codebooks
    folder = scratch(vectors.sparkSession)
    counted = written(counted_parts(kept, vector_col, components, parts, scale), folder, "parts")
    for _ in range(rounds):
        codebooks = trained(counted, codebooks)
    delete(vectors.sparkSession, folder)
    return codebooks


def encode(vectors: DataFrame, codebooks: np.ndarray, vector_col: str = "embedding", scale: int = SCALE, keep: tuple[str, ...] = ("vec_id", "label")) -> DataFrame:
    """The columns `keep`, and per vector `code` (an entry's number per part) and `error`.

    error: squared distances to the entries, summed over the parts. Vectors that are null,
    hold null, NaN or infinite components or have another length than the codebooks are left
    out. Rows repeat as they are; an empty table and empty codebooks give none.
    """
    parts, entries, width = codebooks.shape
    components = parts * width
    names = [f"keep_{i}" for i in range(len(keep))]
    kept = vectors.filter(is_whole(F.col(vector_col), components) & F.lit(entries > 0))
    chosen = importable(kept).select(F.col(vector_col).alias("vector"), *(F.col(c).alias(n) for c, n in zip(keep, names)))
    schema = T.StructType([*(T.StructField(c, vectors.schema[c].dataType) for c in keep), *T.StructType.fromDDL("code array<int>, error bigint").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TRIE):
                piece = batch.slice(start, TRIE)
                rows = integers(piece.column(0), components, scale)
                code, error = np.zeros((len(rows), parts), np.int32), np.zeros(len(rows), np.int64)
                for position in range(parts):
                    different, place = distinct_rows(rows[:, position * width : (position + 1) * width])
                    nearest, distance = np.zeros(len(different), np.int32), np.zeros(len(different), np.int64)

                    def leaf(places, best, far, nearest=nearest, distance=distance):
                        nearest[places], distance[places] = best, far

                    walk(different, codebooks[position], leaf)
                    code[:, position] = nearest[place]
                    error += distance[place]
                codes = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * parts), pa.array(code.ravel()))
                columns = [*(piece.column(i + 1) for i in range(len(keep))), codes, pa.array(error)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow)], schema=arrow)

    return chosen.mapInArrow(tidied(run), schema)


def decode(codes: DataFrame, codebooks: np.ndarray, id_col: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """`id_col` and `vector`: the entries that `code` names, in the vectors' own scale; null where code is."""
    parts, _, width = codebooks.shape
    schema = T.StructType([codes.schema[id_col], *T.StructType.fromDDL("vector array<double>").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if c is None else codebooks[np.arange(parts), c].ravel() / scale for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, arrow.field(1).type)], schema=arrow)

    return importable(codes).select(id_col, "code").mapInArrow(tidied(run), schema)


def codebook_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """Adds label_error: `error` summed over the rows of the same label; those without one are one group.

    coded: a stored table, as it is read twice. A label of very many rows is summed before it
    is shuffled, and split by Spark's skew join afterwards.
    """
    sums = coded.groupBy(F.col(label_col).alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col(label_col).eqNullSafe(F.col("of_label"))).drop("of_label")

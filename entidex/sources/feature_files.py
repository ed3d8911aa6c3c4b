"""Feature files: footers first, then only the columns of the route."""

from __future__ import annotations

import json
import time
from collections import defaultdict
from collections.abc import Callable, Iterator
from multiprocessing.pool import ThreadPool

import pandas as pd
import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entidex.functions.keys import normalized
from entidex.functions.values import as_wall_time
from entidex.operators.extract import as_id, entity_rows, quoted, union_all
from entidex.storage import bare, files_by_location, literal_path, qualified

# What a column of a file may be, by its use.
ID_COLUMN_TYPES = {
    "bigint": ["tinyint", "smallint", "int", "bigint", "string"],
    "boolean": ["boolean", "tinyint", "smallint", "int", "bigint", "string"],
}
TIME_COLUMN_TYPES = ["tinyint", "smallint", "int", "bigint", "float", "double", "string", "timestamp", "timestamp_ntz"]

MISSING, BROKEN = "missing", "broken"

# Attempts at a file whose store fails, and seconds before the second one.
ATTEMPTS, WAIT = 4, 0.5

READ_ERRORS = (PySparkException, Py4JJavaError)


def read_problem(error: Exception) -> str | None:
    """What a failed Spark read says about its files; None if the files are not to blame."""
    if "PATH_NOT_FOUND" in str(error):
        return MISSING
    unreadable = ("FAILED_READ_FILE", "UNABLE_TO_INFER_SCHEMA")
    return BROKEN if any(condition in str(error) for condition in unreadable) else None


def s3_settings(spark: SparkSession) -> dict[str, str]:
    """Settings of Arrow's S3 file system from the session's `fs.s3a.*` settings."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    names = {
        "access_key": "fs.s3a.access.key",
        "secret_key": "fs.s3a.secret.key",
        "session_token": "fs.s3a.session.token",
        "endpoint_override": "fs.s3a.endpoint",
        "region": "fs.s3a.endpoint.region",
    }
    found = {name: value for name, key in names.items() if (value := conf.get(key))}
    if conf.get("fs.s3a.connection.ssl.enabled") == "false" or found.get("endpoint_override", "").startswith("http://"):
        found["scheme"] = "http"
    if "endpoint_override" in found:
        found["endpoint_override"] = found["endpoint_override"].split("://")[-1]
    return found


def _footer_reader(store: dict[str, str], opener: Callable | None = None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The task that reads footers. All nested, so that executors need not have this package.

    Only a file that is not there or whose footer makes no sense has an outcome. Other
    errors are the store's: they are tried again, then raised, so that the batch runs again.
    """
    attempts, wait, missing, broken = ATTEMPTS, WAIT, MISSING, BROKEN

    def spark_type(column) -> str:
        """Spark type to read a Parquet column with; what it is, in brackets, if it is of no use."""
        logical = json.loads(column.logical_type.to_json())
        kind, physical = logical["Type"], column.physical_type
        if physical == "INT96":
            return "timestamp"
        if kind == "String":
            return "string"
        if kind == "Timestamp" and logical["timeUnit"] != "nanoseconds":
            return "timestamp" if logical["isAdjustedToUTC"] else "timestamp_ntz"
        if kind == "Int" and (logical["isSigned"] or logical["bitWidth"] < 64):
            return "bigint" if logical["bitWidth"] == (64 if logical["isSigned"] else 32) else "int"
        plain = {"BOOLEAN": "boolean", "INT32": "int", "INT64": "bigint", "FLOAT": "float", "DOUBLE": "double"}
        return plain.get(physical, f"[{physical}]") if kind == "None" else f"[{kind}]"

    def opened(location: str):
        """The file through Arrow's own file systems."""
        scheme, rest = location.split(":", 1)
        rest = rest.lstrip("/")
        if scheme == "file":
            return fs.LocalFileSystem().open_input_file("/" + rest)
        authority, path = rest.split("/", 1)
        if scheme in ("s3", "s3a", "s3n"):
            return fs.S3FileSystem(**store).open_input_file(f"{authority}/{path}")
        system, _ = fs.FileSystem.from_uri(f"{scheme}://{authority}")
        return system.open_input_file(f"{authority}/{path}" if scheme == "gs" else f"/{path}")

    def tail(location: str) -> bytes | None:
        """The end of a file from its footer on; None if it is too short to have one."""
        with (opener or opened)(location) as source:
            size = source.size()
            if size < 12:
                return None
            source.seek(size - 8)
            length = int.from_bytes(source.read(4), "little")
            if length + 12 > size:
                return None
            source.seek(size - 8 - length)
            return source.read(length + 8)

    def footer(location: str, wanted: list[str]) -> tuple[str | None, str | None, int]:
        for attempt in range(attempts):
            try:
                end = tail(location)
                break
            except FileNotFoundError:
                return missing, None, 0
            except (pa.ArrowException, OSError):
                if attempt + 1 == attempts:
                    raise
                time.sleep(wait * 2**attempt)
        try:
            # What comes before the footer is not looked at.
            file = pq.ParquetFile(pa.BufferReader(b"PAR1" + (end or b"")))
            schema, n_rows = file.schema, file.metadata.num_rows
            columns = [schema.column(i) for i in range(len(schema))]
        except (pa.ArrowException, OSError):
            return broken, None, 0
        types = {c.name: spark_type(c) for c in columns if c.path == c.name and c.name in wanted}
        # Columns that are no single values take part in the shape of a file only.
        for c in columns:
            root = c.path.split(".")[0]
            if c.path != c.name and root in wanted:
                types[f"[{root}"] = types.get(f"[{root}", "") + f"{c.path}:{spark_type(c)};"
        return None, json.dumps(types, sort_keys=True), n_rows

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [footer(location, list(wanted)) for location, wanted in zip(batch["location"], batch["wanted"])]
            problems, types, n_rows = zip(*found) if found else ((), (), ())
            yield pd.DataFrame({"file": batch["file"], "problem": problems, "types": types, "n_rows": n_rows})

    return footers


def _footer_by_spark(spark: SparkSession, location: str, wanted: list[str]) -> tuple[str | None, str | None, int]:
    try:
        file = spark.read.parquet(literal_path(location))
        types, n_rows = dict(file.dtypes), file.count()
    except READ_ERRORS as error:
        problem = read_problem(error)
        if problem is None:
            raise
        return problem, None, 0
    return None, json.dumps({name: types[name] for name in wanted if name in types}, sort_keys=True), n_rows


def probe_footers(
    spark: SparkSession,
    files: list[tuple[int, str, list[str]]],
    probe: str = "arrow",
    store: dict[str, str] | None = None,
    opener: Callable | None = None,
) -> Iterator[tuple[int, str | None, dict[str, str] | None, int]]:
    """(number, problem, types, rows) of each (number, location, wanted): the types of the wanted columns.

    Reads footers only. Spark's own reader has no outcome per file: one missing or
    broken file fails the whole read, and a column that a file lacks turns into
    NULL. With "arrow", executors read the footers in parallel; `store` holds the settings
    of Arrow's S3 file system, by default those of `fs.s3a.*`, and `opener` opens a location
    in another way. With "spark", each footer is a small Spark read of its own: slower, but
    it uses the Hadoop file systems, for stores whose credentials only those have.
    """
    if probe == "spark":
        with ThreadPool(16) as pool:
            footers = pool.map(lambda file: (file[0], *_footer_by_spark(spark, *file[1:])), files)
    else:
        tasks = max(1, min(len(files) // 4, spark.sparkContext.defaultParallelism * 4))
        listed = spark.createDataFrame(files, "file bigint, location string, wanted array<string>")
        reader = _footer_reader(s3_settings(spark) if store is None else store, opener)
        found = listed.repartition(tasks).mapInPandas(reader, "file bigint, problem string, types string, n_rows bigint")
        footers = map(tuple, found.collect())
    for number, problem, types, n_rows in footers:
        yield number, problem, types and json.loads(types), n_rows


def _with_source(rows: DataFrame, files: list[tuple], columns: str, *selected: Column) -> DataFrame:
    """Selected columns of a scan, and what `files` says about the file of each row.

    files: rows of (location, *values); `columns` declares the values. They are looked up by
    the URI that Spark reports for a row, unchanged, so that no row has its URI decoded.
    They are NULL if Spark reports an unknown file.
    """
    uris = files_by_location(rows)
    known = [(uris.get(bare(location)), *values) for location, *values in files]
    by_uri = rows.sparkSession.createDataFrame(known, f"`__uri` string, {columns}")
    return rows.select(*selected, F.input_file_name().alias("__uri")).join(by_uri, "__uri", "left").drop("__uri")


def scan(spark: SparkSession, files: list[tuple[str, int, str]], types: dict[str, str]) -> DataFrame:
    """Only the columns in `types`, plus `__load` and `__feature_table` of the row's file.

    files: (location, load, feature table), at most as many as a part holds. A file that breaks
    while it is read gives the rows before that, one that is gone gives none: count them.
    """
    schema = ", ".join("`" + name.replace("`", "``") + f"` {kind}" for name, kind in types.items())
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    rows = reader.parquet(*[literal_path(location) for location, *_ in files])
    return _with_source(rows, files, "`__load` bigint, `__feature_table` string", *map(quoted, types))


def staged_rows(
    rows: DataFrame,
    types: dict[str, str],
    id_types: dict[str, str],
    timestamp_column: str,
    created_timestamp_column: str,
    *kept: Column,
) -> DataFrame:
    """Index rows of a scan: (entity, id, event and creation time, *kept); boolean ids as 0 and 1."""
    ids = {name: as_id(quoted(name), types[name], kind).cast("bigint") for name, kind in id_types.items()}
    return entity_rows(
        rows,
        ids,
        as_wall_time(quoted(timestamp_column), types[timestamp_column]),
        as_wall_time(quoted(created_timestamp_column), types[created_timestamp_column]),
        *kept,
    )


def location_of(key: Column, storage_root: str) -> Column:
    """Where a key's file lies: the bucket is the first folder below the root.

    NULL for a key that starts at `/` or climbs up with `..`, which names no bucket.
    """
    path = normalized(key)
    inside = ~path.startswith("/") & ~F.array_contains(F.split(path, "/"), "..")
    return F.when(inside, F.concat(F.lit(storage_root), path))


def read_features(
    paths: DataFrame,
    storage_root: str,
    columns: list[str],
    timestamp_column: str,
    created_timestamp_column: str,
    **probing,
) -> DataFrame:
    """The given columns of the files in `paths`, time columns as wall times, plus `path`.

    Files are read in groups of one shape, as ingest does, so every file's times are taken
    by its own types. A file without one of the feature columns has NULL there; one
    that is missing, broken or has no usable time column is an error. Only the list of
    files passes through the driver, as in every scan. `probing` goes to `probe_footers`.
    """
    spark = paths.sparkSession
    times = [timestamp_column, created_timestamp_column]
    wanted = list(dict.fromkeys([*columns, *times]))
    storage_root = storage_root if "://" in storage_root else qualified(spark, storage_root) + "/"
    files = [
        (row.path, row.location)
        for row in paths.select("path", location_of(F.col("path"), storage_root).alias("location")).distinct().collect()
    ]
    if not files:
        raise ValueError("no files to read")
    listed = [(i, location, wanted) for i, (_, location) in enumerate(files)]
    groups: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for i, problem, types, _ in probe_footers(spark, listed, **probing):
        path, location = files[i]
        unusable = [c for c in times if not problem and types.get(c) not in TIME_COLUMN_TYPES]
        if problem or unusable:
            raise ValueError(f"{path}: {problem or f'no usable time column {unusable[0]}'}")
        groups[json.dumps(types, sort_keys=True)].append((location, path))
    return union_all([_features_of(spark, group, wanted, times, json.loads(shape)) for shape, group in groups.items()])


def _features_of(spark: SparkSession, files: list[tuple[str, str]], wanted: list[str], times: list[str], types: dict[str, str]) -> DataFrame:
    """Feature rows of files of one shape."""
    rows = spark.read.parquet(*[literal_path(location) for location, _ in files])
    chosen = []
    for name in wanted:
        if name in times:
            chosen.append(as_wall_time(quoted(name), dict(rows.dtypes)[name]).alias(name))
        elif name in rows.columns:
            chosen.append(quoted(name))
        else:
            chosen.append(F.lit(None).alias(name))
    found = _with_source(rows, files, "`path` string", *chosen)
    unknown = F.raise_error(F.lit("a row of an unknown file: does the storage root redirect?"))
    return found.withColumn("path", F.coalesce("path", unknown.cast("string")))

"""Notifications in, index rows and job rows out, micro-batch by micro-batch.

A batch is handled in parts of at most `max_files` events, in arrival order. What
passes through the driver per part is one small record per event (key, route,
outcome); feature rows stay on the executors. Each part

1. finds the route of every file and checks it,
2. reads the footers, in parallel, and checks the columns,
3. stages the key columns of all good files in one job,
4. checks the staged rows: NULL keys, repeated keys, keys of the stored index,
   keys of earlier files of the part,
5. appends the rows of the accepted files, whole files only.

Job rows are written last. A replayed batch first deletes what it wrote before.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from entidex import storage
from entidex.functions.keys import normalized, parent_of
from entidex.functions.values import from_epoch_micros, to_epoch_micros
from entidex.id_files import IdFiles
from entidex.id_sets import IdSets
from entidex.latest_state import BUCKETS, LatestState
from entidex.operators import checks
from entidex.operators.extract import union_all
from entidex.operators.jobs import job_rows
from entidex.operators.lookups import month_of
from entidex.operators.routes import LocationPostings, routes_for_parents
from entidex.schemas import ENTITY, ID_TYPES
from entidex.sources import feature_files, notifications as source
from entidex.sources.registry import Registry
from entidex.store import EntityIndex

STAGED = "piece int, load bigint, entity string, id bigint, feature_table string, event_timestamp timestamp_ntz, created_timestamp timestamp_ntz"

OUTCOME = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("problem", T.StringType()),
        T.StructField("entities", T.ArrayType(ENTITY)),
        T.StructField("feature_table", T.StringType()),
    ]
)


@dataclass
class _File:
    """One event of a part."""

    seq: int
    key: str
    location: str | None
    feature_table: str | None
    timestamp_column: str | None
    created_timestamp_column: str | None
    entities: list
    problem: str | None
    load: int = -1
    types: dict[str, str] = field(default_factory=dict)
    n_rows: int = 0

    @property
    def names(self) -> list[str]:
        return [e.name for e in self.entities]

    @property
    def id_types(self) -> dict[str, str]:
        return {e.name: ID_TYPES[e.type.upper()] for e in self.entities}


def ingest_batch(
    events: DataFrame,
    batch_id: int,
    index: EntityIndex,
    registry: Registry,
    storage_root: str,
    *,
    bucket: str | None = None,
    literal: bool = False,
    removals: bool = False,
    keep_latest: bool | int = False,
    keep_files: bool = False,
    keep_ids: bool = False,
    postings: LocationPostings | None = None,
    max_files: int = 10_000,
    clock: Callable[[], datetime] = datetime.now,
    **probing,
) -> None:
    """Ingests one batch of notifications (event_name, key, received_at, maybe text).

    Files lie at `storage_root` + key: `s3a://`, or a folder that holds the buckets.
    With `literal`, the wildcards of a directory name match only themselves. `probing`
    (probe, store, opener) says how footers are read, see `feature_files.probe_footers`.
    Malformed messages are kept with their text. With `removals`, removal events are kept
    too: a file that is removed later in the batch is refused, keys of files that were
    removed since they were loaded count as free, and `EntityIndex.live` leaves their rows out.
    With `keep_latest`, the latest row per id is kept up to date for `latest_from_state`; a
    number says into how many buckets a new state is dealt.
    With `keep_files`, the id bounds of the index files are kept, for lookups and key checks
    that open only files with their ids.
    With `keep_ids`, the sets of ids are kept, from which `IdSets` lists and counts them.
    With `postings`, only locations that are new in the registry are cut into pieces, and a
    batch looks up its own.
    """
    if not 0 < max_files <= checks.MAX_LOADS:
        raise ValueError(f"max_files must be within 1 and {checks.MAX_LOADS}")
    spark = events.sparkSession
    scratch = storage.scratch_root(spark)
    root = storage_root if "://" in storage_root else storage.qualified(spark, storage_root) + "/"
    try:
        index.clear_batch(batch_id)
        if "text" in events.columns and not (malformed := source.malformed(events)).isEmpty():
            index.append_malformed(malformed, batch_id)
        wanted = source.subscribed(events, bucket)
        wanted = wanted.filter(F.col("key").isNotNull()) if removals else source.created(wanted)
        # `seq` counts on from here without gaps, so it tells the part.
        first = batch_id * 2**32 + 1
        part_of = F.floor((F.col("seq") - first) / max_files).cast("int").alias("part")
        arrived = source.sequenced(wanted, batch_id, scratch)
        routed = _routed(source.created(arrived), registry, root, literal, postings, scratch)
        if removals:
            routed = _without_removed_later(routed, source.removed(arrived), batch_id, index)
        routed.select("*", part_of).repartition("part").write.partitionBy("part").parquet(f"{scratch}/routed")
        for part in sorted(int(p.rsplit("=", 1)[1]) for p in storage.matching(spark, f"{scratch}/routed/part=*")):
            rows = spark.read.parquet(f"{scratch}/routed/part={part}").orderBy("seq").collect()
            files = [_File(**row.asDict()) for row in rows]
            started = clock()
            _ingest_part(spark, files, batch_id, index, f"{scratch}/part={part}", probing, removals)
            outcomes = spark.createDataFrame([(f.seq, f.key, f.problem, f.entities, f.feature_table) for f in files], OUTCOME)
            times = [F.lit(t).cast("timestamp_ntz") for t in (started, clock())]
            index.append_jobs(job_rows(_routeless_as_null(outcomes), *times), batch_id)
        for entity in index.entity_types() if keep_files else []:
            IdFiles(index, entity).describe(batch_id)
        for entity in index.entity_types() if keep_ids else []:
            IdSets(index, entity).keep(batch_id)
        if keep_latest:
            for entity in index.entity_types():
                LatestState(index, entity, BUCKETS if keep_latest is True else keep_latest).merge(batch_id, scratch)
    finally:
        storage.delete(spark, scratch)


def _routeless_as_null(outcomes: DataFrame) -> DataFrame:
    return outcomes.withColumn("entities", F.when(F.size("entities") > 0, F.col("entities")))


def _routed(
    events: DataFrame, registry: Registry, storage_root: str, literal: bool, postings: LocationPostings | None, scratch: str
) -> DataFrame:
    events = events.withColumn("parent", parent_of(F.col("key")))
    routes = routes_for_parents(events, registry, literal, postings, scratch)
    route = ["feature_table", "timestamp_column", "created_timestamp_column"]
    return events.join(routes, "parent", "left").select(
        "seq",
        "key",
        feature_files.location_of(F.col("key"), storage_root).alias("location"),
        *route,
        F.coalesce("entities", F.array().cast(T.ArrayType(ENTITY))).alias("entities"),
        checks.route_problem("entities", *route).alias("problem"),
    )


def _without_removed_later(routed: DataFrame, removed: DataFrame, batch_id: int, index: EntityIndex) -> DataFrame:
    """Keeps the removals, and refuses files that the batch sees removed after their event."""
    index.append_removals(removed.select(normalized(F.col("key")).alias("file"), "seq"), batch_id)
    last = index.removals().filter(F.col("batch_id") == batch_id).groupBy("file").agg(F.max("seq").alias("removed_at"))
    marked = routed.withColumn("file", normalized(F.col("key"))).join(last, "file", "left")
    gone = F.coalesce(F.col("removed_at") > F.col("seq"), F.lit(False))
    return marked.withColumn("problem", F.when(gone, checks.REMOVED_FILE).otherwise(F.col("problem"))).select(*routed.columns)


def _ingest_part(
    spark: SparkSession, files: list[_File], batch_id: int, index: EntityIndex, scratch: str, probing: dict, removals: bool
) -> None:
    _check_definitions(files, batch_id, index)
    _number_loads(files)
    _check_footers(spark, [f for f in files if f.load >= 0 and not f.problem], probing)
    loads = [f for f in files if f.load >= 0 and not f.problem]
    rows_of = {}
    if loads:
        staged, profile = _stage(spark, loads, f"{scratch}/staged", probing)
        if profile:
            rows_of = _check_rows(spark, loads, staged, profile, index, f"{scratch}/checks", removals)
            _append(spark, [f for f in loads if not f.problem], staged, rows_of, batch_id, index)
    _settle_repeats(files, rows_of)


def _check_definitions(files: list[_File], batch_id: int, index: EntityIndex) -> None:
    """The first file of an entity fixes its id type; a file of another type is refused."""
    routed = [f for f in files if not f.problem]
    first_types: dict[str, str] = {}
    for f in routed:
        first_types = f.id_types | first_types
    types = index.define(first_types, batch_id)
    for f in routed:
        other = [name for name, kind in f.id_types.items() if types[name] != kind]
        if other:
            f.problem = f"entity table has another id type: {other[0]}"


def _number_loads(files: list[_File]) -> None:
    """Numbers the files to read. Of several events for one file only the first is read."""
    seen: set[str] = set()
    for f in files:
        if f.problem:
            continue
        if f.location is None:
            f.problem = checks.NO_FILE
        elif f.location not in seen:
            f.load = len(seen)
            seen.add(f.location)


def _check_footers(spark: SparkSession, loads: list[_File], probing: dict) -> None:
    if not loads:
        return
    by_load = {f.load: f for f in loads}
    for load, problem, types, n_rows in _footers(spark, loads, probing):
        f = by_load[load]
        if problem:
            f.problem = _FILE_PROBLEMS[problem]
            continue
        wanted = _columns_of(f)
        f.n_rows = n_rows
        f.types = {name: kind for name, kind in types.items() if name in wanted}
        allowed = {name: feature_files.ID_COLUMN_TYPES[kind] for name, kind in f.id_types.items()}
        for name in wanted:
            if name not in f.types:
                f.problem = f"column missing: {name}"
            elif f.types[name] not in allowed.get(name, feature_files.TIME_COLUMN_TYPES):
                f.problem = f"unsupported column type: {name}"
            if f.problem:
                break


_FILE_PROBLEMS = {feature_files.MISSING: checks.NO_FILE, feature_files.BROKEN: checks.UNREADABLE}


def _columns_of(f: _File) -> list[str]:
    return [*f.names, f.timestamp_column, f.created_timestamp_column]


def _footers(spark: SparkSession, loads: list[_File], probing: dict):
    return feature_files.probe_footers(spark, [(f.load, f.location, _columns_of(f)) for f in loads], **probing)


def _stage(spark: SparkSession, loads: list[_File], path: str, probing: dict) -> tuple[DataFrame, list]:
    """Key columns of the files, written as a table, and its profile.

    All files are read in one job, however many of them break. What was read of each is
    counted and compared with its footer; those that fall short are read once more, in one
    job, since the store may have failed for a moment. Then they are missing or unreadable.
    """
    by_load = {f.load: f for f in loads}
    staged = _write_staged(spark, loads, path, 0, probing)
    profile = profile_of(staged)
    if any(row.load is None for row in profile):
        raise RuntimeError("rows of an unknown file: does the storage root redirect?")
    short = _fallen_short(loads, profile)
    if short:
        again = _write_staged(spark, short, path, 1, probing)
        # At most `max_files` rows.
        numbers = F.broadcast(spark.createDataFrame([(f.load,) for f in short], "load bigint"))
        staged = staged.join(numbers, "load", "left_anti").unionByName(again)
        loads_again = {f.load for f in short}
        profile = [row for row in profile if row.load not in loads_again] + profile_of(again)
        broken = _fallen_short(short, profile)
        for load, problem, *_ in _footers(spark, broken, probing) if broken else []:
            by_load[load].problem = _FILE_PROBLEMS.get(problem, checks.UNREADABLE)
    return staged, profile


def _fallen_short(loads: list[_File], profile: list) -> list[_File]:
    """Files of which not every row came out for each entity."""
    counted = {(row.load, row.entity): row.n_rows for row in profile}
    return [f for f in loads if not f.problem and any(counted.get((f.load, name), 0) != f.n_rows for name in f.names)]


def _write_staged(spark: SparkSession, loads: list[_File], path: str, piece: int, probing: dict) -> DataFrame:
    """Files with the same columns and types are one scan, whatever their feature table."""
    while True:
        left = [f for f in loads if not f.problem]
        groups = defaultdict(list)
        for f in left:
            groups[(f.timestamp_column, f.created_timestamp_column, *f.names, json.dumps(f.types))].append(f)
        if not left:
            return spark.createDataFrame([], STAGED)
        try:
            union = union_all([_staged_group(spark, group) for group in groups.values()])
            break
        except feature_files.READ_ERRORS as error:
            if feature_files.read_problem(error) != feature_files.MISSING:
                raise
            # A scan of named files does not start without one of them.
            gone = {load: problem for load, problem, *_ in _footers(spark, left, probing) if problem}
            if not gone:
                raise
            for f in left:
                f.problem = _FILE_PROBLEMS.get(gone.get(f.load))
    union.write.partitionBy("entity").parquet(f"{path}/piece={piece}")
    return spark.read.schema(STAGED).option("basePath", path).parquet(f"{path}/piece={piece}")


def _staged_group(spark: SparkSession, group: list[_File]) -> DataFrame:
    f = group[0]
    numbered = feature_files.scan(spark, [(g.location, g.load, g.feature_table) for g in group], f.types)
    return feature_files.staged_rows(
        numbered,
        f.types,
        f.id_types,
        f.timestamp_column,
        f.created_timestamp_column,
        F.col("__feature_table").alias("feature_table"),
        F.col("__load").alias("load"),
    )


def _check_rows(
    spark: SparkSession, loads: list[_File], staged: DataFrame, profile: list, index: EntityIndex, scratch: str, removals: bool
) -> dict[int, int]:
    """Sets the problems of loads by their rows; returns the number of rows per load."""
    by_load = {f.load: f for f in loads}

    def refuse(found: DataFrame, problem: str, applies: Callable[[_File], bool] = lambda f: True) -> None:
        for row in found.select("load").collect():
            f = by_load[row.load]
            if not f.problem and applies(f):
                f.problem = problem

    for row in profile:
        if row.n_null and not by_load[row.load].problem:
            by_load[row.load].problem = checks.NULL_KEY

    checks.key_holders(staged).write.parquet(f"{scratch}/holders")
    holders = spark.read.parquet(f"{scratch}/holders")
    if holders.isEmpty():
        holders = None
    else:
        # Rows of several entities may repeat one of them; such rows are collapsed instead.
        refuse(checks.duplicate_key_loads(holders), checks.DUPLICATE_KEY, lambda f: len(f.entities) == 1)

    unchecked = [(row, by_load[row.load]) for row in profile if not by_load[row.load].problem]
    stored = stored_keys_near(index, unchecked, removals, staged)
    if stored is not None:
        refuse(checks.stored_key_loads(staged, stored), checks.STORED_KEY)

    if holders is not None:
        good = [(f.load,) for f in loads if not f.problem]
        among = holders.join(F.broadcast(spark.createDataFrame(good, "load bigint")), "load", "left_semi")
        sharers = {row.load: bytes(row.sharers) for row in checks.key_sharers(among).collect()}
        for load in checks.refused_by_earlier(sharers):
            by_load[load].problem = checks.STORED_KEY
    return {row.load: row.n_rows for row in profile}


TIMES = ["event_timestamp", "created_timestamp"]


def profile_of(staged: DataFrame) -> list:
    """Rows, rows with a NULL key, months and bounds of the times (epoch microseconds) per load and entity."""
    micros = {c: to_epoch_micros(F.col(c)) for c in TIMES}
    month = month_of(F.col("event_timestamp"))
    return (
        staged.groupBy("load", "entity")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(checks.has_null_key()).alias("n_null"),
            F.collect_set(month).alias("months"),
            *[F.min(m).alias(f"min_{c}") for c, m in micros.items()],
            *[F.max(m).alias(f"max_{c}") for c, m in micros.items()],
        )
        .collect()
    )


def stored_keys_near(index: EntityIndex, profile: list[tuple], removals: bool = False, rows: DataFrame | None = None) -> DataFrame | None:
    """Keys of the stored index that the profiled rows could meet, or None without any.

    Per entity one scan, of the months that the rows have; of each month only the
    feature tables that have rows there, within their own bounds of both times. With
    `removals`, keys of removed files are none. With `rows` (entity, id), only files are
    opened that can hold one of their ids, where the index knows what its files hold.
    """
    by_entity = defaultdict(list)
    for row, f in profile:
        by_entity[row.entity].append((row, f))
    tables = []
    for entity, loaded in by_entity.items():
        bounds: dict[tuple, list] = {}
        for row, f in loaded:
            times = [row[f"{side}_{c}"] for c in TIMES for side in ("min", "max")]
            for month in row.months:
                known = bounds.setdefault((f.feature_table, month), times)
                bounds[f.feature_table, month] = [(min, max)[i % 2](a, b) for i, (a, b) in enumerate(zip(known, times))]
        id_type = loaded[0][1].id_types[entity]
        months = {month for _, month in bounds}
        files = IdFiles(index, entity)
        if rows is not None and files.kept():
            table = files.rows(rows.filter(F.col("entity") == entity), months)
        else:
            table = index.entity(entity, months, id_type)
        names = [f"{side}_{c}" for c in TIMES for side in ("min", "max")]
        schema = "feature_table string, event_month int, " + ", ".join(f"{n} bigint" for n in names)
        # One row per feature table and month of a part's files.
        wanted = table.sparkSession.createDataFrame([(*at, *times) for at, times in bounds.items()], schema)
        table = table.join(F.broadcast(wanted), ["feature_table", "event_month"])
        for c in TIMES:
            table = table.filter(F.col(c).between(from_epoch_micros(F.col(f"min_{c}")), from_epoch_micros(F.col(f"max_{c}"))))
        table = index.live(table) if removals else table
        tables.append(
            table.select(
                F.lit(entity).alias("entity"), F.col("id").cast("bigint").alias("id"), "feature_table", *TIMES
            )
        )
    return union_all(tables) if tables else None


def _append(
    spark: SparkSession, accepted: list[_File], staged: DataFrame, rows_of: dict[int, int], batch_id: int, index: EntityIndex
) -> None:
    by_entity = defaultdict(list)
    for f in accepted:
        for name in f.names if rows_of.get(f.load) else []:
            by_entity[name].append(f)
    for name, files in by_entity.items():
        rows = staged.filter(F.col("entity") == name)
        parts = []
        for collapsed in (False, True):
            chosen = [(f.load, f.key) for f in files if (len(f.entities) > 1) == collapsed]
            if chosen:
                paths = spark.createDataFrame(chosen, "load bigint, path string")
                # At most `max_files` rows, so the broadcast is bounded.
                part = rows.join(F.broadcast(paths), "load")
                parts.append(part.dropDuplicates(["load", *checks.KEY]) if collapsed else part)
        index.append_entity(name, union_all(parts).withColumn("id", F.col("id").cast(files[0].id_types[name])), batch_id)


def _settle_repeats(files: list[_File], rows_of: dict[int, int]) -> None:
    """A further event for a file fails like the first one, or on the rows the first one loaded."""
    first = {f.location: f for f in files if f.load >= 0}
    for f in files:
        if f.load < 0 and not f.problem:
            read = first[f.location]
            f.problem = read.problem or (checks.STORED_KEY if rows_of.get(read.load) else None)


def start_ingest(
    events: DataFrame,
    index: EntityIndex,
    registry: Callable[[], Registry],
    storage_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    first_batch: int = 0,
    **options,
) -> StreamingQuery:
    """Starts continuous ingest of a stream of notifications.

    The registry is read anew for each batch. A checkpoint numbers its batches from
    zero, and a batch replaces what the index holds under its number. So a new
    checkpoint on an index with batches needs a `first_batch` beyond them, which must
    then stay with that checkpoint.
    """
    spark = events.sparkSession
    if not storage.matching(spark, f"{storage.literal_path(checkpoint)}/offsets/*"):
        last = index.last_batch()
        if last is not None and last >= first_batch:
            raise ValueError(f"the index has batches up to {last}: a new checkpoint needs first_batch={last + 1}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, first_batch + batch_id, index, registry(), storage_root, **options)

    return (
        events.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )

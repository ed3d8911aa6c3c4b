"""From a file's directory to its route: entities, feature table, time columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entidex import storage
from entidex.functions.patterns import anchors_of, containing_pattern, grams_of
from entidex.sources.registry import Registry, live_tables, located_sources, table_entities
from entidex.storage import scratch_root

_GROUP = ["feature_table", "timestamp_column", "created_timestamp_column"]


# Most anchors of a batch that are sent to every task; more meet the locations in a shuffle.
MAX_SENT = 1_000_000


def _staged(frame: DataFrame, folder: str, name: str) -> DataFrame:
    """The frame, written and read again, so that what reads it several times computes it once."""
    frame.write.parquet(f"{folder}/{name}")
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{folder}/{name}")


def location_grams(locations: DataFrame) -> DataFrame:
    """(anchor, location) of all pieces of the distinct locations, each named by its hash."""
    spark = locations.sparkSession
    # Few bytes turn into many pieces here, so the number of tasks must not follow the bytes.
    urls = locations.select("file_url").distinct().repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file_url")
    return urls.select(F.xxhash64("file_url").alias("location"), F.explode(grams_of(F.col("file_url"))).alias("anchor"))


def pieces_met(grams: DataFrame, wanted: DataFrame) -> DataFrame:
    """The pieces that are an anchor of the batch."""
    return grams.join(wanted, "anchor", "left_semi").select("anchor", "location")


def candidate_locations(
    parents: DataFrame, locations: DataFrame, literal: bool = False, postings: LocationPostings | None = None, scratch: str | None = None
) -> DataFrame:
    """(parent, pattern, file_url) where the location holds the rarest anchor of the parent; see `patterns`.

    Which anchor is rare is counted first: names such as `lake/features/table_000123`
    share most of their pieces with all others. Of the many pieces of a location only
    those that are an anchor of this batch leave their task, as two numbers each. With
    `postings`, which must know the locations, pieces are looked up there instead of cut.
    Patterns and their pieces are written below `scratch`, a new folder by default.
    """
    folder = f"{scratch or scratch_root(parents.sparkSession)}/anchors"
    patterns = parents.select("parent").distinct().withColumn("pattern", containing_pattern(F.col("parent"), literal))
    patterns = _staged(patterns.withColumn("anchors", anchors_of(F.col("pattern"))), folder, "patterns")
    anchored = patterns.select("parent", "pattern", F.explode("anchors").alias("anchor"))
    wanted = anchored.select("anchor").distinct()
    if wanted.limit(MAX_SENT + 1).count() <= MAX_SENT:
        wanted = F.broadcast(wanted)
    grams = location_grams(locations) if postings is None else postings.of(wanted)
    cut = _staged(pieces_met(grams, wanted), folder, "pieces")
    rarest = (
        anchored.join(cut.groupBy("anchor").agg(F.count("*").alias("n")), "anchor", "left")
        .groupBy("parent", "pattern")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "anchor")).alias("rarest"))
        .filter(F.col("rarest.n") > 0)
        .select("parent", "pattern", "rarest.anchor")
    )
    found = rarest.join(cut, "anchor").select("parent", "pattern", "location")
    urls = locations.select("file_url").distinct().withColumn("location", F.xxhash64("file_url"))
    return found.join(urls, "location").select("parent", "pattern", "file_url")


def matching_locations(
    parents: DataFrame, locations: DataFrame, literal: bool = False, postings: LocationPostings | None = None, scratch: str | None = None
) -> DataFrame:
    """All (parent, file_url) where the location is LIKE '%parent%'."""
    candidates = candidate_locations(parents, locations, literal, postings, scratch)
    return candidates.filter(F.like("file_url", F.col("pattern"))).select("parent", "file_url")


class LocationPostings:
    """The pieces of all locations that a registry ever had, kept as a table.

        locations/version=<n>/              location, file_url: what this version added
        postings/version=<n>/slot=<s>/      anchor, location: their pieces, by hash of the anchor

    An update cuts only locations that are new. Those that left the registry stay in the
    postings, where they cost a candidate at most: candidates are joined with the locations
    of the day. A version's locations are written last, so one that broke off is made anew.
    """

    def __init__(self, spark: SparkSession, root: str, slots: int = 64):
        self.spark, self.root, self.slots = spark, storage.qualified(spark, root), slots

    def _versions(self) -> list[int]:
        done = storage.matching(self.spark, f"{storage.literal_path(self.root)}/locations/version=*/_SUCCESS")
        return sorted(int(path.split("/")[-2].rsplit("=", 1)[1]) for path in done)

    def _read(self, table: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{table}/version={v}" for v in self._versions()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*map(storage.literal_path, paths))

    def known(self) -> DataFrame:
        """(location, file_url) of all locations that are cut."""
        return self._read("locations", "location bigint, file_url string, version int").select("location", "file_url")

    def update(self, locations: DataFrame) -> int:
        """Takes in the locations that are not known yet; returns how many."""
        urls = locations.select("file_url").filter(F.col("file_url").isNotNull()).distinct().withColumn("location", F.xxhash64("file_url"))
        version = max(self._versions(), default=-1) + 1
        fresh = urls.join(self.known(), ["location", "file_url"], "left_anti")
        aside = f"{self.root}/new"
        fresh.write.mode("overwrite").parquet(aside)
        fresh = self.spark.read.schema(fresh.schema).parquet(aside)
        n = fresh.count()
        if n:
            slot = F.pmod("anchor", F.lit(self.slots)).cast("int").alias("slot")
            pieces = location_grams(fresh).select("anchor", "location", slot).hint("rebalance", F.col("slot"))
            pieces.sortWithinPartitions("slot", "anchor").write.mode("overwrite").partitionBy("slot").parquet(f"{self.root}/postings/version={version}")
            fresh.select("location", "file_url").write.mode("overwrite").parquet(f"{self.root}/locations/version={version}")
        return n

    def of(self, anchors: DataFrame) -> DataFrame:
        """(anchor, location) of the given anchors. Only slots that they fall into are read."""
        schema = "anchor bigint, location bigint, slot int, version int"
        slots = anchors.select(F.pmod("anchor", F.lit(self.slots)).cast("int").alias("slot")).distinct()
        chosen = sorted(r.slot for r in slots.collect())
        return self._read("postings", schema).filter(F.col("slot").isin(chosen)).select("anchor", "location")


def routes_of(sources: DataFrame, keys: list[str]) -> DataFrame:
    """One row per route: entities that share `keys`, feature table and time columns."""
    return _entities(sources, [*keys, *_GROUP])


def _entities(sources: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct `entities` of each group of rows that share `keys`, by name and type."""
    return (
        sources.select(*keys, "entity_name", "entity_type")
        .distinct()
        .groupBy(*keys)
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.col("entity_name").alias("name"), F.col("entity_type").alias("type")))
            ).alias("entities")
        )
    )


def routes_for_parents(
    parents: DataFrame, registry: Registry, literal: bool = False, postings: LocationPostings | None = None, scratch: str | None = None
) -> DataFrame:
    """The route of each directory in `parents`; directories without one are left out.

    Several routes may match. The first by (feature table, event time column,
    creation time column), NULL first, is taken; `n_candidates` counts them all. With
    `postings`, these are brought up to the registry first, and then looked up.
    """
    folder = f"{scratch or scratch_root(parents.sparkSession)}/routes"
    located = located_sources(registry)
    if postings is not None:
        postings.update(located)
    matched = located.join(matching_locations(parents, located, literal, postings, scratch), "file_url")
    # The first route is chosen among feature tables; only then their many entities are gathered.
    with_entities = table_entities(registry).select("table").distinct()
    tables = live_tables(registry, matched).select("parent", "table", *_GROUP).distinct().join(with_entities, "table", "left_semi")
    tables = _staged(tables, folder, "tables")
    first = (
        tables.select("parent", *_GROUP)
        .distinct()
        .groupBy("parent")
        .agg(F.min(F.struct(*_GROUP)).alias("route"), F.count("*").alias("n_candidates"))
        .select("parent", "route.*", "n_candidates")
    )
    first = _staged(first, folder, "first")
    same = [tables[c].eqNullSafe(first[c]) for c in _GROUP]
    chosen = _staged(tables.join(first, [tables["parent"] == first["parent"], *same]).select(tables["parent"], "table"), folder, "chosen")
    if chosen.limit(MAX_SENT + 1).count() <= MAX_SENT:
        chosen = F.broadcast(chosen)
    entities = _entities(table_entities(registry).join(chosen, "table"), ["parent"])
    return first.join(entities, "parent").select("parent", *_GROUP, "entities", "n_candidates")

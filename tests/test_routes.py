import shutil
from dataclasses import replace

import pytest
from feature_store import registry
from pyspark.sql import functions as F

from entidex.functions.patterns import anchors_of
from entidex.operators import checks
from entidex.operators.routes import LocationPostings, candidate_locations, location_grams, matching_locations, pieces_met, routes_for_parents, routes_of
from entidex.sources.registry import Registry, located_sources, read_registry, registered_sources


def _routes(spark, reg, *parents, **options):
    frame = spark.createDataFrame([(p,) for p in parents], "parent string")
    rows = routes_for_parents(frame, reg, **options).collect()
    return {r.parent: r for r in rows}


def test_only_live_tables_of_active_projects(spark):
    one = {"driver": "INT64"}
    reg = registry(
        spark,
        ("lake/live", "t", one),
        ("lake/deleted", "t", one, {"deleted": True}),
        ("lake/unknown", "t", one, {"deleted": None}),
        ("lake/archived", "t", one, {"project": "old", "archived": True}),
        ("lake/undecided", "t", one, {"project": "new", "archived": None}),
        ("lake/broken", "t", one, {"config": "{broken lake/broken"}),
        ("lake/empty", "t", one, {"config": "{}"}),
    )
    names = ["live", "deleted", "unknown", "archived", "undecided", "broken", "empty"]
    assert set(_routes(spark, reg, *[f"lake/{n}" for n in names])) == {"lake/live"}


def test_directory_is_a_pattern(spark):
    one = {"driver": "INT64"}
    reg = registry(spark, ("lake/a_b", "under", one), ("lake/axb", "x", one), ("lake/ab", "prefix", one))
    routes = _routes(spark, reg, "lake/a_b", "lake/axb", "lake/a", "lake/none", ".", "lake/a%b")
    assert {p: (r.feature_table, r.n_candidates) for p, r in routes.items()} == {
        "lake/a_b": ("under", 2),
        "lake/axb": ("x", 1),
        "lake/a": ("prefix", 3),
        "lake/a%b": ("prefix", 3),
    }
    literal = _routes(spark, reg, "lake/a_b", "lake/a%b", literal=True)
    assert {p: (r.feature_table, r.n_candidates) for p, r in literal.items()} == {"lake/a_b": ("under", 1)}


def test_entities_of_a_route_are_collected_once(spark):
    reg = registry(
        spark,
        ("lake/a", "t", {"driver": "INT64", "car": "BOOL"}),
        ("lake/a/more", "t", {"driver": "INT64"}, {"project": "other"}),
    )
    route = _routes(spark, reg, "lake/a")["lake/a"]
    assert [tuple(e) for e in route.entities] == [("car", "BOOL"), ("driver", "INT64")]
    assert route.n_candidates == 1
    assert routes_of(registered_sources(reg), []).count() == 1
    assert routes_of(registered_sources(reg), ["file_url"]).count() == 2


def test_null_time_column_sorts_first(spark):
    one = {"driver": "INT64"}
    reg = registry(spark, ("lake/a", "t", one), ("lake/a/x", "t", one, {"cr": None}))
    route = _routes(spark, reg, "lake/a")["lake/a"]
    assert (route.created_timestamp_column, route.n_candidates) == (None, 2)


def test_route_problems(spark):
    reg = registry(
        spark,
        ("b/good", "t1", {"driver": "int64"}),
        ("b/text", "t2", {"driver": "INT64", "name": "STRING"}),
        ("b/long", "t" * 256, {"driver": "INT64"}),
        ("b/edge", "t" * 255, {"driver": "INT64"}),
        ("b/blank", "t3", {"driver": "INT64"}, {"cr": " "}),
        ("b/null", "t4", {"driver": "INT64"}, {"cr": None}),
        ("b/same", "t5", {"driver": "INT64"}, {"cr": "ev"}),
        ("b/clash", "t6", {"ev": "INT64"}),
    )
    names = ["good", "text", "long", "edge", "blank", "null", "same", "clash", "none"]
    parents = spark.createDataFrame([(f"b/{n}",) for n in names], "parent string")
    routes = parents.join(routes_for_parents(parents, reg), "parent", "left")
    problem = checks.route_problem("entities", "feature_table", "timestamp_column", "created_timestamp_column")
    assert {r[0][2:]: r[1] for r in routes.select("parent", problem).collect()} == {
        "good": None,
        "text": "unsupported entity type: STRING",
        "long": checks.LONG_NAME,
        "edge": None,
        "blank": checks.BLANK_COLUMN,
        "null": checks.BLANK_COLUMN,
        "same": checks.TWICE_NAMED,
        "clash": checks.TWICE_NAMED,
        "none": checks.NO_ROUTE,
    }


def test_registry_from_files(spark, tmp_path):
    reg = registry(spark, ("lake/a", "t", {"driver": "INT64"}))
    for name in Registry.__dataclass_fields__:
        getattr(reg, name).write.parquet(str(tmp_path / name))
    assert registered_sources(read_registry(spark, str(tmp_path))).count() == 1


@pytest.mark.parametrize("n", [100, 400])
def test_lookalike_directories_make_few_candidates(spark, n):
    """Names that share a long start and a long end, and differ in between."""
    number = F.lpad(F.col("id").cast("string"), 5, "0")
    directory = F.concat(F.lit("lake/warehouse/online/features/team"), number, F.lit("/daily/aggregated/feature/tables/v1"))
    parents = spark.range(n).select(directory.alias("parent"))
    locations = parents.select(F.concat(F.lit("s3a://"), "parent", F.lit("/")).alias("file_url"))
    assert candidate_locations(parents, locations).count() <= 2 * n
    assert matching_locations(parents, locations).count() == n


def test_pieces_that_are_no_anchor_stay_in_their_task(spark):
    """What is shuffled follows the batch's directories, not the registry."""
    locations = spark.range(2000).select(F.concat(F.lit("s3a://lake/some/where/table_"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("/")).alias("file_url"))
    parents = spark.createDataFrame([("lake/some/where/table_000123",)], "parent string")
    wanted = F.broadcast(parents.select(F.explode(anchors_of(F.col("parent"))).alias("anchor")).distinct())
    plan = pieces_met(location_grams(locations), wanted)._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    semi = next(i for i, line in enumerate(lines) if line.startswith("BroadcastHashJoin [anchor") and "LeftSemi" in line)
    # Straight above the pieces: no exchange in between.
    assert any(line.startswith("Generate explode") for line in lines[semi + 1 : semi + 4])
    assert candidate_locations(parents, locations).count() <= 20


def test_shuffled_anchors_find_the_same(spark, monkeypatch):
    from entidex.operators import routes

    parents = spark.createDataFrame([("lake/a_b",), ("lake/x",), ("%",)], "parent string")
    locations = spark.createDataFrame([("s3a://lake/a_b/",), ("s3a://lake/axb/",), ("s3a://lake/x/y",)], "file_url string")
    want = sorted(map(tuple, matching_locations(parents, locations).collect()))
    assert len(want) == 6
    monkeypatch.setattr(routes, "MAX_SENT", 0)
    assert sorted(map(tuple, matching_locations(parents, locations).collect())) == want


def test_stored_postings_follow_the_registry(spark, tmp_path):
    one = {"driver": "INT64"}
    postings = LocationPostings(spark, str(tmp_path), slots=4)
    first = [("lake/a_b", "under", one), ("lake/gone", "gone", one), ("lake/axb", "x", one)]
    second = [("lake/a_b", "under", one), ("lake/axb", "x2", one), ("lake/new", "new", one)]
    names = ["lake/a_b", "lake/gone", "lake/new", "lake/a", "lake/none", "."]
    for reg, new in ((registry(spark, *first), 3), (registry(spark, *second), 1), (registry(spark, *first), 0)):
        located = located_sources(reg)
        assert postings.update(located) == new and postings.update(located) == 0
        for literal in (False, True):
            assert _routes(spark, reg, *names, postings=postings, literal=literal) == _routes(spark, reg, *names, literal=literal)


def test_a_broken_off_update_is_made_again(spark, tmp_path):
    located = located_sources(registry(spark, ("lake/a", "a", {"driver": "INT64"}), ("lake/b", "b", {"driver": "INT64"})))
    postings = LocationPostings(spark, str(tmp_path))
    assert postings.update(located.filter("id = 0")) == 1
    assert postings.update(located) == 1
    shutil.rmtree(tmp_path / "locations" / "version=1")  # written last
    assert postings.known().count() == 1
    assert postings.update(located) == 1
    parents = spark.createDataFrame([("lake/a",), ("lake/b",), ("lake",)], "parent string")
    found = matching_locations(parents, located, postings=postings)
    assert sorted(map(tuple, found.collect())) == [("lake", "s3a://lake/a/"), ("lake", "s3a://lake/b/"), ("lake/a", "s3a://lake/a/"), ("lake/b", "s3a://lake/b/")]


def test_postings_of_few_anchors_read_few_slots(spark, tmp_path):
    located = spark.createDataFrame([(f"s3a://lake/team-{i:04d}/",) for i in range(300)], "file_url string")
    postings = LocationPostings(spark, str(tmp_path))
    postings.update(located)
    anchors = spark.createDataFrame([(5,), (5 + 64,)], "anchor bigint")
    assert {f.split("slot=")[1].split("/")[0] for f in postings.of(anchors).inputFiles()} == {str(s) for s in range(64)}
    read = postings.of(anchors)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slot" in read and "(slot#" in read


def test_entities_are_gathered_of_the_chosen_route_alone(spark, tmp_path):
    reg = registry(
        spark,
        ("lake/a/x", "b", {f"other_{i}": "INT64" for i in range(20)}),
        ("lake/a/y", "a", {"driver": "INT64"}),
        ("lake/a/z", "0", {}),
    )
    route = _routes(spark, reg, "lake/a", scratch=str(tmp_path))["lake/a"]
    # A table without entities is no route.
    assert (route.feature_table, route.n_candidates, [e.name for e in route.entities]) == ("a", 2, ["driver"])
    assert spark.read.parquet(f"{tmp_path}/routes/chosen").count() == 1


def test_null_columns_of_a_route_find_its_entities(spark):
    reg = registry(spark, ("lake/a", None, {"driver": "INT64"}), ("lake/a", "t", {"car": "INT64"}))
    route = _routes(spark, reg, "lake/a")["lake/a"]
    assert (route.feature_table, route.n_candidates, [e.name for e in route.entities]) == (None, 2, ["driver"])


def test_projects_of_one_name_do_not_multiply_sources(spark):
    reg = registry(spark, ("lake/a", "t", {"driver": "INT64"}))
    again = replace(reg, projects=reg.projects.unionByName(reg.projects))
    assert registered_sources(again).count() == registered_sources(reg).count() == 1

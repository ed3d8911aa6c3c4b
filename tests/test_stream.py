import json
import os
from datetime import datetime

import pytest
from feature_store import NOW, Store, registry

from entidex.operators import checks
from entidex.plans.streamed import event_registry
from entidex.sources import notifications as source
from entidex.streaming.ingest import ingest_batch, start_ingest

CREATED = "s3:ObjectCreated:Put"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, tmp_path)


def _send(store, name, *messages):
    os.makedirs(f"{store.root}/notes", exist_ok=True)
    with open(f"{store.root}/notes/{name}.json", "w") as f:
        f.writelines((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages)


def _message(key, time, name=CREATED):
    return {"EventName": name, "Key": key, "Records": [{"eventTime": time, "s3": {"object": {"size": 1}}}]}


def test_reading_notifications(spark, store):
    _send(
        store, "a", _message("lake/a.parquet", "2024-01-01T10:00:00.5Z"), "{broken", {"EventName": CREATED},
        {"Key": "lake/b.parquet"}, {"EventName": CREATED, "Key": "lake/c.parquet"},
        _message("lake/d.parquet", "no time", "s3:ObjectRemoved:Delete"),
    )
    events = source.read_notifications(spark, f"{store.root}/notes")
    assert source.malformed(events).count() == 3
    assert sorted(r.text for r in source.malformed(events).collect()) == sorted(
        ["{broken", json.dumps({"EventName": CREATED}), json.dumps({"Key": "lake/b.parquet"})]
    )
    rows = {r.key: r for r in source.created(events).collect()}
    assert set(rows) == {"lake/a.parquet", "lake/c.parquet"}
    assert rows["lake/a.parquet"].received_at == datetime(2024, 1, 1, 10, 0, 0, 500_000)
    written = datetime.fromtimestamp(os.path.getmtime(f"{store.root}/notes/a.json"), tz=None)
    assert abs(rows["lake/c.parquet"].received_at.timestamp() - written.timestamp()) < 86_400
    assert [r.key for r in source.removed(events).collect()] == ["lake/d.parquet"]


def test_queue_messages(spark):
    rows = [(json.dumps(_message("lake/a.parquet", None)), datetime(2024, 1, 1)), ("{", datetime(2024, 1, 1))]
    events = source.parse_notifications(spark.createDataFrame(rows, "value string, timestamp timestamp"))
    assert [r.key for r in source.created(events).collect()] == ["lake/a.parquet"]
    assert source.malformed(events).count() == 1
    assert source.created(events).first().received_at is not None


def test_arrival_order(spark, tmp_path):
    rows = [(CREATED, f"k{i % 7}", datetime(2024, 1, 1 + i % 3)) for i in range(500)]
    rows += [(CREATED, "hot", datetime(2024, 1, 2))] * 250
    events = spark.createDataFrame(rows, "event_name string, key string, received_at timestamp_ntz").repartition(5)
    found = source.sequenced(events, 3, str(tmp_path)).collect()
    found.sort(key=lambda r: r.seq)
    assert [r.seq for r in found] == [3 * 2**32 + i for i in range(1, 751)]
    order = [(r.received_at, r.key) for r in found]
    assert order == sorted((t, k) for _, k, t in rows)


def _run(store, reg, checkpoint="checkpoint", **options):
    start_ingest(
        source.stream_notifications(store.spark, f"{store.root}/notes", max_files_per_trigger=1),
        store.index,
        lambda: reg,
        f"{store.data}/",
        f"{store.root}/{checkpoint}",
        trigger={"availableNow": True},
        **options,
    ).awaitTermination()


def test_stream_equals_one_batch(spark, store, tmp_path):
    reg = registry(spark, ("lake/trips", "trips", {"driver": "INT64"}))
    keys = [store.rows(f"lake/trips/{i}.parquet", [i, i + 1]) for i in range(4)]
    times = [f"2024-01-01T00:00:0{i}Z" for i in range(4)]
    _send(store, "1", _message(keys[0], times[0]), "{broken", _message(keys[1], times[1]))
    _send(store, "2", _message(keys[0], times[0], "s3:ObjectRemoved:Delete"))
    _run(store, reg)
    # Picks up where it stopped.
    _send(store, "3", _message(keys[2], times[2]), _message(keys[3], times[3]), _message(keys[0], times[3]))
    _run(store, reg)
    assert store.outcomes() == [
        (keys[0], None),
        (keys[1], checks.STORED_KEY),
        (keys[2], None),
        (keys[0], checks.STORED_KEY),
        (keys[3], checks.STORED_KEY),
    ]
    assert [r.text for r in store.index.malformed().collect()] == ["{broken"]
    # A new checkpoint must not overwrite the batches of the old one.
    with pytest.raises(ValueError, match="first_batch=3"):
        _run(store, reg, "other")
    rows, outcomes = store.index_rows(), store.outcomes()
    _run(store, reg, "other", first_batch=3)
    assert store.index_rows() == rows and store.outcomes()[: len(outcomes)] == outcomes
    assert {m for _, m in store.outcomes()[len(outcomes) :]} == {checks.STORED_KEY}
    assert store.index.last_batch() == 5

    whole = Store(spark, tmp_path / "whole")
    events = source.read_notifications(spark, f"{store.root}/notes")
    ingest_batch(events, 0, whole.index, reg, store.data)
    assert whole.index_rows() == rows
    assert whole.outcomes() == outcomes


def test_nothing_is_left_in_the_scratch_folder(spark, store):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        pytest.skip("no shared folder is set")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    reg = registry(spark, ("lake/trips", "trips", {"driver": "INT64"}))
    ingest_batch(store.notifications(store.rows("lake/trips/a.parquet", [1])), 0, store.index, reg, store.data)
    assert {name for name in os.listdir(base) if name.startswith("entidex-")} <= before


def test_lookups_over_a_stored_index(spark, store):
    from entidex.operators import lookups
    from entidex.sources.feature_files import read_features

    reg = registry(spark, ("lake/trips", "trips", {"driver": "INT64"}))
    day = 86_400_000_000
    a = store.put("lake/trips/a [1].parquet", driver=[1, 2], ev=[NOW, NOW + 40 * day], cr=[NOW] * 2, speed=[0.5, 1.5])
    b = store.put("lake/trips/b.parquet", driver=[1, 3], ev=[NOW + day, NOW + day], cr=[NOW + day] * 2, speed=[2.5, 3.5])
    ingest_batch(store.notifications(a, b), 0, store.index, reg, store.data)
    index = store.index.entity("driver")

    span = lookups.in_span(index, "2023-11-15", "2023-11-30")
    assert sorted((r.id, r.path) for r in span.collect()) == [(1, b), (3, b)]
    plan = span._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "GreaterThanOrEqual(event_timestamp" in plan

    listed = store.index.span("driver", datetime(2023, 11, 15), datetime(2023, 11, 30))
    assert sorted(listed.collect()) == sorted(span.collect())
    assert {f.rsplit("event_month=")[1][:6] for f in listed.inputFiles()} == {"202311"}
    assert store.index.span("driver", datetime(2025, 1, 1), datetime(2025, 2, 1)).count() == 0

    ids = spark.createDataFrame([(1,)], "id bigint")
    assert {r.path for r in lookups.paths_for_ids(index, ids).collect()} == {a, b}
    rows = lookups.rows_for_ids(index, ids)
    features = read_features(rows.select("path"), f"{store.data}/", ["driver", "speed"], "ev", "cr")
    found = lookups.features_for_rows(rows, features, "driver", "ev", "cr")
    assert sorted((r.driver, r.speed, r.path) for r in found.collect()) == [(1, 0.5, a), (1, 2.5, b)]

    removed = spark.createDataFrame([(a,)], "key string")
    assert sorted(r.id for r in lookups.without_removed(index, removed).collect()) == [1, 3]

    store.index.create_views()
    latest = spark.sql("select id, path, rk from max_entity_driver order by id").collect()
    assert [tuple(r) for r in latest] == [(1, b, 1), (2, a, 1), (3, b, 1)]
    assert spark.sql("select * from entity_driver").count() == 4
    assert spark.sql("select status from jobs").count() == 2
    with pytest.raises(ValueError):
        store.index.entity("unknown")


def test_published_database(spark, store):
    reg = registry(spark, ("lake/trips", "trips", {"driver_id": "INT64"}))
    keys = [
        store.put(f"lake/trips/{i}.parquet", **{"driver_id": [1, i]}, ev=[NOW + i] * 2, cr=[NOW + i] * 2) for i in (2, 3)
    ]
    try:
        for batch, key in enumerate(keys):
            ingest_batch(store.notifications(key), batch, store.index, reg, store.data)
            store.index.publish("entity_lookup_test")
        rows = spark.sql("select id, path, rk from entity_lookup_test.`max_entity_driver_id`").collect()
        assert sorted(map(tuple, rows)) == [(1, keys[1], 1), (2, keys[0], 1), (3, keys[1], 1)]
        assert spark.sql("select * from entity_lookup_test.`entity_driver_id`").count() == 4
        assert spark.sql("select * from entity_lookup_test.jobs where status = 'success'").count() == 2
    finally:
        for name in ("max_entity_driver_id",):
            spark.sql(f"drop view if exists entity_lookup_test.`{name}`")
        for name in ("entity_driver_id", "jobs"):
            spark.sql(f"drop table if exists entity_lookup_test.`{name}`")
        spark.sql("drop database if exists entity_lookup_test")


def test_rows_are_found_in_their_own_file(spark, store):
    """Two files with the same ids and times: each row comes from the file the index names."""
    from entidex.operators import lookups
    from entidex.sources.feature_files import read_features

    reg = registry(spark, ("lake/a", "ta", {"driver": "INT64"}), ("lake/b", "tb", {"driver": "INT64"}))
    same = {"driver": [1, 2], "ev": [NOW] * 2, "cr": [NOW] * 2}
    a, b = store.put("lake/a/x.parquet", **same, speed=[1.0, 2.0]), store.put("lake/b/x.parquet", **same, speed=[3.0, 4.0])
    ingest_batch(store.notifications(a, b), 0, store.index, reg, store.data)
    index = store.index.entity("driver")
    rows = index.filter(f"(id = 1 and path = '{a}') or (id = 2 and path = '{b}')")
    features = read_features(rows.select("path"), f"{store.data}/", ["driver", "speed"], "ev", "cr")
    found = lookups.features_for_rows(rows, features, "driver", "ev", "cr")
    assert sorted((r.driver, r.speed, r.path, r.feature_table) for r in found.collect()) == [(1, 1.0, a, "ta"), (2, 4.0, b, "tb")]


def test_features_of_files_of_many_shapes(spark, store):
    """Times in microseconds, milliseconds, text and INT96; a column that a file lacks; nested columns."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from entidex.sources.feature_files import read_features

    time = datetime(2024, 1, 1, 12)
    shapes = {
        "micros": [1_704_110_400_000_000],
        "millis": pa.array([time], pa.timestamp("ms")),
        "text": ["1704110400000000"],
        "int96": pa.array([time], pa.timestamp("us")),
    }
    keys = []
    for name, column in shapes.items():
        extra = {} if name == "millis" else {"speed": [0.5]}
        keys.append(store.put(f"lake/trips/{name}.parquet", driver=[1], ev=column, cr=column, tags=[["a", "b"]], **extra))
    path = f"{store.data}/{keys[-1]}"
    pq.write_table(pq.read_table(path), path, use_deprecated_int96_timestamps=True)
    paths = spark.createDataFrame([(k,) for k in keys], "path string")
    rows = read_features(paths, f"{store.data}/", ["driver", "speed", "tags"], "ev", "cr").collect()
    assert {r.path: (r.ev, r.cr, r.speed, r.tags) for r in rows} == {
        k: (time, time, None if "millis" in k else 0.5, ["a", "b"]) for k in keys
    }
    with pytest.raises(ValueError, match="missing"):
        read_features(paths.limit(0).unionAll(spark.createDataFrame([("lake/none.parquet",)], "path string")), f"{store.data}/", ["driver"], "ev", "cr")
    untimed = store.put("lake/trips/untimed.parquet", driver=[1], ev=[NOW])
    with pytest.raises(ValueError, match="no usable time column cr"):
        read_features(spark.createDataFrame([(untimed,)], "path string"), f"{store.data}/", ["driver"], "ev", "cr")


def test_the_registry_of_events_does_not_read_them_again(spark, tmp_path):
    rows = [("click", datetime(2024, 1, 1, 5)), ("click", datetime(2024, 1, 1, 6)), ("view", None)]
    spark.createDataFrame(rows, "event_type string, ts timestamp_ntz").write.parquet(f"{tmp_path}/events")
    registry = event_registry(spark.read.parquet(f"{tmp_path}/events"))
    for table in (registry.data_sources, registry.feature_tables, registry.feature_tables_entities_v2):
        assert table.count() == 2
        assert not [f for f in table.inputFiles() if str(tmp_path / "events") in f]

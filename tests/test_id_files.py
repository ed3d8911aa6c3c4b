"""Files found by their id bounds: against all bounds, and with the other files broken."""

import os
import random

import pytest
from feature_store import NOW, Store, registry
from pyspark.sql import functions as F

from entidex.functions.values import from_epoch_micros
from entidex.id_files import IdFiles, among, files_with, next_ids
from entidex.operators import checks
from entidex.store import EntityIndex
from entidex.streaming.ingest import ingest_batch

MONTH = 31 * 86_400_000_000


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, tmp_path)


def _index(spark, root, ids, file_rows, batch=0, months=1):
    index = EntityIndex(spark, str(root), file_rows=file_rows)
    index.define({"driver": "bigint"}, batch)
    rows = spark.createDataFrame([(i, "trips", NOW + m * MONTH, f"{i}.parquet") for i in ids for m in range(months)], "id long, feature_table string, ev long, path string")
    index.append_entity("driver", rows.withColumn("event_timestamp", from_epoch_micros(F.col("ev"))).withColumn("created_timestamp", F.col("event_timestamp")), batch)
    return index


def _ids(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def _scanned(frame):
    """Rows that the scans of a frame put out, once it has run."""
    frame.collect()
    plan, rows = frame._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            rows.append(node.metrics().get("numOutputRows").get().value())
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            walk(node.plan())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return sum(rows)


@pytest.mark.parametrize("n", [0, 1, 5, 400])
def test_bounds_that_hold_an_id(spark, n):
    rng = random.Random(n)
    value = lambda: rng.choice([rng.randint(-50, 50), rng.randint(-(2**62), 2**62), 2**53 + rng.randint(0, 3)])
    ids = [value() for _ in range(n)] + [None, -(2**63), 2**63 - 1][: 3 * (n == 5)]
    bounds = [(i, *sorted((value(), value()))) for i in range(300)] + [(300 + i, i - 3, i - 3) for i in range(6)] + [(400, -(2**63), 2**63 - 1)]
    files = spark.createDataFrame(bounds, "file long, min_id long, max_id long")
    known = [i for i in ids if i is not None]
    got = {r.file for r in files_with(files, _ids(spark, *ids)).collect()}
    assert got == {f for f, a, b in bounds if any(a <= i <= b for i in known)}
    after = {r.min_id: r.next_id for r in next_ids(files, _ids(spark, *ids)).collect()}
    assert after == {a: min((i for i in known if i >= a), default=None) for _, a, _ in bounds}


def test_files_without_the_ids_are_not_opened(spark, tmp_path):
    index = _index(spark, tmp_path, range(0, 2000, 2), file_rows=50, months=2)
    files = IdFiles(index, "driver")
    assert not files.kept()
    assert sorted(r.id for r in index.rows_for_ids("driver", _ids(spark, 10, 11, 1998)).collect()) == [10, 10, 1998, 1998]
    files.describe(0)
    described = files.files().collect()
    assert len(described) >= 40 and sum(r.n_rows for r in described) == 2000
    opened = lambda *ids: len(files.rows(_ids(spark, *ids)).inputFiles())
    assert (opened(10), opened(10, 12), opened(10, 1998)) == (2, 2, 4) and opened(5000) == 0
    for r in described:
        if not (r.min_id <= 10 <= r.max_id or r.min_id <= 1998 <= r.max_id):
            folder = tmp_path / "entity_driver" / f"event_month={r.event_month}" / f"batch_id={r.batch_id}"
            (folder / f".{r.file}.crc").unlink()
            (folder / r.file).write_bytes(b"no parquet")
    assert sorted(r.path for r in index.paths_for_ids("driver", _ids(spark, 10, 1998, 5000, None)).collect()) == ["10.parquet", "1998.parquet"]
    month = min(r.event_month for r in described)
    assert index.rows_for_ids("driver", _ids(spark, 10), {month}).count() == 1


def test_row_groups_without_the_ids_are_skipped(spark, tmp_path):
    """Within the bounds of a file of distinct ids, its Bloom filter tells an id that is not there."""
    index = EntityIndex(spark, str(tmp_path))
    index.define({"driver": "bigint"}, 0)
    time = from_epoch_micros(F.lit(NOW))
    # Too many ids for a dictionary.
    rows = spark.range(0, 1_000_000, 2).select("id", F.lit("t").alias("feature_table"), time.alias("event_timestamp"), time.alias("created_timestamp"), F.lit("p").alias("path"))
    index.append_entity("driver", rows.repartition(1), 0)
    IdFiles(index, "driver").describe(0)
    absent = [2 * i + 1 for i in range(100, 112)]
    all_of = index.entity("driver")
    found = all_of.filter(among(_ids(spark, *absent)))
    assert _scanned(found) < 50_000 < _scanned(all_of.filter("id >= 1"))
    assert index.rows_for_ids("driver", _ids(spark, *absent, 400)).count() == 1


def test_undescribed_and_compacted_folders(spark, tmp_path):
    for batch, ids in enumerate(([1, 2], [3, 4], [5, 6])):
        index = _index(spark, tmp_path, ids, file_rows=1, batch=batch)
        if batch != 1:
            IdFiles(index, "driver").describe(batch)
    files = IdFiles(index, "driver")
    assert len(files.rows(_ids(spark, 1)).inputFiles()) == 3  # one of batch 0, those of batch 1
    wanted = _ids(spark, 1, 3, 6)
    assert sorted(r.id for r in index.rows_for_ids("driver", wanted).collect()) == [1, 3, 6]
    index.compact(2)
    assert sorted(r.id for r in index.rows_for_ids("driver", wanted).collect()) == [1, 3, 6]
    assert sorted((r.batch_id, r.min_id, r.max_id) for r in files.files().collect()) == [(1, i, i) for i in (1, 2, 3, 4)] + [(2, 5, 5), (2, 6, 6)]
    index.clear_batch(2)
    assert sorted(r.id for r in index.rows_for_ids("driver", wanted).collect()) == [1, 3]


def test_more_files_than_are_named(spark, tmp_path, monkeypatch):
    from entidex import id_files

    index = _index(spark, tmp_path, range(100), file_rows=10)
    IdFiles(index, "driver").describe(0)
    monkeypatch.setattr(id_files, "MOST_FILES", 2)
    monkeypatch.setattr(id_files, "MOST_SENT", 3)
    assert index.rows_for_ids("driver", _ids(spark, *range(0, 100, 7))).count() == 15


def test_ingest_checks_keys_by_files(spark, store):
    """A file far from the new ids may break; keys that are stored are still found."""
    reg = registry(spark, ("lake/trips", "trips", {"driver": "INT64"}))
    store.index.file_rows = 2
    events = lambda *keys: store.notifications(*keys)
    ingest_batch(events(store.rows("lake/trips/a.parquet", [1, 2, 50, 51])), 0, store.index, reg, store.data, keep_files=True)
    far = next(r for r in IdFiles(store.index, "driver").files().collect() if r.min_id == 50)
    folder = f"{store.root}/index/entity_driver/event_month={far.event_month}/batch_id=0"
    os.remove(f"{folder}/.{far.file}.crc")
    open(f"{folder}/{far.file}", "wb").write(b"no parquet")
    ingest_batch(events(store.rows("lake/trips/b.parquet", [2, 9]), store.rows("lake/trips/c.parquet", [9, 10])), 1, store.index, reg, store.data, keep_files=True)
    assert [m for _, m in store.outcomes()] == [None, checks.STORED_KEY, None]

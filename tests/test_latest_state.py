"""The latest state kept by batches, against the latest view of the whole history."""

import os
import random

import pytest
from feature_store import NOW, Store, registry
from pyspark.sql import functions as F

from entidex import storage
from entidex.functions.values import from_epoch_micros
from entidex.latest_state import LatestState
from entidex.operators.latest import latest
from entidex.schemas import INDEX_COLUMNS
from entidex.streaming.ingest import ingest_batch

TRIPS = ("lake/trips", "trips", {"driver": "INT64"})
FLAGS = ("lake/flags", "flags", {"big": "BOOL"})
REMOVED = "s3:ObjectRemoved:Delete"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, tmp_path)


def _ingest(store, reg, batch_id, *events, **options):
    ingest_batch(store.notifications(*events), batch_id, store.index, reg, store.data, **({"removals": True, "keep_latest": 4} | options))


def _same(store, entity="driver"):
    want = latest(store.index.live(store.index.entity(entity)))
    rows = lambda frame: sorted(map(tuple, frame.select(*INDEX_COLUMNS, "rk").collect()))
    got = rows(store.index.latest_from_state(entity))
    assert got == rows(want)
    return got


def _folders(store, entity="driver"):
    found = storage.matching(store.spark, f"{store.index.root}/latest_{entity}/of=*/bucket=*/whole=*/batch_id=*")
    return {tuple(int(x.rsplit("=", 1)[1]) for x in f.rsplit("/", 3)[1:]) for f in found}


def test_late_files_replays_and_removals(spark, store):
    reg = registry(spark, TRIPS, FLAGS)
    new = store.rows("lake/trips/new.parquet", [1, 2, 3], created=NOW + 10)
    old = store.rows("lake/trips/old.parquet", [2, 3, 4], created=NOW)
    only = store.rows("lake/trips/only.parquet", [9], created=NOW)
    flag = store.put("lake/flags/a.parquet", big=[True, False], ev=[NOW] * 2, cr=[NOW] * 2)
    _ingest(store, reg, 0, new, flag)
    _ingest(store, reg, 1, old, only)
    assert [r[0] for r in _same(store)] == [1, 2, 3, 4, 9] and len(_same(store, "big")) == 2
    _ingest(store, reg, 2, (REMOVED, new), (REMOVED, only))
    assert [(r[0], r[4]) for r in _same(store)] == [(i, old) for i in (2, 3, 4)]
    # A replay, with other events, finds the state as it was before the batch.
    _ingest(store, reg, 2, (REMOVED, old), (REMOVED, flag), (REMOVED, new), new)
    assert [(r[0], r[4]) for r in _same(store)] == [(1, new), (2, new), (3, new), (9, only)]
    assert _same(store, "big") == []


def _load(store, batch, rows, removed=(), merge=True, **options):
    """Writes index rows (id, creation time, path) and removals of a batch, without files."""
    index = store.index
    index.clear_batch(batch)
    index.define({"driver": "bigint"}, batch)
    if rows:
        made = store.spark.createDataFrame([(i, "trips", NOW, cr, path) for i, cr, path in rows], "id long, feature_table string, ev long, cr long, path string")
        times = [from_epoch_micros(F.col(c)).alias(n) for c, n in (("ev", "event_timestamp"), ("cr", "created_timestamp"))]
        index.append_entity("driver", made.select("id", "feature_table", *times, "path"), batch)
    if removed:
        index.append_removals(store.spark.createDataFrame([(f, batch) for f in removed], "file string, seq long"), batch)
    if merge:
        LatestState(index, "driver", **({"buckets": 4} | options)).merge(batch, f"{store.root}/scratch-{batch}-{random.random()}")


def test_any_order_of_batches(spark, store):
    """Random files, removals and returns; runs are merged from the third on."""
    rng, held = random.Random(4), {}
    for batch in range(8):
        back = [p for p in held if rng.random() < 0.2]
        gone = [p for p in held if rng.random() < 0.3 or p in back]
        fresh = [f"lake/{batch}-{i}.parquet" for i in range(rng.randint(0, 2))]
        held |= {p: [(i, NOW + rng.randint(0, 5) * 1000, p) for i in rng.sample(range(12), 4)] for p in fresh}
        _load(store, batch, [r for p in fresh + back for r in held[p]], gone, most_runs=2)
        if batch in (3, 7):
            _same(store)


def test_batches_that_were_not_merged_are_made_up_for(spark, store):
    files = [[(1, NOW + i, n), (2, NOW + i, n), (10 + i, NOW + i, n)] for i, n in enumerate("abcd")]
    _load(store, 0, files[0], merge=False)
    with pytest.raises(ValueError):
        store.index.latest_from_state("driver")
    _load(store, 1, files[1])
    _same(store)
    _load(store, 2, files[2], ["b"], merge=False)
    _load(store, 3, files[3], ["c"], merge=False)
    _load(store, 4, [], ["d"])
    assert [r[0] for r in _same(store)] == [1, 2, 10]
    store.index.compact(5)
    assert [r[0] for r in _same(store)] == [1, 2, 10]


def test_reads_the_buckets_of_the_batch_alone(spark, store):
    """A broken version of another bucket does no harm to a merge."""
    bucket_of = {r.id: r.b for r in spark.range(40).selectExpr("id", "cast(pmod(xxhash64(id), 4) as int) as b").collect()}
    _load(store, 0, [(i, NOW, "all") for i in range(40)])
    state = LatestState(store.index, "driver", most_runs=1)
    mine = next(i for i in range(40) if bucket_of[i] == 2)
    folder = f"{state.root}/bucket=3/whole=0/batch_id=0".removeprefix("file:")
    part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    content = open(f"{folder}/{part}", "rb").read()
    os.remove(f"{folder}/.{part}.crc")
    open(f"{folder}/{part}", "wb").write(b"no parquet")
    _load(store, 1, [(mine, NOW + 1, "one")], most_runs=1)
    assert {f for f in _folders(store) if f[2] == 1} == {(2, 1, 1)}
    open(f"{folder}/{part}", "wb").write(content)
    _same(store)


def test_runs_are_merged_and_old_versions_go(spark, store):
    for batch in range(6):
        _load(store, batch, [(7, NOW + batch, str(batch))], buckets=1, most_runs=2)
    _same(store)
    # Runs 0 and 1, merged by batch 2; runs 3 and 4, merged by batch 5, which has forgotten those before 2.
    assert _folders(store) == {(0, 1, 2), (0, 0, 3), (0, 0, 4), (0, 1, 5)}

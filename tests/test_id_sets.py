from datetime import datetime

import pytest
from entidex import id_sets
from entidex.id_sets import IdSets
from entidex.plans.streamed import clocked_index
from entidex.schemas import entity_schema
from entidex.store import EntityIndex

TIME = datetime(2024, 1, 5)
EDGES = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**63 - 1, -(2**63), -(2**63) + 1, 7 * 32768]
BATCHES = {
    0: [(i, "a") for i in EDGES] + [(i, "b") for i in range(-40, 60)],
    1: [(i, "a") for i in range(0, 200, 3)] + [(i, "a") for i in EDGES] + [(5, None), (6, None)],
    2: [(i, "b") for i in range(50, 70)] + [(5, None)] + [(i * 100_003, "c") for i in range(-50, 50)],
}


def filled(spark, root, batches=BATCHES, kind="bigint"):
    index = EntityIndex(spark, str(root))
    index.define({"user": kind}, 0)
    for batch, ids in batches.items():
        rows = [(i, table, TIME, TIME, "f") for i, table in ids]
        for _ in range(2):  # the second time is a replay
            index.clear_batch(batch)
            index.define({"user": kind}, batch)
            index.append_entity("user", spark.createDataFrame(rows * 2, entity_schema(kind)), batch)
            IdSets(index, "user").keep(batch)
    return index


@pytest.mark.parametrize("dense", [1, 20, 10**6])
def test_as_plain_sets(spark, tmp_path, monkeypatch, dense):
    monkeypatch.setattr(id_sets, "DENSE", dense)
    sets = IdSets(filled(spark, tmp_path), "user")
    pairs = [p for ids in BATCHES.values() for p in ids]
    assert sorted(r.id for r in sets.ids().collect()) == sorted({i for i, _ in pairs})
    assert sorted(r.id for r in sets.ids(["b", "c"]).collect()) == sorted({i for i, t in pairs if t in ("b", "c")})
    counts = {t: len({i for i, of in pairs if of == t}) for t in ("a", "b", "c", None)}
    assert {r.feature_table: r.n_ids for r in sets.counts().collect()} == counts


def test_dense_buckets_are_bitmaps(spark, tmp_path):
    index = filled(spark, tmp_path, {0: [(i, "a") for i in range(1, 2001)] + [(i * 10**6, "b") for i in range(100)]})
    rows = IdSets(index, "user")._sets().collect()
    assert sorted((r.feature_table, r.bits is None) for r in rows) == [("a", False)] + [("b", True)] * 100


def test_flags(spark, tmp_path):
    sets = IdSets(filled(spark, tmp_path, {0: [(True, "a"), (False, "b")], 1: [(True, "b")]}, "boolean"), "user")
    assert sorted(r.id for r in sets.ids().collect()) == [False, True]
    assert {r.feature_table: r.n_ids for r in sets.counts().collect()} == {"a": 1, "b": 2}


def test_without_rows(spark, tmp_path):
    index = EntityIndex(spark, str(tmp_path))
    index.define({"user": "bigint"}, 0)
    IdSets(index, "user").keep(0)
    with pytest.raises(ValueError, match="no ids are kept"):
        IdSets(index, "user").ids()


def test_kept_by_ingest(spark, sf_dir):
    index = clocked_index(spark, sf_dir, datetime.now, keep_ids=True)
    found = sorted(r.id for r in IdSets(index, "user").ids().collect())
    assert found and found == sorted(r.id for r in index.entity("user").select("id").distinct().collect())

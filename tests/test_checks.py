import random
from datetime import datetime

from pyspark.sql import functions as F

from entidex.operators import checks, jobs

ROWS = "load bigint, entity string, id bigint, feature_table string, event_timestamp timestamp_ntz, created_timestamp timestamp_ntz"
T = datetime(2024, 1, 1)


def _rows(spark, held):
    """Rows of (load, id) pairs; an id of None is a NULL key."""
    return spark.createDataFrame([(load, "e", i, "t", T, T) for load, i in held], ROWS)


def _refused(spark, held):
    rows = _rows(spark, held)
    sharers = {r.load: bytes(r.sharers) for r in checks.key_sharers(checks.key_holders(rows)).collect()}
    return checks.refused_by_earlier(sharers)


def _refused_one_by_one(held):
    keys, refused = set(), set()
    for load in sorted({load for load, _ in held}):
        own = {i for l, i in held if l == load}
        if own & keys:
            refused.add(load)
        else:
            keys |= own
    return refused


def test_null_and_duplicate_keys(spark):
    rows = _rows(spark, [(1, 1), (1, None), (1, None), (2, 2), (2, 2), (2, 2), (2, 3), (3, 2), (3, 9)])
    assert [tuple(r) for r in checks.null_key_loads(rows).collect()] == [(1, 2)]
    holders = checks.key_holders(rows)
    assert sorted((r.id, r.load, r.n) for r in holders.collect()) == [(2, 2, 3), (2, 3, 1)]
    assert [tuple(r) for r in checks.duplicate_key_loads(holders).collect()] == [(2, 1)]


def test_stored_keys(spark):
    rows = _rows(spark, [(1, 1), (2, 2), (2, 3), (3, None)])
    stored = _rows(spark, [(0, 2), (0, 3), (0, 4), (0, None)]).drop("load")
    assert [tuple(r) for r in checks.stored_key_loads(rows, stored).collect()] == [(2, 2)]


def test_a_refused_load_refuses_nothing(spark):
    # 2 loses to 1, so 3 keeps the key it shares with 2; 4 loses to 3
    assert _refused(spark, [(1, 1), (2, 1), (2, 2), (3, 2), (3, 3), (4, 3)]) == {2, 4}


def test_long_chain(spark):
    held = [(load, key) for load in range(400) for key in (load, load + 1)]
    assert _refused(spark, held) == set(range(1, 400, 2))


def test_many_copies_of_one_file(spark):
    held = [(load, key) for load in range(300) for key in range(20)] + [(load, load) for load in range(300, 500)]
    assert _refused(spark, held) == set(range(1, 300))


def test_random_loads_like_one_by_one(spark):
    random.seed(3)
    for n_keys in (30, 120, 400):
        held = list({(random.randrange(60), random.randrange(n_keys)) for _ in range(300)})
        assert _refused(spark, held) == _refused_one_by_one(held)


def test_largest_load_number(spark):
    last = checks.MAX_LOADS - 1
    assert _refused(spark, [(0, 1), (last, 1)]) == {last}


def test_job_rows_take_names_found_once_per_route(spark):
    outcomes = spark.createDataFrame([(1, "k", None, "a,b", "t", T)], "seq bigint, key string, problem string, names string, feature_table string, at timestamp_ntz")
    row = jobs.job_rows(outcomes, F.col("at"), F.col("at"), F.col("names")).first()
    assert (row.id, row.status, row.entity_names, row.path) == (1, "success", "a,b", "k")

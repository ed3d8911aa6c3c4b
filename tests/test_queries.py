"""Each registered query against its SQL twin."""

import __spark_entry__ as entry
import oracle
import pytest


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_a_twin():
    """Text operators have their own tests; SQL cannot express all of them."""
    assert set(entry.queries()) - set(entry.TEXT_QUERIES) == set(entry.oracle_sql()) - set(entry.TEXT_SQL)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["id", "feature_table", "event_timestamp", "created_timestamp", "path", "rk"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.TEXT_QUERIES)))
def test_query(spark, sf_dir, con, name):
    frame = entry.queries()[name](spark, sf_dir)
    assert oracle.differences(frame, entry.oracle_sql()[name], con) is None

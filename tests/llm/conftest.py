from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import CLASHING, EDGE_ROWS, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows with extra columns whose names operators use themselves."""
    frame = spark.createDataFrame(EDGE_ROWS, SCHEMA)
    for i, name in enumerate(CLASHING):
        frame = frame.withColumn(name, frame.doc_id * i)
    return frame


@pytest.fixture(scope="session")
def empty(edge):
    return edge.filter("false")

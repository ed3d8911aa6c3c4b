from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from entidex.operators import lookups
from entidex.operators.latest import latest, latest_by_window, newest_event_per_load
from entidex.schemas import entity_schema

T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3))

ROWS = [
    # a newer event sits in an older load
    (1, "a", T1, T2, "p2"), (1, "a", T3, T1, "p1"),
    # same creation time, two paths; the greater path wins, with its newest event
    (2, "a", T3, T1, "p1"), (2, "a", T1, T1, "p2"), (2, "a", T2, T1, "p2"),
    # one id in two feature tables, all else equal
    (3, "a", T3, T1, "p"), (3, "b", T1, T1, "p"),
    # a path that is NULL comes first
    (4, "a", T1, T1, None), (4, "a", T2, T1, "z"),
    # a single row
    (5, "a", T1, T1, "p"),
]

LATEST = {
    1: ("a", T1, T2, "p2", 1),
    2: ("a", T2, T1, "p2", 1),
    3: ("b", T1, T1, "p", 1),
    4: ("a", T1, T1, None, 1),
    5: ("a", T1, T1, "p", 1),
}


def _two_steps(index):
    """The view as it is defined: newest event per load, then the first load per id."""
    order = Window.partitionBy("id").orderBy(
        F.desc_nulls_first("created_timestamp"), F.desc_nulls_first("path"), F.desc_nulls_first("feature_table")
    )
    return newest_event_per_load(index).withColumn("rk", F.row_number().over(order)).filter("rk = 1")


def test_latest(spark):
    index = spark.createDataFrame(ROWS, entity_schema("bigint"))
    for form in (latest, latest_by_window):
        assert {r.id: tuple(r)[1:] for r in form(index).collect()} == LATEST
    assert {r.id: r.path for r in _two_steps(index).collect()} == {k: v[3] for k, v in LATEST.items()}


def test_forms_agree_on_random_rows(spark):
    rows = spark.range(20_000).select(
        # one id holds a third of the rows
        F.when(F.rand(1) < 0.33, 0).otherwise((F.rand(2) * 500).cast("bigint")).alias("id"),
        F.concat(F.lit("t"), (F.rand(3) * 3).cast("int").cast("string")).alias("feature_table"),
        F.timestamp_add("DAY", (F.rand(4) * 50).cast("int"), F.lit(T1)).cast("timestamp_ntz").alias("event_timestamp"),
        F.timestamp_add("DAY", (F.rand(5) * 5).cast("int"), F.lit(T1)).cast("timestamp_ntz").alias("created_timestamp"),
        F.when(F.rand(6) > 0.1, F.concat(F.lit("p"), (F.rand(7) * 9).cast("int").cast("string"))).alias("path"),
    )
    index = spark.createDataFrame(rows.collect(), entity_schema("bigint"))
    columns = [*index.columns, "rk"]
    expected = sorted(map(str, _two_steps(index).select(*columns).collect()))
    assert len(expected) > 400
    for form in (latest, latest_by_window):
        assert sorted(map(str, form(index).select(*columns).collect())) == expected


def test_span_over_table_and_view(spark):
    index = spark.createDataFrame(ROWS, entity_schema("bigint"))
    assert {r.id for r in lookups.in_span(index, "2024-01-03", "2024-01-03").collect()} == {1, 2, 3}
    assert {r.id for r in lookups.latest_in_span(index, "2024-01-03", "2024-01-03").collect()} == set()
    assert {r.id for r in lookups.latest_in_span(index, T2, T3).collect()} == {2}


def _plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_plans(spark, tmp_path):
    spark.createDataFrame(ROWS, entity_schema("bigint")).write.parquet(str(tmp_path / "ix"))
    index = spark.read.parquet(str(tmp_path / "ix"))
    assert _plan(latest(index)).count("Exchange hashpartitioning") + _plan(latest(index)).count(") Exchange") == 1
    by_window = _plan(latest_by_window(index))
    assert by_window.count(") Exchange") == 1 and "Partial" in by_window
    one_id = _plan(latest(index).filter("id = 1"))
    assert "EqualTo(id,1)" in one_id
    span = _plan(lookups.in_span(index, T1, T2))
    assert "GreaterThanOrEqual(event_timestamp" in span and "LessThanOrEqual(event_timestamp" in span
    # The span of the view must stay above it.
    assert "PushedFilters: [GreaterThan" not in _plan(lookups.latest_in_span(index, T1, T2))

import random
import re
from datetime import datetime
from pathlib import PurePosixPath
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from entidex.functions import keys, patterns, values
from entidex.operators.routes import candidate_locations, matching_locations
from entidex.storage import bare

KEYS = [
    "name.parquet", "lake/a/b.parquet", "lake//a/./b.parquet", "/lake/a.parquet", "//lake/a", "///lake/a", "lake/a/",
    "./lake/a", "", ".", "./", "..", "../a/b", "lake/..", "lake/a b%20/c+d.parquet", "lake\\a/b", "/", "//", "a/b/",
    "/a", "lake/.hidden/x", "lake/...", "ä/ö.parquet",
]


def test_keys_like_posix_paths(spark):
    random.seed(1)
    generated = ["".join(random.choices("ab./", k=random.randint(0, 9))) for _ in range(500)]
    frame = spark.createDataFrame([(k,) for k in KEYS + generated], "k string")
    key = F.col("k")
    rows = frame.select(
        "k", keys.normalized(key), keys.bucket_of(key), keys.object_of(key), keys.parent_of(key)
    ).collect()
    for row in rows:
        path = PurePosixPath(row.k)
        bucket = path.parts[0] if path.parts else None
        expected = (str(path), bucket, str(PurePosixPath(*path.parts[1:])), str(path.parent))
        assert tuple(row)[1:] == expected, row.k


def _like(text, pattern):
    """SQL LIKE with backslash as escape."""
    out, chars = "", iter(pattern)
    for c in chars:
        if c == "\\":
            out += re.escape(next(chars))
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
    return re.fullmatch(out, text, re.S) is not None


@pytest.mark.parametrize("literal", [False, True])
def test_locations_match_like_every_pair_compared(spark, literal):
    random.seed(2)
    word = lambda low, high: "".join(random.choices("ab/_%\\", [4, 4, 3, 1, 1, 1], k=random.randint(low, high)))
    parents = sorted({word(0, 6) for _ in range(150)} | {"lake/a", "lake/a_b", "_", "%", "__", "x" * 40})
    urls = sorted({word(0, 40) for _ in range(150)} | {"s3://lake/ab/", "s3://lake/a_b/", "s3://lake/axb", "x" * 41})
    found = matching_locations(
        spark.createDataFrame([(p,) for p in parents], "parent string"),
        spark.createDataFrame([(u,) for u in urls], "file_url string"),
        literal,
    ).collect()
    if literal:
        expected = {(p, u) for p in parents for u in urls if p in u}
    else:
        expected = {(p, u) for p in parents for u in urls if _like(u, f"%{p}%")}
    assert len(found) == len(expected)
    assert {tuple(r) for r in found} == expected


def test_anchor_widths(spark):
    frame = spark.createDataFrame([("x" * 70,), ("abc",), ("_",)], "p string")
    pattern = patterns.containing_pattern(F.col("p"))
    anchors = [set(r[0]) for r in frame.select(patterns.anchors_of(pattern)).collect()]
    key = lambda gram: frame.select(F.xxhash64(F.lit(gram))).first()[0]
    assert anchors == [{key("x" * 32)}, {key("ab"), key("bc")}, {key("")}]


def test_tiles_cover_every_piece(spark):
    """What tells a name apart is in some tile, wherever it is; every tile is offered by a match."""
    name = "lake/" + "".join(chr(97 + i % 26) for i in range(90)) + "/v1"
    others = [name[:at] + "~" + name[at + 1 :] for at in range(len(name))]
    frame = spark.createDataFrame([(text,) for text in [name, *others]], "p string")
    rows = frame.select("p", patterns.anchors_of(F.col("p")).alias("anchors"), patterns.grams_of(F.concat(F.lit("s3a://"), "p", F.lit("/"))).alias("grams")).collect()
    offered = next(set(r.grams) for r in rows if r.p == name)
    assert [r.p for r in rows if set(r.anchors) <= offered] == [name]


def test_names_that_differ_at_the_end_are_no_pairs(spark):
    names = spark.range(2000).select(F.format_string("lake/features/table_%06d", "id").alias("parent"))
    urls = names.select(F.concat(F.lit("s3a://"), "parent", F.lit("/")).alias("file_url"))
    assert matching_locations(names, urls).count() == 2000
    assert candidate_locations(names, urls).count() < 20_000


def test_micros_in_any_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            frame = spark.createDataFrame([(-1,), (1_700_000_000_123_456,), (None,)], "m bigint")
            rows = frame.select(values.from_epoch_micros(F.col("m")).alias("t")).select(
                "t", values.to_epoch_micros(F.col("t")).alias("m")
            )
            assert [tuple(r) for r in rows.collect()] == [
                (datetime(1969, 12, 31, 23, 59, 59, 999999), -1),
                (datetime(2023, 11, 14, 22, 13, 20, 123456), 1_700_000_000_123_456),
                (None, None),
            ]
            zoned = spark.sql("select timestamp'2024-01-01 00:00:00Z' as t")
            assert zoned.select(values.as_wall_time(F.col("t"), "timestamp")).first()[0] == datetime(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_type_mapping(spark):
    frame = spark.createDataFrame([(t,) for t in ("INT64", "int64", "Bool", "STRING", None)], "t string")
    assert [r[0] for r in frame.select(values.id_type(F.col("t"))).collect()] == [
        "bigint", "bigint", "boolean", None, None,
    ]


def test_json_field(spark):
    frame = spark.createDataFrame([('{"file_url": "u"}',), ("{broken",), ("{}",), (None,)], "j string")
    assert [r[0] for r in frame.select(values.json_field(F.col("j"), "file_url")).collect()] == ["u", None, None, None]


def test_locations_compare_without_scheme_and_escapes():
    for location, uri in [
        ("file:/tmp/a b+%20[1].parquet", "file:///tmp/a%20b+%2520%5B1%5D.parquet"),
        ("s3a://lake/a/b", "s3a://lake/a/b"),
        ("hdfs://host:8020/lake/ä", "hdfs://host:8020/lake/%C3%A4"),
    ]:
        assert bare(location) == bare(unquote(uri))

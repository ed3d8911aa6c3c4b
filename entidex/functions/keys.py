"""Object keys as paths: bucket, object key, parent directory.

A key is read like a POSIX path: empty and `.` segments vanish, `..` stays, one
leading slash (or exactly two) is a root of its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _root(key: Column) -> Column:
    return (
        F.when(key.rlike("^//([^/]|$)"), F.lit("//"))
        .when(key.startswith("/"), F.lit("/"))
        .otherwise(F.lit(""))
    )


def _segments(key: Column) -> Column:
    return F.filter(F.split(key, "/"), lambda s: ~s.isin("", "."))


def _or_dot(path: Column) -> Column:
    return F.when(path == "", F.lit(".")).otherwise(path)


def normalized(key: Column) -> Column:
    """The key without empty and `.` segments; `.` if nothing is left."""
    return _or_dot(F.concat(_root(key), F.array_join(_segments(key), "/")))


def bucket_of(key: Column) -> Column:
    """First part of the key: its root if it has one, else its first segment; NULL if empty."""
    return F.when(_root(key) != "", _root(key)).otherwise(F.get(_segments(key), F.lit(0)))


def object_of(key: Column) -> Column:
    """The key without its first part; `.` if nothing is left."""
    segments = _segments(key)
    rest = F.when(_root(key) != "", segments).otherwise(F.slice(segments, 2, F.greatest(F.size(segments), F.lit(1))))
    return _or_dot(F.array_join(rest, "/"))


def parent_of(key: Column) -> Column:
    """Directory of the key, bucket included; `.` for a bare name."""
    segments = _segments(key)
    above = F.slice(segments, F.lit(1), F.greatest(F.size(segments) - 1, F.lit(0)))
    return _or_dot(F.concat(_root(key), F.array_join(above, "/")))

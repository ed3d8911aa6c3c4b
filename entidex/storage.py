"""Paths on the shared file system, through the session's own Hadoop file systems."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """A new folder for tables that live during one run: below `spark.checkpoint.dir`.

    Where that is unset, below the warehouse, which all executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{qualified(spark, base)}/entidex-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, without trailing slash."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.makeQualified(hadoop_path).toString().rstrip("/")


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match a glob pattern."""
    fs, hadoop_path = _file_system(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(hadoop_path) or []]


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder; what leads to the target is made."""
    fs, hadoop_path = _file_system(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(hadoop_path, to):
        raise OSError(f"cannot rename {source} to {target}")


def literal_path(path: str) -> str:
    """The path with glob characters escaped, so that a reader takes it as it is."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def files_by_location(frame: DataFrame) -> dict[str, str]:
    """URI of each file of a scan, as `input_file_name` shows it, by its `bare` location."""
    return {bare(unquote(uri)): uri for uri in frame.inputFiles()}


def bare(location: str) -> str:
    """A location without scheme and slashes before its first name."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*:)?/*", "", location)

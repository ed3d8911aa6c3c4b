"""A small bucket with a registry, for ingest tests."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq

from entidex.sources.registry import Registry
from entidex.store import EntityIndex

NOW = 1_700_000_000_000_000  # 2023-11-14 22:13:20 in epoch microseconds
START = datetime(2024, 1, 1)


class Store:
    """Files below `root`/data, the index at `root`/index."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.data = f"{self.root}/data"
        self.index = EntityIndex(spark, f"{self.root}/index")

    def put(self, key: str, **columns) -> str:
        path = f"{self.data}/{key}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        pq.write_table(pa.table(columns), path)
        return key

    def rows(self, key: str, ids, events=None, created=NOW) -> str:
        """A file of the single-entity feature table `trips`."""
        events = events or [NOW] * len(ids)
        return self.put(
            key, driver=pa.array(ids, pa.int64()), ev=pa.array(events, pa.int64()), cr=pa.array([created] * len(ids), pa.int64())
        )

    def notifications(self, *events):
        """Created events for keys, or (event name, key) pairs, one second apart."""
        named = [e if isinstance(e, tuple) else ("s3:ObjectCreated:Put", e) for e in events]
        rows = [(name, key, START + timedelta(seconds=i)) for i, (name, key) in enumerate(named)]
        return self.spark.createDataFrame(rows, "event_name string, key string, received_at timestamp_ntz")

    def outcomes(self) -> list[tuple]:
        """(path, message) in arrival order."""
        return [(r.path, r.status_msg) for r in self.index.jobs().orderBy("id").collect()]

    def index_rows(self, entity: str = "driver") -> list[tuple]:
        rows = self.index.entity(entity).select(
            "id", "feature_table", "event_timestamp", "created_timestamp", "path"
        )
        return sorted(map(tuple, rows.collect()))


def registry(spark, *sources) -> Registry:
    """Registry of (directory, feature table, {entity: type}, other settings)."""
    ds, ft, fte, en, projects = [], [], [], [], {"p": False}
    for i, (directory, table, entities, *settings) in enumerate(sources):
        s = dict(*settings)
        project = s.get("project", "p")
        projects[project] = s.get("archived", projects.get(project, False))
        config = s.get("config", json.dumps({"file_url": f"s3a://{directory}/"}))
        ds.append((i, config, s.get("ev", "ev"), s.get("cr", "cr")))
        ft.append((i, table, i, project, s.get("deleted", False)))
        for name, kind in entities.items():
            fte.append((i, len(en)))
            en.append((len(en), name, kind))
    frame = spark.createDataFrame
    return Registry(
        frame(ds, "id bigint, config string, timestamp_column string, created_timestamp_column string"),
        frame(ft, "id bigint, name string, batch_source_id bigint, project_name string, is_deleted boolean"),
        frame(fte, "feature_table_id bigint, entity_v2_id bigint"),
        frame(en, "id bigint, name string, type string"),
        frame(list(projects.items()), "name string, archived boolean"),
    )

"""A data source that upserts rows into a REST table: ``df.write.format("rest_upsert")``.

Rows go out in batches, POSTed to ``url``/``table`` with merge-on-conflict by ``key``, so sending a batch again, as a
repeated or speculative task does, changes nothing.  Requests wait and repeat on 429 and server errors.

With ``staging`` the write is all or nothing: tasks fill that table under the write's own ``run``; when all have
ended the driver asks ``url``/rpc/``commit`` to merge it, telling how many rows of how many tasks it should
find, and when the write fails it deletes the run's rows.  Rows of a task that was killed half way have the same keys as
those of its repetition, so the merge finds each once.

Options: ``url``, ``table``, ``key`` (JSON list or one name), ``batch`` (50), ``pause`` (seconds between batches, 0.1), ``staging``,
``commit`` (name of the merging call), ``tries``, ``wait``, ``headers`` (JSON).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tablemill.operators import dedup
from tablemill.sources import web

BATCH = 50


@dataclass
class Sent(WriterCommitMessage):
    """What a task has sent; ``keys`` counts distinct ones."""

    partition: int
    rows: int
    keys: int
    batches: int


class UpsertSource(DataSource):
    """See the module."""

    @classmethod
    def name(cls) -> str:
        return "rest_upsert"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("rest_upsert merges rows; use mode('append')")
        return _Writer(dict(self.options), schema)


class _Writer(DataSourceWriter):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.url, self.table, self.staging = options["url"].rstrip("/"), options["table"], options.get("staging")
        key = options.get("key", "job_id")
        self.key = json.loads(key) if key.startswith("[") else [key]
        missing = set(self.key) - set(schema.names)
        if missing:
            raise ValueError(f"no such key columns: {sorted(missing)}")
        self.batch, self.pause = int(options.get("batch", BATCH)), float(options.get("pause", 0.1))
        self.call_name = options.get("commit", f"merge_{self.table}")
        self.patience = web.Patience(int(options.get("tries", 5)), float(options.get("wait", 2.0)))
        self.headers = {"Prefer": "resolution=merge-duplicates,return=minimal", **json.loads(options.get("headers", "{}"))}
        self.run = uuid.uuid4().hex  # of the whole write: the writer is made once and sent to all tasks

    def write(self, rows: Iterator[Row]) -> Sent:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        target = web.query(f"{self.url}/{self.staging or self.table}", on_conflict=",".join([*self.key, "run"] if self.staging else self.key))
        sent, batches, keys, held = 0, 0, set(), {}

        def send() -> None:
            nonlocal sent, batches
            if batches and self.pause:
                time.sleep(self.pause)
            web.call("POST", target, list(held.values()), self.headers, self.patience)
            sent, batches = sent + len(held), batches + 1
            held.clear()

        for row in rows:
            values = {k: v for k, v in row.asDict(recursive=True).items() if not k.startswith("_")}
            if self.staging:
                values["run"] = self.run
            name = tuple(values[k] for k in self.key)
            keys.add(hash(name))
            held[name] = values  # one request must not name a key twice
            if len(held) == self.batch:
                send()
        if held:
            send()
        return Sent(part, sent, len(keys), batches)

    def commit(self, messages: list[Sent | None]) -> None:
        if self.staging:
            done = [m for m in messages if m is not None]
            body = {"run": self.run, "rows": sum(m.keys for m in done), "tasks": len(done)}
            web.call("POST", f"{self.url}/rpc/{self.call_name}", body, self.headers, self.patience)

    def abort(self, messages: list[Sent | None]) -> None:
        if self.staging:
            web.call("DELETE", web.query(f"{self.url}/{self.staging}", run=f"eq.{self.run}"), None, self.headers, self.patience)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(UpsertSource)


def upsert(df: DataFrame, url: str, table: str, key: list[str], order: list[str] | None = None, **options) -> None:
    """Send ``df``, the last row of each key (by ``order``, then by all columns; null keys are one key), to a REST table."""
    register(df.sparkSession)
    from pyspark.sql import functions as F

    whole = df.withColumn("_at", F.struct(*(F.col(f"`{k}`") for k in key)))
    last = dedup.last_of(whole, "_at", order or df.columns).drop("_at")
    last.write.format("rest_upsert").mode("append").options(url=url, table=table, key=json.dumps(key), **options).save()

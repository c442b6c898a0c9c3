"""Incremental ingestion: late repeats of a key are dropped, batches are merged by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablemill.operators.dedup import upsert
from tablemill.sources import store

BUCKETS = 32


def first_seen(stream: DataFrame, key: str, time_col: str, delay: str = "2 days") -> DataFrame:
    """The first event of each key within ``delay``; state older than that is dropped."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])


def _versions(spark: SparkSession, path: str, before: int | None = None) -> dict[str, list[int]]:
    """Versions of each bucket, newest first; those from ``before`` on are left out."""
    found: dict[str, list[int]] = {}
    for version in store.children(spark, path, "version="):
        number = int(version.removeprefix("version="))
        if before is None or number < before:
            for bucket in store.children(spark, f"{path}/{version}", "bucket="):
                found.setdefault(bucket, []).append(number)
    return {b: sorted(v, reverse=True) for b, v in found.items()}


def current(spark: SparkSession, path: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The newest version of every bucket (or of ``buckets``) of a merged table; None if there is none."""
    wanted = None if buckets is None else {f"bucket={b}" for b in buckets}
    paths = [f"{path}/version={v[0]}/{b}" for b, v in sorted(_versions(spark, path, before).items()) if wanted is None or b in wanted]
    return spark.read.parquet(*paths) if paths else None


def merge_into(stream: DataFrame, path: str, key: str, order: list[str], checkpoint: str, buckets: int = BUCKETS, **options: str) -> StreamingQuery:
    """Merge every micro-batch by key into the table at ``path`` (read it by ``current``).

    Rows lie in buckets by a hash of the key.  A batch rewrites the buckets it touches, under a version
    named after the batch and from versions before it, so a repeated batch rewrites its own version and
    nothing is merged twice.  The last row by ``order`` stays, in whatever batch it came.  Versions
    that two later ones have replaced are deleted.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = [r[0] for r in rows.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        stored = current(spark, path, number, touched)
        merged = upsert(batch.limit(0) if stored is None else stored, batch, key, order)
        merged = merged.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={number}")
        for bucket, versions in _versions(spark, path).items():
            for old in versions[2:]:
                store.delete(spark, f"{path}/version={old}/{bucket}")

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).options(**options)
    return writer.trigger(availableNow=True).start()

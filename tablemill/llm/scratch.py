"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.functions.batches import short_batches as short_batches

#: Ids that may be broadcast: about 24 bytes each, so 12 MB at most.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir.  Only where that is unset and driver and executors are one
    process (tests), a folder of our own; on a cluster executors would not see it, so that is an error."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tablemill-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def ship(spark: SparkSession, path: str) -> str:
    """Send a file of the driver's to every executor; ``shipped`` opens it there by the name returned."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shipped(name: str) -> str:
    from pyspark import SparkFiles

    return SparkFiles.get(name)


_OWN = f"run-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    """This driver's folder within the shared one; it goes when the driver ends, or by ``clear``."""
    path = f"{shared_dir(spark)}/tablemill/{_OWN}"
    if path not in _used:
        _used[path] = spark
        atexit.register(_clear_quietly, path)
    return path


_used: dict[str, SparkSession] = {}


def clear(spark: SparkSession) -> None:
    """Delete all that ``store`` wrote for this driver; frames made from it can't be read afterwards."""
    for path in list(_used):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
        _used.pop(path)


def _clear_quietly(path: str) -> None:
    spark = _used.get(path)
    if spark is not None and spark.sparkContext._jsc is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone; whoever owns the folder empties it then
            clear(spark)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends here, and a
    lost executor costs a re-read instead of the work before it."""
    path = f"{_own_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(ids: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``ids`` with a broadcast hint if it is proven to hold at most ``limit`` rows; else Spark shuffles."""
    few = ids.limit(limit + 1).count() <= limit
    return F.broadcast(ids) if few else ids

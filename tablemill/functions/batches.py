"""Arrow batches of texts: bounded, with freed memory given back between them."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1_000
#: Bytes of an Arrow batch, beyond which it ends.
BATCH_BYTES = 4 << 20

_libc = ctypes.CDLL(None)


def short_batches(spark: SparkSession) -> None:
    """Cap the rows and bytes of an Arrow batch: a row may hold a long text, and both the JVM (outside its
    heap) and the Python worker hold whole batches.  Smaller settings of the session's own stay; Spark
    reads them when a plan runs, so they hold from now on."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(key).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Return freed memory to the system.  Workers outlive their tasks, and what one stage's arrays leave in the
    allocator would be held beside the next stage's."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)

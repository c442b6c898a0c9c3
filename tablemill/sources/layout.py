"""Tables laid out for retention: folders by month, buckets by job.

Old rows are then whole folders, which a scan skips, and rows without a job are found bucket by bucket:
two tables in as many buckets of the same key join without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.operators import retention

BUCKETS = 64
#: Folder of rows whose day is unknown.
NO_MONTH = "none"


def month(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH))


def write(df: DataFrame, table: str, key: str = "job_id", day: Column | None = None, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """Save ``df`` as a catalog table in ``buckets`` by ``key``, sorted in each, and with ``day`` in folders by posted_month.

    Rows are dealt to their buckets first, so each bucket of a folder is one file."""
    rows = df if day is None else df.withColumn("posted_month", month(day))
    writer = rows.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if day is not None:
        writer = writer.partitionBy("posted_month")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def older_than(table: DataFrame, day: Column, today: str, days: int) -> DataFrame:
    """Rows of a table with folders whose ``day`` is more than ``days`` before ``today`` (yyyy-mm-dd): folders of later months are not read."""
    asof = F.lit(today).cast("date")
    last = table.sparkSession.range(1).select(F.date_format(F.date_sub(asof, days), "yyyy-MM")).first()[0]  # a constant prunes at planning
    return table.filter((F.col("posted_month") <= last) & (F.col("posted_month") != NO_MONTH)).filter(retention.is_old(day, asof, days))


def drop_older(spark: SparkSession, table: str, to: str, day: Column, today: str, days: int, key: str = "job_id", buckets: int = BUCKETS) -> DataFrame:
    """``table`` without its old rows, as table ``to`` of the same layout."""
    rows = spark.table(table)
    keep = rows.filter(~retention.is_old(day, F.lit(today).cast("date"), days)).drop("posted_month")
    return write(keep, to, key, day, buckets)

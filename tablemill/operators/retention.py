"""Retention: orphans, date windows, archive before delete."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def posted_day(text: Column) -> Column:
    """The date a text begins with; null where it does not begin with one."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10).try_cast("date"))


def is_old(day: Column, today: Column, days: int) -> Column:
    return F.coalesce(day < F.date_sub(today, days), F.lit(False))


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows without a parent; a null key has none."""
    return rows.join(parents.select(F.col(parent_key or key).alias(key)), key, "left_anti").select(rows.columns)


def old_rows(rows: DataFrame, parents: DataFrame, key: str, day: Column, today: Column, days: int) -> DataFrame:
    """Rows whose parent (unique by key) is older than ``days``; ``day`` is over the parents' columns."""
    old = parents.filter(is_old(day, today, days)).select(key)
    return rows.join(old, key).select(rows.columns)


def window_counts(rows: DataFrame, parents: DataFrame, key: str, day: Column, today: Column, days: int) -> DataFrame:
    """chunks_inside_window, chunks_outside_window, chunks_without_jobs in one row."""
    side = parents.select(key, day.alias("_day"), F.lit(True).alias("_there"))
    joined = rows.select(key).join(side, key, "left")
    limit = F.date_sub(today, days)
    return joined.agg(
        F.count_if(F.col("_day") >= limit).alias("chunks_inside_window"), F.count_if(F.col("_day") < limit).alias("chunks_outside_window"),
        F.count_if(F.col("_there").isNull()).alias("chunks_without_jobs"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, n of every table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        out = one if out is None else out.unionAll(one)
    return out


@dataclass
class Target:
    """Rows of one table to clean up, told by the table's id column."""

    name: str
    table: str
    description: str
    rows: DataFrame


def targets(jobs: DataFrame, details: DataFrame, chunks: DataFrame, today: Column, days: int, skip_orphans: bool = False, skip_old: bool = False) -> list[Target]:
    out = []
    if not skip_orphans:
        out.append(Target("orphan_job_details", "job_details", "details without a job", orphans(details, jobs, "job_id")))
        out.append(Target("orphan_job_chunks", "job_chunks", "chunks without a job", orphans(chunks, jobs, "job_id")))
    if not skip_old:
        rows = old_rows(chunks, jobs, "job_id", posted_day(F.col("posted_date")), today, days)
        out.append(Target(f"old_job_chunks_older_than_{days}d", "job_chunks", f"chunks of jobs posted more than {days} days ago", rows))
    return out


def survivors(df: DataFrame, gone: list[DataFrame], id_col: str = "id") -> DataFrame:
    """``df`` without the rows of ``gone``: one anti join, whatever the number of deletions."""
    ids = None
    for g in gone:
        ids = g.select(id_col) if ids is None else ids.unionAll(g.select(id_col))
    return df if ids is None else df.join(ids.distinct(), id_col, "left_anti").select(df.columns)

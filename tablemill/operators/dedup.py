"""Deduplication and upserts by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.operators import order


def keep_first(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; rows whose key is null or '' go.

    The first row is the minimum of (order, row): an aggregate that combines before the shuffle, so
    a key that holds many rows is not gathered in one task.  ``order`` must end in a unique column.
    """
    rows = df.select(key.alias("_key"), F.struct(*order, F.struct(*df.columns).alias("_row")).alias("_first"))
    rows = rows.filter(F.col("_key").isNotNull() & (F.col("_key").cast("string") != ""))
    best = rows.groupBy("_key").agg(F.min_by("_first", F.struct(*(F.col(f"_first.{c}") for c in order))).alias("_first"))
    return best.select("_first._row.*")


def url_key(*columns: str) -> Column:
    """The first non-blank of the columns, trimmed; blank and 'nan' count as missing."""
    clean = lambda c: F.nullif(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit("nan"))
    return F.coalesce(*map(clean, columns))


def first_by_url(df: DataFrame, order: list[str], seen: DataFrame | None = None, url_cols: tuple[str, ...] = ("job_url", "job_url_direct")) -> DataFrame:
    """First row of each URL that ``seen`` (column url) does not hold."""
    rows = keep_first(df, url_key(*url_cols), order)
    if seen is None:
        return rows
    return rows.withColumn("_url", url_key(*url_cols)).join(seen.select(F.col("url").alias("_url")).distinct(), "_url", "left_anti").drop("_url")


def flag_shared_urls(df: DataFrame, url_cols: tuple[str, ...] = ("url", "company_url"), into: str = "has_url_duplicate") -> DataFrame:
    """1 where any of the URLs (lower case, without trailing slashes) is on another row as well.

    Counts come from an aggregate joined back, not a window: a URL on a third of all rows is one
    counted row on the other side of a join that can be split.
    """
    out, hits = df, []
    for k, c in enumerate(url_cols):
        key, many = f"_u{k}", f"_n{k}"
        out = out.withColumn(key, F.nullif(F.regexp_replace(F.lower(F.col(c)), "/+$", ""), F.lit("")))
        shared = out.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(many)).filter(F.col(many) > 1)
        out = out.join(shared, key, "left")
        hits.append(F.col(many).isNotNull())
    flagged = hits[0]
    for h in hits[1:]:
        flagged |= h
    return out.select(*df.columns, flagged.cast("int").alias(into))


def newest_duplicates(df: DataFrame, keys: list[str], id_col: str = "id", newest: int | None = None) -> DataFrame:
    """Ids to delete: among the ``newest`` rows by id (all, if None), those that are not the oldest of
    their key.  Null keys are one key.

    Where the newest rows begin is found by counting ids, not by sorting rows into one task, so any number
    will do.  Ids are unique; rows whose id equals that of the last one are among the newest, rows without
    an id only if all are.
    """
    rows = df.select(id_col, *keys)
    first = order.newest_from(rows, id_col, newest) if newest is not None and newest > 0 else None
    if first is not None:
        rows = rows.filter(F.col(id_col) >= first)
    elif newest is not None and newest <= 0:
        rows = rows.limit(0)
    oldest = rows.groupBy(*keys).agg(F.min(id_col).alias("_oldest"))
    same = None
    for k in keys:
        cond = rows[k].eqNullSafe(oldest[k])
        same = cond if same is None else same & cond
    return rows.join(oldest, same).filter(rows[id_col] > F.col("_oldest")).select(rows[id_col])


def drop_newest_duplicates(df: DataFrame, keys: list[str], id_col: str = "id", newest: int | None = None) -> DataFrame:
    return df.join(newest_duplicates(df, keys, id_col, newest), id_col, "left_anti")


def last_of(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key by ``order``, then by all columns; an aggregate that combines before the shuffle."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return df.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, F.struct(F.struct(*order), row)).alias("_row")).select("_row.*")


def upsert(stored: DataFrame, incoming: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """``stored`` with rows of ``incoming`` replacing those of the same key.

    With ``order`` the last row of each key stays, wherever it is: an older one that comes late replaces
    nothing; of rows that are level by it the incoming one stays.  Without, incoming rows replace
    stored ones, and of several the greatest by all columns stays.  Rows without key are added, one
    of them from each batch.  Columns that one side lacks are null.
    """
    incoming = last_of(incoming, key, order or [c for c in incoming.columns if c != key])
    if order and set(order) <= set(stored.columns):
        have = stored.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct(*order)).alias("_have"))
        both = incoming.withColumn("_new", F.struct(*order)).join(have, F.col(key) == F.col("_key"), "left")
        incoming = both.filter(F.col("_have").isNull() | (F.col("_new") >= F.col("_have"))).drop("_key", "_have", "_new")
    return stored.join(incoming.select(key), key, "left_anti").select(stored.columns).unionByName(incoming, allowMissingColumns=True)

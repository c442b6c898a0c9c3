"""Profiling aggregates: one pass over the data for all columns where possible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.operators import order


def _rows(wide: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per column from a one-row frame with <name>_<k> columns."""
    parts = ", ".join(f"'{c}', " + ", ".join(f"`{n}_{k}`" for n in names) for k, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {parts}) as (column, {', '.join(names)})")


def fill_rate(df: DataFrame, columns: Sequence[str], empty: Sequence[str] = ("",)) -> DataFrame:
    """column, filled, rate: values neither null nor in ``empty``, and their percentage (2 places)."""
    filled = lambda c: F.col(c).isNotNull() & ~F.col(c).cast("string").isin(*empty)
    aggs = [F.count_if(filled(c)).alias(f"filled_{k}") for k, c in enumerate(columns)]
    total = F.count("*")
    aggs += [F.round(F.try_divide(F.count_if(filled(c)) * F.lit(100.0), total), 2).alias(f"rate_{k}") for k, c in enumerate(columns)]
    return _rows(df.agg(*aggs), columns, ["filled", "rate"])


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, n_distinct: exact, without null and ''.

    Values are made distinct per column by one aggregation over (column, value) pairs, not by one
    expanding aggregate per column.
    """
    pairs = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns))).alias("p")).select("p.*")
    found = pairs.filter("v is not null and v != ''").distinct().groupBy("column").agg(F.count("*").alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(found, "column", "left").select("column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))


def value_distribution(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """value, n, percent of all rows; nulls left out; most frequent first, then by value."""
    n_all = df.agg(F.count("*").alias("_all"))
    out = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    out = out.crossJoin(F.broadcast(n_all)).select("value", "n", F.round(F.col("n") * 100.0 / F.col("_all"), 2).alias("percent"))
    return out.orderBy(F.desc("n"), "value").limit(top) if top else out


def mapping_matrix(df: DataFrame, original: str, standard: str) -> DataFrame:
    """original, standard, n; rows with a null in either left out."""
    return df.filter(F.col(original).isNotNull() & F.col(standard).isNotNull()).groupBy(F.col(original).alias("original"), F.col(standard).alias("standard")).agg(F.count("*").alias("n"))


def tag_counts(df: DataFrame, column: str) -> DataFrame:
    """tag, n of a ', '-joined list column."""
    tags = df.select(F.explode(F.split(F.col(column), ",")).alias("tag"))
    return tags.select(F.trim("tag").alias("tag")).filter("tag != ''").groupBy("tag").agg(F.count("*").alias("n"))


def bucket_histogram(df: DataFrame, value: Column, bounds: Sequence[tuple[int, int | None]]) -> DataFrame:
    """bucket, n over closed ranges; an open end is None.  Every bucket has a row."""
    label = lambda lo, hi: f"{lo}+" if hi is None else f"{lo}" if lo == hi else f"{lo}-{hi}"
    inside = lambda lo, hi: value >= lo if hi is None else value.between(lo, hi)
    names = [label(*b) for b in bounds]
    wide = df.agg(*(F.count_if(inside(*b)).alias(f"n_{k}") for k, b in enumerate(bounds)))
    return _rows(wide, names, ["n"]).withColumnRenamed("column", "bucket")


FREQUENCY_BUCKETS = [(0, 0), (1, 2), (3, 5), (6, 10), (11, 15), (16, 20), (21, None)]


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, mean (2 places), maximum and exact median (by counting passes); nulls when a column has no values."""
    aggs = []
    for k, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [F.round(F.avg(v), 2).alias(f"mean_{k}"), F.max(v).alias(f"maximum_{k}")]
    medians = order.quantiles(df, columns)
    wide = df.agg(*aggs).withColumns({f"median_{k}": F.lit(medians[c]).cast("double") for k, c in enumerate(columns)})
    return _rows(wide, columns, ["mean", "maximum", "median"])


def reduction_percent(before: Column, after: Column) -> Column:
    """Mean share of the length that went, in percent; an empty original counts as one character."""
    a, b = F.char_length(F.coalesce(before, F.lit(""))), F.char_length(F.coalesce(after, F.lit("")))
    return F.avg((a - b) * 100.0 / F.greatest(a, F.lit(1)))


def cardinality_change(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """original, standard, n_original, n_standard: distinct values before and after (nulls left out)."""
    counts = {r["column"]: r["n_distinct"] for r in distinct_counts(df, sorted({c for p in pairs for c in p})).collect()}
    return df.sparkSession.createDataFrame([(a, b, counts[a], counts[b]) for a, b in pairs], "original string, standard string, n_original long, n_standard long")


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    return [c for c in after.columns if c not in before.columns]


def is_categorical(n_distinct: Column) -> Column:
    return (n_distinct > 1) & (n_distinct < 50)


def count_matrix(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Rows per ``row`` and value of ``column``, a column for each value."""
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0)


def changed_rows(before: DataFrame, after: DataFrame, key: str, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """column, n_changed: rows, matched by key, whose value differs between the two frames."""
    x, y = before.alias("x"), after.alias("y")
    both = x.join(y, F.col(f"x.{key}") == F.col(f"y.{key}"))
    wide = both.agg(*(F.count_if(~F.col(f"x.{a}").eqNullSafe(F.col(f"y.{b}"))).alias(f"n_changed_{k}") for k, (a, b) in enumerate(columns)))
    return _rows(wide, [b for _, b in columns], ["n_changed"])


def compare(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """keys, change, n_before, n_after of the keys whose rows differ between two versions of a table.

    change is added, removed or changed.  Rows are told by two hashes of ``columns`` (default: all that both have), and only
    these travel: one aggregate over both versions sums them by key and version, so repeated keys are compared
    as bags of rows, null keys as one key, and a key on very many rows is summed before it is shuffled.
    """
    columns = [c for c in before.columns if c in after.columns and c not in keys] if columns is None else list(columns)

    def side(df: DataFrame, sign: int) -> DataFrame:
        # A null is told from a text, and one column's text from the next one's.
        row = [F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string")) for c in columns] or [F.lit(0)]
        digest = F.sha2(F.to_json(F.struct(*(r.alias(f"c{k}") for k, r in enumerate(row)))), 256)
        part = lambda at: F.conv(F.substr(digest, F.lit(at), F.lit(13)), 16, 10).cast("decimal(38,0)")
        return df.select(*keys, F.lit(sign).alias("_sign"), part(1).alias("_one"), part(14).alias("_two"))

    both = side(before, 1).unionByName(side(after, -1))
    sums = both.groupBy(*keys).agg(
        F.count_if(F.col("_sign") > 0).alias("n_before"), F.count_if(F.col("_sign") < 0).alias("n_after"),
        *((F.sum(F.col(c) * F.col("_sign")) != 0).alias(c) for c in ("_one", "_two")),
    )
    change = F.when(F.col("n_before") == 0, "added").when(F.col("n_after") == 0, "removed").when((F.col("n_before") != F.col("n_after")) | F.col("_one") | F.col("_two"), "changed")
    return sums.withColumn("change", change).filter("change is not null").select(*keys, "change", "n_before", "n_after")


def fixed_sample(df: DataFrame, key: str, positions: Sequence[int]) -> DataFrame:
    """position and row of the rows at the given places in the order of ``key`` (unique; nulls are not counted)."""
    wanted = sorted(set(positions))
    found = order.select_ranks(df.select(key), {key: wanted})[key]
    at = [(p, v) for p, v in zip(wanted, found) if v is not None]
    kind = df.schema[key].dataType.simpleString()
    places = df.sparkSession.createDataFrame(at, f"position int, `{key}` {kind}")  # one row a position
    return df.join(F.broadcast(places), key).select("position", *df.columns)

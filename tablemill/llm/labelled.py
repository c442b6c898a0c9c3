"""Bounded, evenly drawn samples of labelled rows for the fitted operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCALE = 1 << 40


def crc_mod(id_col: str, divisor: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def bounded_sample(rows: DataFrame, label: str, place: Column, per_label: int, max_labels: int, in_all: int | None = None) -> DataFrame:
    """About ``per_label`` rows (at most twice that in all) of each of the ``max_labels`` commonest
    labels, and about ``in_all`` rows altogether, chosen by the hash ``place`` so that the choice does
    not depend on partitioning.

    One aggregation over the labels alone finds each label's share; the rows are then taken by a
    filter, without sorting or gathering a label in one task.
    """
    counts = rows.filter(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label).limit(max_labels).collect()
    if in_all:
        per_label = min(per_label, max(1, in_all // max(1, len(counts))))
    bounds = [(value, min(_SCALE, int(_SCALE * per_label / count) + 1)) for value, count in counts]
    spark = rows.sparkSession
    kind = rows.schema[label].dataType.simpleString()
    table = F.broadcast(spark.createDataFrame(bounds, f"_label {kind}, _most long"))  # at most max_labels rows
    chosen = rows.join(table, (rows[label] == table["_label"]) & (F.pmod(place, F.lit(_SCALE)) < F.col("_most"))).drop("_label", "_most")
    return chosen.limit(2 * per_label * max(1, len(counts)))

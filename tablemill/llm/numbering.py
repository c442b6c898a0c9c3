"""Places of rows in the order of their group, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablemill.llm.scratch import small_or_shuffled, store


def numbered(rows: DataFrame, order: list[str], tree: str = "tree", total: str = "leaves") -> DataFrame:
    """``rows`` with position (from 0, by ``order``, among the rows of the same ``tree``) and, as ``total``, how many these are."""
    spread = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    # Partition and place in it, as one number; stored, so that it stays what it is.
    ordered = store(spread.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "ordered")
    earlier = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy(tree, "part").agg(F.min("at").alias("first"), F.count("*").alias("n")).select(
        tree, "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy(tree)).alias(total)
    )
    # One row for each group and partition that meet.
    found = ordered.join(small_or_shuffled(store(parts, "parts")), [tree, "part"])
    return found.withColumn("position", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")

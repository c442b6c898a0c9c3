"""Connected components of a link table, by hooking and pointer jumping over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm.scratch import store


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b: long); root is the smallest node
    of its component.

    Union-find in rounds: every root hooks onto the smallest root among its neighbours, the hooks
    are flattened by pointer jumping, and the links are contracted to the new roots.  Hooks point
    downwards only, so each round leaves at most half of the roots that still have links.  No
    round gathers a component in one task: the minimum is aggregated before the shuffle, and
    joins on a hot root are ordinary joins that adaptive execution can split.
    """
    edges = store(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi != lo").distinct(),
        "edges",
    )
    nodes = None
    for _ in range(max_rounds):
        if edges.isEmpty():
            break
        hooks = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root"))
        hooks = store(hooks, "hooks")
        while True:
            above = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = hooks.join(above, "root", "left").select(
                "node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")
            )
            jumped = store(jumped, "jumped")
            hooks = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        if nodes is None:
            roots = edges.join(hooks.select(F.col("node").alias("lo")), "lo", "left_anti")
            nodes = hooks.unionByName(roots.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        else:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
            nodes = nodes.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        hi = hooks.select(F.col("node").alias("hi"), F.col("root").alias("r_hi"))
        lo = hooks.select(F.col("node").alias("lo"), F.col("root").alias("r_lo"))
        moved = edges.join(hi, "hi", "left").join(lo, "lo", "left")
        ends = [F.coalesce("r_hi", "hi"), F.coalesce("r_lo", "lo")]
        edges = store(
            moved.select(F.greatest(*ends).alias("hi"), F.least(*ends).alias("lo")).filter("hi != lo").distinct(),
            "edges",
        )
    else:
        raise RuntimeError("components did not settle")
    if nodes is None:
        return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes

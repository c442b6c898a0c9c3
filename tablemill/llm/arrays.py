"""Column functions over arrays whose cost grows with their length and not with its square."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablemill.functions.rx import let


def running(values: Column, zero: Column, combine: Callable[[Column, Column], Column], kind: str = "int") -> Column:
    """Before each element, what ``combine`` (associative, ``zero`` neutral) makes of all earlier ones.

    An array that grows by one element is copied each time; so the values are scanned in blocks of about
    the root of their number, and then the blocks."""

    def scan(items: Column) -> Column:
        begin = F.struct(zero.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(items, begin, lambda acc, x: F.struct(combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def blocked(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.size(v) - 1, width), lambda b: scan(F.slice(v, b + 1, width)))
        before = lambda bs: scan(F.transform(bs, lambda b: b["at"]))["out"]
        return let(blocks, lambda bs: F.flatten(F.zip_with(bs, before(bs), lambda b, at: F.transform(b["out"], lambda x: combine(at, x)))))

    return let(values, lambda v: F.when(F.size(v) > 0, blocked(v)).otherwise(F.array().cast(f"array<{kind}>")))

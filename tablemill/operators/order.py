"""Exact order statistics by counting, whatever the number of distinct values.

A sort, a median aggregate or a limit brings values to one task.  Here each pass counts the values of a
shrinking interval in ``BINS`` bins; the bin that holds the wanted rank is the next interval.  What a pass
returns is at most ``BINS`` counts a rank, and a few passes do: one divides the interval by ``BINS``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

BINS = 1_024


@dataclass
class _Target:
    """A wanted rank (from 0) among the values of ``column`` within [low, high], of which ``before`` values are left of low."""

    column: str
    rank: int
    low: float | int
    high: float | int
    before: int = 0


def _whole(number: int, kind: str) -> Column:
    return F.lit(str(number)).cast(kind)  # any long


def _bin(value: Column, low, high, whole: bool) -> Column:
    """Which of ``BINS`` equal parts of [low, high] a value lies in; larger values never lie in an earlier one."""
    if whole:
        step = (high - low) // BINS + 1
        far = value.cast("decimal(20,0)") - _whole(low, "decimal(20,0)")
        return F.floor(far / _whole(step, "decimal(20,0)")).cast("int")
    if math.isinf(low) or math.isinf(high):
        return F.when(value == F.lit(-math.inf), 0).when(value == F.lit(math.inf), 2).otherwise(1)
    # Halved where the width would not be finite.
    half = 1.0 if math.isfinite(high - low) else 0.5
    place = (value * half - F.lit(low * half)) / F.lit(high * half - low * half) * F.lit(float(BINS))
    return F.least(F.floor(place), F.lit(BINS - 1)).cast("int")


def select_ranks(df: DataFrame, wanted: dict[str, Sequence[int]]) -> dict[str, list]:
    """For each column the values at the given ranks (from 0, ascending) among its values; nulls and NaN are none.
    A rank beyond the values gives None."""
    whole = {c: isinstance(df.schema[c].dataType, IntegralType) for c in wanted}
    value = {c: F.col(f"`{c}`") if whole[c] else F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in wanted}
    ends = df.agg(*(f(value[c]).alias(f"{n}_{k}") for k, c in enumerate(wanted) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max)))).first() if wanted else None
    found: dict[tuple[str, int], object] = {}
    open_: list[_Target] = []
    for k, c in enumerate(wanted):
        for rank in wanted[c]:
            if 0 <= rank < ends[f"n_{k}"]:
                open_.append(_Target(c, rank, ends[f"lo_{k}"], ends[f"hi_{k}"]))
            else:
                found[c, rank] = None
    while open_:
        narrow = []
        for t in open_:
            if t.low == t.high:
                found[t.column, t.rank] = t.low
            else:
                narrow.append(t)
        open_ = narrow
        if not open_:
            break
        ends_of = lambda t, end: _whole(end, "long") if whole[t.column] else F.lit(end)  # noqa: E731, B023
        inside = lambda t: value[t.column].between(ends_of(t, t.low), ends_of(t, t.high))  # noqa: E731, B023
        # All ranks in one pass: a value counts once for each interval that it lies in.
        places = [
            F.when(inside(t), F.struct(F.lit(k).alias("target"), _bin(value[t.column], t.low, t.high, whole[t.column]).alias("bin"), (value[t.column] if whole[t.column] else F.lit(None)).cast("long").alias("n"), value[t.column].cast("double").alias("x")))
            for k, t in enumerate(open_)
        ]
        rows = df.select(F.explode(F.array_compact(F.array(*places))).alias("p")).select("p.*")
        ends_found = [f(c).alias(f"{n}_{c}") for c in ("n", "x") for n, f in (("low", F.min), ("high", F.max))]
        counts = rows.groupBy("target", "bin").agg(F.count("*").alias("rows"), *ends_found).collect()
        for k, t in enumerate(open_):
            kind = "n" if whole[t.column] else "x"
            for r in sorted((r for r in counts if r.target == k), key=lambda r: r.bin):
                if t.before + r.rows > t.rank:
                    t.low, t.high = r[f"low_{kind}"], r[f"high_{kind}"]
                    break
                t.before += r.rows
    return {c: [found[c, rank] for rank in wanted[c]] for c in wanted}


def quantiles(df: DataFrame, columns: Sequence[str], share: float = 0.5) -> dict[str, float | None]:
    """The exact quantile of each column, interpolated between neighbours; None without values."""
    counts = df.agg(*(F.count(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))).alias(f"n_{k}") for k, c in enumerate(columns))).first()
    place = {c: (counts[f"n_{k}"] - 1) * share for k, c in enumerate(columns)}
    wanted = {c: sorted({int(p), min(int(p) + 1, counts[f"n_{k}"] - 1)}) for k, (c, p) in enumerate(place.items()) if counts[f"n_{k}"]}
    got = select_ranks(df, wanted) if wanted else {}
    out: dict[str, float | None] = {}
    for c in columns:
        if c not in got:
            out[c] = None
            continue
        low, high = float(got[c][0]), float(got[c][-1])
        part = place[c] - int(place[c])
        out[c] = low if part == 0 or low == high else low + (high - low) * part
    return out


def newest_from(df: DataFrame, id_col: str, newest: int) -> int | None:
    """The id from which on the ``newest`` rows by id lie; None if that is all rows."""
    n, known = df.agg(F.count(F.lit(1)), F.count(F.col(id_col))).first()
    if newest >= n:
        return None
    if not known or newest <= 0:
        raise ValueError("the newest rows need an id and a positive number")
    return select_ranks(df.select(id_col), {id_col: [max(0, known - newest)]})[id_col][0]

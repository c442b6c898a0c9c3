"""Keyword frequency and relevance score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablemill.functions import phrases, rx, vocab


def keyword_list(joined: Column) -> Column:
    """The non-empty items of a ', '-joined list."""
    return F.filter(F.transform(F.split(F.coalesce(joined, F.lit("")), ","), rx.strip), lambda x: x != "")


def keyword_frequency(tier1: Column, tier2: Column, title: Column, description: Column, fixed: list[str] | None = None, known: list[str] | None = None) -> Column:
    """Whole-word occurrences, in title and description, of the fixed keywords and the row's own.

    ``known`` lists the keywords that rows can carry beyond the fixed ones (default: both tiers);
    each is counted only in rows that carry it, and each keyword once.
    """
    fixed = [k.lower() for k in (vocab.FREQUENCY_KEYWORDS if fixed is None else fixed)]
    known = [k.lower() for k in (vocab.TITLE_KEYWORDS + vocab.STRONG_KEYWORDS if known is None else known)]
    text = F.concat(F.lower(F.coalesce(title, F.lit(""))), F.lit(" "), F.lower(F.coalesce(description, F.lit(""))))
    carried = F.transform(F.concat(keyword_list(tier1), keyword_list(tier2)), F.lower)
    return rx.let(F.struct(text.alias("text"), carried.alias("carried")), lambda row: phrases.count_phrases(row["text"], fixed, known, row["carried"]))


def relevance_score(tier1: Column, tier2: Column, frequency: Column) -> Column:
    """0 without keywords; else 1 to 10: a base from the tiers and a bonus from the frequency."""
    blank = lambda c: rx.strip(F.coalesce(c, F.lit(""))) == ""
    one, two = F.size(keyword_list(tier1)), F.size(keyword_list(tier2))
    premium = rx.contains_any(F.lower(tier1), vocab.PREMIUM_KEYWORDS)
    base = F.when((one > 0) & (two > 0), 4).when((one > 0) & (premium | (one > 1)), 3).when((one > 0) | (two > 1), 2).otherwise(1)
    bonus = rx.let(frequency, lambda n: F.when(n >= 21, 6).when(n >= 16, 5).when(n >= 11, 4).when(n >= 6, 3).when(n >= 3, 2).when(n >= 1, 1).otherwise(0))
    return F.when(blank(tier1) & blank(tier2), 0).otherwise(F.least(base + bonus, F.lit(10)))

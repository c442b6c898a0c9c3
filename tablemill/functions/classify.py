"""Cascades and scored categories for titles, types, levels, functions and industries.

Keyword tests are substring tests on purpose: "director" holds "cto", "coordinator" holds "coo".
The keyword lists of the cascades are fixed values: results depend on each of them and their order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablemill.functions import rx, vocab

_ANY = rx.contains_any


def _opening(title: Column, description: Column) -> Column:
    return F.lower(F.concat(title, F.lit(" "), F.substring(F.coalesce(description, F.lit("")), 1, 500)))


def extract_level(title: Column, description: Column) -> Column:
    """Seniority from title and the first 500 characters; '' without a title."""
    t, text = F.lower(title), _opening(title, description)
    return (
        F.when(rx.blank(title), "")
        .when(_ANY(text, ["intern", "internship", "co-op", "co op"]), "Internship")
        .when(_ANY(text, ["chief", "cto", "ceo", "cfo", "coo", "executive"]), "Executive")
        .when(_ANY(text, ["director", "vp", "vice president", "head of"]), "Director")
        .when(_ANY(t, ["senior", "sr.", "sr ", "lead", "principal", "staff engineer", "staff scientist"]), "Senior")
        .when(_ANY(text, ["entry level", "entry-level", "junior", "jr.", "jr ", "graduate", "new grad", "fresher"]), "Entry level")
        .when(t.contains("associate"), "Associate")
        .when(_ANY(t, ["manager", "management"]), "Senior")
        .otherwise("Mid-Level")
    )


#: Fixed values; the first match decides.
FUNCTION_RULES = [
    ("Operations Research", ["operations research", "optimization", "mathematical", "algorithm"]),
    ("Data Science", ["data scien", "machine learning", "ml engineer", "ai engineer"]),
    ("Engineering", ["software engineer", "developer", "programming", "backend", "frontend"]),
    ("Information Technology", ["data engineer", "data architect", "etl", "pipeline"]),
    ("Analytics", ["analyst", "analytics", "business intelligence", "bi "]),
    ("Supply Chain", ["supply chain", "logistics", "procurement", "inventory"]),
    ("Research", ["research", "scientist", "phd", "postdoc"]),
    ("Consulting", ["consulting", "consultant", "advisory"]),
    ("Product Management", ["product manager", "product owner", "pm "]),
]


def extract_function(title: Column, description: Column) -> Column:
    text = _opening(title, description)
    out = F.when(rx.blank(title), "")
    for name, keywords in FUNCTION_RULES:
        out = out.when(_ANY(text, keywords), name)
    return out.otherwise("Engineering")


def refine_level(current: Column, title: Column) -> Column:
    """A specific level stays; otherwise the title decides; without a title the level, or Mid-Level."""
    t = F.lower(rx.strip(title))
    have = F.lower(F.coalesce(current, F.lit("")))
    fallback = F.when(rx.blank(current), "Mid-Level").otherwise(current)
    senior = ["senior", "sr.", "sr ", "lead ", "lead,", "principal", "staff engineer", "staff scientist", "staff developer", "team lead", "tech lead", "technical lead", "head of", "chief", "vp ", "vice president"]
    roles = ["analyst", "specialist", "coordinator", "associate", "engineer", "scientist", "developer", "consultant", "researcher", "advisor", "planner"]
    return (
        F.when(rx.blank(title), fallback)
        .when(have.isin("internship", "entry level", "director", "executive"), current)
        .when(_ANY(t, ["intern", "internship", "co-op", "coop"]), "Internship")
        .when(_ANY(t, ["junior", "jr.", "jr ", "entry", "graduate", "trainee", "new grad", "fresher", "apprentice"]), "Entry Level")
        .when(_ANY(t, ["director", "vp ", "vice president"]), "Director")
        .when(_ANY(t, ["chief", "cto", "ceo", "cfo", "coo"]), "Executive")
        .when(_ANY(t, [*senior, "manager"]), "Senior")
        .when(t.contains("associate"), "Associate")
        .when(_ANY(t, roles) | have.isin("mid-senior level", "mid senior level"), "Mid-Level")
        .otherwise(fallback)
    )


def standard_job_type(value: Column, description: Column) -> Column:
    """The first type with a keyword in the value; full time for others; a blank value is inferred."""
    low = F.lower(value)
    known = F.when(rx.strip(F.coalesce(value, F.lit(""))) == "", F.lit(None).cast("string"))
    for name, keywords in vocab.JOB_TYPES.items():
        known = known.when(_ANY(low, keywords), name)
    known = known.otherwise("Full-time")
    inferred = F.when(rx.blank(description), "Full-time")
    for name, pattern in vocab.JOB_TYPE_PATTERNS.items():
        inferred = inferred.when(F.lower(description).rlike(rx.java(pattern)), name)
    return F.coalesce(known, inferred.otherwise("Full-time"))


def standard_level(value: Column) -> Column:
    """Exact values, then substrings in order, else Not Specified."""
    low = F.lower(rx.strip(F.coalesce(value, F.lit(""))))
    out = None
    for name in dict.fromkeys(vocab.LEVEL_VALUES.values()):
        exact = low.isin([v for v, n in vocab.LEVEL_VALUES.items() if n == name])
        out = F.when(exact, name) if out is None else out.when(exact, name)
    for name, keywords in vocab.LEVEL_KEYWORDS.items():
        out = out.when(_ANY(low, keywords), name)
    return out.otherwise("Not Specified")


def _best(table: dict[str, list[str]], weighted: list[tuple[Column, float]]) -> Column:
    """The category with the largest weighted number of keywords; of equal ones the first; none: Other."""

    def decide(row: Column) -> Column:
        options = []
        for k, (name, keywords) in enumerate(table.items()):
            score = sum((rx.count_contained(row[f"t{i}"], keywords) * F.lit(w) for i, (_, w) in enumerate(weighted)), F.lit(0.0))
            options.append(F.struct(score.alias("score"), F.lit(-k).alias("order"), F.lit(name).alias("name")))
        return rx.let(F.array_max(F.array(*options)), lambda top: F.when(top["score"] > 0, top["name"]).otherwise("Other"))

    return rx.let(F.struct(*(text.alias(f"t{i}") for i, (text, _) in enumerate(weighted))), decide)


def standard_function(value: Column, description: Column) -> Column:
    low = F.lower(rx.strip(F.coalesce(value, F.lit(""))))
    return _best(vocab.JOB_FUNCTIONS, [(low, 1.0), (F.substring(F.lower(F.coalesce(description, F.lit(""))), 1, 1000), 0.5)])


def standard_industry(value: Column, company: Column, description: Column) -> Column:
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return _best(vocab.INDUSTRIES, [(low(value), 3.0), (low(company), 2.0), (F.substring(low(description), 1, 500), 0.5)])

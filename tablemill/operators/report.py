"""Text reports over the profiling aggregates; what reaches the driver is one row for each column or listed value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.operators import profile


def table_text(df: DataFrame, limit: int = 50) -> str:
    """The first ``limit`` rows as aligned text."""
    rows = [df.columns, *([("" if v is None else f"{v:.2f}" if isinstance(v, float) else str(v)) for v in r] for r in df.limit(limit).collect())]
    width = [max(len(r[k]) for r in rows) for k in range(len(df.columns))]
    return "\n".join("  ".join(v.ljust(w) for v, w in zip(r, width)).rstrip() for r in rows)


def tag_summary(df: DataFrame, column: str) -> DataFrame:
    """n_distinct, n_total, mean_per_row (over rows with a tag; 2 places) of a ', '-joined list column."""
    tags = F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), ","), F.trim), lambda x: x != "")
    sizes = df.select(F.size(tags).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_total"), F.count_if(F.col("n") > 0).alias("rows"))
    sizes = sizes.withColumn("mean_per_row", F.round(F.try_divide("n_total", "rows"), 2))
    distinct = profile.tag_counts(df, column).agg(F.count("*").alias("n_distinct"))
    return distinct.crossJoin(sizes.drop("rows")).select("n_distinct", "n_total", "mean_per_row")


def completeness(df: DataFrame, columns: Sequence[str], missing: Sequence[str] = ("", "NA", "Not Specified")) -> DataFrame:
    """column, filled, rate, n_distinct: values that are there, in percent, and how many there are."""
    return profile.fill_rate(df, columns, missing).join(profile.distinct_counts(df, columns), "column")


def column_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """completeness of the columns that ``after`` has and ``before`` has not."""
    fresh = profile.new_columns(before, after)
    return completeness(after, fresh) if fresh else completeness(after, after.columns[:1]).limit(0)


def text_report(title: str, sections: dict[str, DataFrame | str], limit: int = 50) -> str:
    """A heading and one block for each section; frames give at most ``limit`` rows."""
    parts = [title, "=" * len(title)]
    for name, body in sections.items():
        parts += ["", name, "-" * len(name), body if isinstance(body, str) else table_text(body, limit)]
    return "\n".join(parts) + "\n"


def table_report(title: str, df: DataFrame, values: Sequence[str] = (), tags: Sequence[str] = ()) -> str:
    """Rows, completeness of all columns, distributions of ``values`` and tags of ``tags``."""
    sections: dict[str, DataFrame | str] = {"Rows": str(df.count()), "Columns": completeness(df, df.columns).orderBy(F.desc("rate"), "column")}
    sections |= {f"Values of {c}": profile.value_distribution(df, c, 20) for c in values}
    for c in tags:
        sections |= {f"Tags of {c}": tag_summary(df, c), f"Most frequent of {c}": profile.tag_counts(df, c).orderBy(F.desc("n"), "tag").limit(20)}
    return text_report(title, sections, 500)


#: Flags by what they say, for reports.
FLAGS = {"has_url_duplicate": {0: "Not Duplicate", 1: "Has Duplicate"}, "is_research": {0: "Industry/Corporate", 1: "Research/Academic"}}
#: What enrichment makes of which column.
STANDARD = [("job_type", "job_type_filled"), ("education_level", "edu_level_filled"), ("job_level", "job_level_std"), ("job_function", "job_function_std"), ("company_industry", "company_industry_std")]


def _named_values(df: DataFrame, column: str, names: dict, top: int) -> DataFrame:
    """value, name, n, percent of a column whose values have names."""
    table = F.create_map(*(F.lit(x) for k, v in names.items() for x in (str(k), v)))
    out = profile.value_distribution(df.withColumn(column, F.col(column).cast("string")), column, top)
    return out.select("value", F.coalesce(F.try_element_at(table, "value"), F.lit("Unknown")).alias("name"), "n", "percent")


def raw_sections(df: DataFrame, key: str = "job_id", top: int = 10, samples: int = 3) -> dict[str, DataFrame | str]:
    """What a raw table holds: schema, completeness, the values of categorical columns, and its first rows by ``key``."""
    spark = df.sparkSession
    fields = spark.createDataFrame([(f.name, f.dataType.simpleString(), not f.nullable, f.name == key) for f in df.schema], "field string, type string, not_null boolean, key boolean")
    distinct = profile.distinct_counts(df, df.columns)
    full = profile.fill_rate(df, df.columns, ("",)).join(distinct, "column").orderBy("column")
    sections: dict[str, DataFrame | str] = {"Rows": str(df.count()), "Schema": fields, "Completeness": full}
    few = [r["column"] for r in distinct.filter(profile.is_categorical(F.col("n_distinct"))).orderBy("column").collect()]
    sections |= {f"Values of {c}": profile.value_distribution(df.filter(F.col(f"`{c}`").cast("string") != ""), c, top) for c in few}
    return sections | {"First rows": df.orderBy(key).limit(samples).select(*(F.substring(F.col(f"`{c}`").cast("string"), 1, 80).alias(c) for c in df.columns))}


def processed_sections(before: DataFrame, after: DataFrame) -> dict[str, DataFrame | str]:
    """What preprocessing has added: rows on both sides, the new columns, and how their values are spread."""
    from tablemill.functions import vocab

    kinds = dict(after.dtypes)
    added = column_diff(before, after)
    fresh = profile.new_columns(before, after)
    type_of = F.create_map(*(F.lit(x) for c in after.columns for x in (c, kinds[c])))
    sections: dict[str, DataFrame | str] = {"Rows": f"{before.count()} before, {after.count()} after", "New columns": added.withColumn("type", F.element_at(type_of, F.col("column"))).orderBy("column")}
    for c in fresh:
        if c in FLAGS:
            sections[f"Values of {c}"] = _named_values(after, c, FLAGS[c], 2)
        elif c == "detected_language":
            sections[f"Values of {c}"] = _named_values(after, c, vocab.LANGUAGE_NAMES, 10)
        elif c in ("education_level", "education_field"):
            sections[f"Values of {c}"] = profile.value_distribution(after, c, 20)
    if {"job_description", "job_description_clean"} <= set(after.columns):
        sections["Text"] = after.agg(profile.reduction_percent(F.col("job_description"), F.col("job_description_clean")).cast("double").alias("mean_percent_removed"), F.avg(F.char_length("job_description_clean")).alias("mean_length"))
    return sections


def enriched_sections(df: DataFrame) -> dict[str, DataFrame | str]:
    """What enrichment has made: completeness, spread, skill categories, scores, and cardinality before and after."""
    made = [b for _, b in STANDARD if b in df.columns] + [c for c in ("skills", "tools", "job_relevance_score") if c in df.columns]
    full = profile.fill_rate(df, made, ("", "NA", "Other")).join(profile.distinct_counts(df, made), "column").orderBy("column")
    sections: dict[str, DataFrame | str] = {"Rows": str(df.count()), "New columns": full}
    sections |= {f"Values of {b}": profile.value_distribution(df, b, 50) for _, b in STANDARD if b in df.columns}
    total = df.agg(F.count("*").alias("_all"))
    for c in ("skills", "tools"):
        if c in df.columns:
            share = F.round(F.col("n") * 100.0 / F.col("_all"), 2).alias("percent")
            tags = profile.tag_counts(df, c).crossJoin(F.broadcast(total)).select("tag", "n", share)
            sections |= {f"Tags of {c}": tag_summary(df, c), f"Most frequent of {c}": tags.orderBy(F.desc("n"), "tag")}
    if "job_relevance_score" in df.columns:
        scores = profile.value_distribution(df, "job_relevance_score").orderBy(F.desc("value"))
        sections |= {"Scores": scores, "Score": profile.summary(df, ["job_relevance_score"])}
    pairs = [(a, b) for a, b in STANDARD if {a, b} <= set(df.columns)]
    if pairs:
        sections["Before and after"] = profile.cardinality_change(df, pairs)
    return sections


def run_reports(raw: DataFrame, processed: DataFrame, enriched: DataFrame) -> dict[str, str]:
    """The texts of a run's three reports."""
    return {
        "raw": text_report("Raw postings", raw_sections(raw), 200),
        "processed": text_report("Preprocessing", processed_sections(raw, processed), 200),
        "enriched": text_report("Enrichment", enriched_sections(enriched), 200),
    }

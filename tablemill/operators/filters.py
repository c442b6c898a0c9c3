"""Row filters of the first stage and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.functions import rx, vocab


def two_tier(title: Column, description: Column) -> Column:
    """Accept: a title keyword or a strong keyword in the description, and no negative in the title."""
    t, d = F.lower(title), F.lower(F.coalesce(description, F.lit("")))
    low = lambda words: [w.lower() for w in words]
    good = rx.contains_any(t, low(vocab.TITLE_KEYWORDS)) | rx.contains_any(d, low(vocab.STRONG_KEYWORDS))
    return ~rx.blank(title) & ~rx.contains_any(t, low(vocab.NEGATIVE_KEYWORDS)) & good


def two_tier_detail(title: Column, description: Column) -> Column:
    """Struct of accepted, rejected_negative, tier1_match, tier2_match and the keywords of both tiers;
    all empty without a title or with a negative keyword in it."""
    negative = ~rx.blank(title) & rx.contains_any(F.lower(title), [w.lower() for w in vocab.NEGATIVE_KEYWORDS])
    none = F.array().cast("array<string>")
    tiers = F.struct(rx.found_keywords(title, vocab.TITLE_KEYWORDS).alias("one"), rx.found_keywords(description, vocab.STRONG_KEYWORDS).alias("two"), negative.alias("no"))
    nothing = F.struct(none.alias("one"), none.alias("two"), negative.alias("no"))
    return rx.let(
        F.when(rx.blank(title) | negative, nothing).otherwise(tiers),
        lambda t: F.struct(
            ((F.size(t["one"]) > 0) | (F.size(t["two"]) > 0)).alias("accepted"), t["no"].alias("rejected_negative"), (F.size(t["one"]) > 0).alias("tier1_match"),
            (F.size(t["two"]) > 0).alias("tier2_match"), t["one"].alias("tier1_keywords"), t["two"].alias("tier2_keywords"),
        ),
    )


def filter_statistics(df: DataFrame, term_col: str, title_col: str, description_col: str, final_col: str | None = None) -> DataFrame:
    """Per search term, and for all under TOTAL: found, rejected and accepted rows by reason, rate in %."""
    detail = two_tier_detail(F.col(title_col), F.col(description_col))
    rows = df.select(F.col(term_col).alias("search_term"), detail.alias("d"), (F.col(final_col) if final_col else F.lit(True)).alias("stored"))
    count = lambda c: F.count_if(c)
    one, two, ok = F.col("d.tier1_match"), F.col("d.tier2_match"), F.col("d.accepted")
    stats = rows.rollup("search_term").agg(
        F.count("*").alias("found"), count(F.col("d.rejected_negative")).alias("rejected_negative"), count(one & ~two).alias("accepted_tier1_only"),
        count(two & ~one).alias("accepted_tier2_only"), count(one & two).alias("accepted_both"), count(~ok & ~F.col("d.rejected_negative")).alias("rejected_no_match"),
        count(ok & F.col("stored")).alias("final"), F.grouping("search_term").alias("total"),
    )
    accepted = F.col("accepted_tier1_only") + F.col("accepted_tier2_only") + F.col("accepted_both")
    name = F.when(F.col("total") == 1, "TOTAL").otherwise(F.col("search_term"))
    return stats.withColumn("search_term", name).withColumn("rate", F.round(F.try_divide(accepted * F.lit(100.0), F.col("found")), 2)).drop("total")


def recommendations(stats: DataFrame) -> DataFrame:
    """search_term, low_rate (under half accepted), title_only (more by title alone than otherwise)."""
    accepted = F.col("accepted_tier1_only") + F.col("accepted_tier2_only") + F.col("accepted_both")
    low = (F.col("found") > 0) & (accepted * 2 < F.col("found"))
    title = F.col("accepted_tier1_only") > F.col("accepted_tier2_only") + F.col("accepted_both")
    return stats.filter(F.col("search_term") != "TOTAL").select("search_term", low.alias("low_rate"), title.alias("title_only")).filter("low_rate or title_only")


def recent(posted: Column, now: Column, hours: int, assigned: Column | None = None) -> Column:
    """Not older than ``hours``; rows whose date was assigned pass."""
    fresh = posted >= now - F.make_dt_interval(F.lit(0), F.lit(hours))
    return F.coalesce(fresh, F.lit(True)) if assigned is None else F.coalesce(fresh, F.lit(True)) | (assigned == 1)


def parse_posted(text: Column) -> Column:
    """A date, or an ISO time with or without zone; null if neither."""
    iso = F.regexp_replace(text, r"Z$", "+00:00")
    return F.coalesce(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))), F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), F.try_to_timestamp(iso)))


def assign_dates(df: DataFrame, posted_col: str, fallback: Column, flag_col: str = "is_posted_date_assigned") -> DataFrame:
    """A missing date becomes ``fallback`` and is flagged."""
    missing = F.col(posted_col).isNull()
    return df.withColumn(flag_col, missing.cast("int")).withColumn(posted_col, F.coalesce(posted_col, fallback))


def standard_na(df: DataFrame, columns: list[str]) -> DataFrame:
    """null, '', unknown and Unknown become NA."""
    value = lambda c: F.when(F.col(c).isNull() | F.col(c).isin("", "unknown", "Unknown"), vocab.NA).otherwise(F.col(c))
    return df.withColumns({c: value(c) for c in columns})


def flat_location(city: Column, state: Column, country: Column) -> Column:
    return F.concat_ws(", ", *(F.nullif(c, F.lit("")) for c in (city, state, country)))


def surrogate_id(platform: Column, country: Column, source_id: Column, url: Column) -> Column:
    """platform_country_id_hash, the hash being the first 32 bits of the URL's MD5 modulo 100000."""
    number = F.conv(F.substring(F.md5(F.coalesce(url, F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long") % 100000
    return F.concat_ws("_", platform, country, F.coalesce(source_id, F.lit("")), number.cast("string"))


def flag(value: Column) -> Column:
    """1, 0 or null."""
    return value.cast("boolean").cast("int")


#: What a required column holds when it is blank.
EXPORT_DEFAULTS = {
    "platform": "unknown", "url": "", "actual_role": "Unknown", "job_type_filled": "Not Specified", "job_level_std": "Not Specified",
    "job_function_std": "Other", "company_industry_std": "Other", "company_name": "Unknown", "country": "Unknown",
}
EXPORT_OPTIONAL = ["skills", "tools", "search_term", "education_level", "location", "posted_date"]


def export_projection(df: DataFrame) -> DataFrame:
    """The exported columns: defaults where a value is required, null for optional blanks; columns
    that the input lacks are left out."""
    have = set(df.columns)
    out = [F.col("job_id")]
    out += [F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(d)).alias(c) for c, d in EXPORT_DEFAULTS.items() if c in have]
    out += [F.nullif(F.col(c), F.lit("")).alias(c) for c in EXPORT_OPTIONAL if c in have]
    out += [F.coalesce(F.col(c).cast("boolean"), F.lit(False)).alias(c) for c in ("is_remote", "is_research") if c in have]
    out += [F.coalesce(F.col("has_url_duplicate"), F.lit(0)).alias("has_url_duplicate")] if "has_url_duplicate" in have else []
    out += [F.col("job_relevance_score").cast("double").alias("job_relevance_score")] if "job_relevance_score" in have else []
    return df.select(out)

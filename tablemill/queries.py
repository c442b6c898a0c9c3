"""The queries over the driver's tables: one for each operator, with DuckDB SQL where it can say the same."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.functions import chunk, classify, features, languages, normalize, rx, score, vocab
from tablemill.operators import dedup, filters, profile, retention
from tablemill.plans import jobs as plan
from tablemill.sources import store
from tablemill.standin import JOBS, quote
from tablemill.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows need much work each: dealt to all cores if it comes in fewer splits."""
    return store.spread(table(spark, sf_dir, name))


def jobs(spark: SparkSession, sf_dir: str, documents: DataFrame | None = None) -> DataFrame:
    return spark.sql(JOBS.replace("FROM documents", "FROM {documents}"), documents=documents if documents is not None else table(spark, sf_dir, "documents"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows for queries that work on the descriptions."""
    return jobs(spark, sf_dir, spread(spark, sf_dir, "documents"))


def over(select: str, extra: str = "") -> str:
    return f"WITH jobs AS ({JOBS}){extra} {select}"


# DuckDB forms of the column helpers. Its patterns know no look-around and an ASCII \b only.
_IN, _OUT = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


def s_any(text: str, keywords: list[str]) -> str:
    return "coalesce(" + " OR ".join(f"contains({text}, {quote(k)})" for k in keywords) + ", false)"


def s_pattern(p: str) -> str:
    p = p.replace(r".*\b", ".*" + _IN)
    return (_IN + p[2:] if p.startswith(r"\b") else p).replace(r"\b", _OUT)


def s_unless(words: str) -> str:
    """What may follow a word that ``words`` must not follow: an end, another mark, or blanks and any other text."""
    tokens = re.findall(r"\\s\+|.", words)
    out = ""
    for k in reversed(tokens):
        later = f"|{k}(?:{out})" if out else ""
        out = (r"$|\S" if k == r"\s+" else rf"$|[^\s{k}]") + later
    return rf"(?:$|[^\p{{L}}\p{{N}}_\s]|\s+(?:{out}))"


def s_ahead(p: str) -> str:
    r"""``p`` without its look-ahead, if it ends in one behind ``\.?\b``: where the point would be taken, the border is there without it."""
    found = re.fullmatch(r"(.*)\\\.\?\\b\(\?!\\s[*+](.+)\)", p)
    return _IN + found[1][2:] + s_unless(found[2]) if found else s_pattern(p)


def s_match(text: str, patterns: list[str]) -> str:
    return "coalesce(" + " OR ".join(f"regexp_matches({text}, {quote('(?i)' + s_ahead(p))})" for p in patterns) + ", false)"


def s_list(items: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {test} THEN {quote(name)} END" for name, test in items) + "], lambda x: x IS NOT NULL)"


def s_cascade(rules: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in rules) + f" ELSE {default} END"


#: Word borders marked, so that whole words can be counted by replacing.
_MARKED = r"regexp_replace({}, '([\p{{L}}\p{{N}}_]+)', '¦\1¦', 'g')"


def s_count(marked: str, keyword: str) -> str:
    k = re.sub(r"([^\W]+)", r"¦\1¦", keyword)
    return f"((length({marked}) - length(replace({marked}, {quote(k)}, ''))) // {len(k)})"


def s_low(c: str) -> str:
    return f"lower(coalesce({c}, ''))"


def s_blank(c: str) -> str:
    return f"({c} IS NULL OR {c} = '')"


_NEG, _T1, _T2 = (s_any(s_low(c), [w.lower() for w in words]) for c, words in (("actual_role", vocab.NEGATIVE_KEYWORDS), ("actual_role", vocab.TITLE_KEYWORDS), ("job_description", vocab.STRONG_KEYWORDS)))
_TITLED = "coalesce(actual_role <> '', false)"
_ONE = s_list([(k, f"{_TITLED} AND NOT {_NEG} AND contains({s_low('actual_role')}, {quote(k.lower())})") for k in vocab.TITLE_KEYWORDS])
_TWO = s_list([(k, f"{_TITLED} AND NOT {_NEG} AND contains({s_low('job_description')}, {quote(k.lower())})") for k in vocab.STRONG_KEYWORDS])
_DETAIL = f", detail AS (SELECT *, {_TITLED} AND {_NEG} AS rejected_negative, {_ONE} AS t1, {_TWO} AS t2 FROM jobs)"
_TIERS = _DETAIL + ", tiers AS (SELECT *, array_to_string(t1, ', ') AS tier1, array_to_string(t2, ', ') AS tier2 FROM detail)"


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = texts(spark, sf_dir).withColumn("d", filters.two_tier_detail(F.col("actual_role"), F.col("job_description")))
    return rows.withColumn("tier1", F.array_join("d.tier1_keywords", ", ")).withColumn("tier2", F.array_join("d.tier2_keywords", ", "))


# --- filters -----------------------------------------------------------------------------------


@query(over(f"SELECT job_id FROM jobs WHERE {_TITLED} AND NOT {_NEG} AND ({_T1} OR {_T2})"))
def filter_two_tier(spark, sf_dir):
    return texts(spark, sf_dir).filter(filters.two_tier(F.col("actual_role"), F.col("job_description"))).select("job_id")


@query(over("SELECT job_id, len(t1) + len(t2) > 0 AS accepted, rejected_negative, tier1, tier2 FROM tiers", _TIERS))
def filter_detailed(spark, sf_dir):
    return tiered(spark, sf_dir).select("job_id", "d.accepted", "d.rejected_negative", "tier1", "tier2")


_STATS = """, s AS (SELECT CASE WHEN grouping(search_term) = 1 THEN 'TOTAL' ELSE search_term END AS search_term, count(*) AS found,
  count(*) FILTER (WHERE rejected_negative) AS rejected_negative, count(*) FILTER (WHERE len(t1) > 0 AND len(t2) = 0) AS accepted_tier1_only,
  count(*) FILTER (WHERE len(t1) = 0 AND len(t2) > 0) AS accepted_tier2_only, count(*) FILTER (WHERE len(t1) > 0 AND len(t2) > 0) AS accepted_both,
  count(*) FILTER (WHERE len(t1) + len(t2) = 0 AND NOT rejected_negative) AS rejected_no_match, count(*) FILTER (WHERE len(t1) + len(t2) > 0) AS final
  FROM detail GROUP BY ROLLUP (search_term))"""


@query(over("SELECT *, round((accepted_tier1_only + accepted_tier2_only + accepted_both) * 100.0::DOUBLE / found, 2) AS rate FROM s", _DETAIL + _STATS))
def filter_effectiveness(spark, sf_dir):
    return filters.filter_statistics(texts(spark, sf_dir), "search_term", "actual_role", "job_description").withColumn("rate", F.col("rate").cast("double"))


@query(
    over(
        "SELECT search_term, (accepted_tier1_only + accepted_tier2_only + accepted_both) * 2 < found AS low_rate, accepted_tier1_only > accepted_tier2_only + accepted_both AS title_only FROM s WHERE search_term <> 'TOTAL' AND ((accepted_tier1_only + accepted_tier2_only + accepted_both) * 2 < found OR accepted_tier1_only > accepted_tier2_only + accepted_both)",
        _DETAIL + _STATS,
    )
)
def filter_recommendations(spark, sf_dir):
    return filters.recommendations(filters.filter_statistics(texts(spark, sf_dir), "search_term", "actual_role", "job_description"))


_DAY = "CASE WHEN regexp_matches(posted_text, '^\\d{4}-\\d{2}-\\d{2}$') THEN CAST(posted_text AS TIMESTAMP) WHEN regexp_matches(posted_text, '^\\d{4}-\\d{2}-\\d{2}[T ]') THEN CAST(replace(replace(posted_text, 'T', ' '), 'Z', '') AS TIMESTAMP) END"


@query(over(f"SELECT job_id, CAST({_DAY} AS VARCHAR) AS posted FROM jobs"))
def posted_date_parse(spark, sf_dir):
    return jobs(spark, sf_dir).select("job_id", filters.parse_posted(F.col("posted_text")).cast("string").alias("posted"))


@query(over(f"SELECT job_id FROM (SELECT job_id, {_DAY} AS p FROM jobs) WHERE p IS NULL OR p >= TIMESTAMP '2024-02-01 12:00:00' - INTERVAL 50 HOUR"))
def recency_filter(spark, sf_dir):
    rows = jobs(spark, sf_dir).withColumn("p", filters.parse_posted(F.col("posted_text")))
    return rows.filter(filters.recent(F.col("p"), F.lit("2024-02-01 12:00:00").cast("timestamp"), 50)).select("job_id")


@query(over("SELECT job_id, coalesce(posted_text, scraped_at) AS posted_text, CASE WHEN posted_text IS NULL THEN 1 ELSE 0 END AS is_posted_date_assigned FROM jobs"))
def posted_date_impute(spark, sf_dir):
    return filters.assign_dates(jobs(spark, sf_dir), "posted_text", F.col("scraped_at")).select("job_id", "posted_text", "is_posted_date_assigned")


@query(over("SELECT job_id, " + ", ".join(f"CASE WHEN {c} IS NULL OR {c} IN ('', 'unknown', 'Unknown') THEN 'NA' ELSE {c} END AS {c}" for c in ("country", "job_level", "company_name")) + " FROM jobs"))
def na_standardize(spark, sf_dir):
    cols = ["country", "job_level", "company_name"]
    return filters.standard_na(jobs(spark, sf_dir), cols).select("job_id", *cols)


@query(over("SELECT job_id, concat_ws(', ', nullif(search_term, ''), nullif(company_url, ''), nullif(country, '')) AS location FROM jobs"))
def location_flatten(spark, sf_dir):
    return jobs(spark, sf_dir).select("job_id", filters.flat_location(F.col("search_term"), F.col("company_url"), F.col("country")).alias("location"))


@query(over("SELECT id, concat_ws('_', platform, country, CAST(id AS VARCHAR), CAST(CAST('0x' || substr(md5(url), 1, 8) AS BIGINT) % 100000 AS VARCHAR)) AS job_key FROM jobs"))
def surrogate_key(spark, sf_dir):
    return jobs(spark, sf_dir).select("id", filters.surrogate_id(F.col("platform"), F.col("country"), F.col("id").cast("string"), F.col("url")).alias("job_key"))


@query(over("SELECT job_id, CAST(CAST(is_remote AS BOOLEAN) AS INTEGER) AS is_remote FROM jobs"))
def boolean_flags(spark, sf_dir):
    return jobs(spark, sf_dir).select("job_id", filters.flag(F.col("is_remote")).alias("is_remote"))


@query(
    over(
        "SELECT job_id, coalesce(nullif(platform, ''), 'unknown') AS platform, coalesce(nullif(url, ''), '') AS url, coalesce(nullif(actual_role, ''), 'Unknown') AS actual_role, coalesce(nullif(company_name, ''), 'Unknown') AS company_name, coalesce(nullif(country, ''), 'Unknown') AS country, nullif(skills, '') AS skills, nullif(tools, '') AS tools, nullif(search_term, '') AS search_term, coalesce(CAST(is_remote AS BOOLEAN), false) AS is_remote FROM jobs"
    )
)
def export_projection(spark, sf_dir):
    return filters.export_projection(jobs(spark, sf_dir))


# --- classification and scoring ----------------------------------------------------------------

_OPEN = "lower(concat(actual_role, ' ', substr(coalesce(job_description, ''), 1, 500)))"
_ROLE = s_low("actual_role")


@query(
    over(
        "SELECT job_id, "
        + s_cascade(
            [
                (s_blank("actual_role"), "''"), (s_any(_OPEN, ["intern", "internship", "co-op", "co op"]), "'Internship'"), (s_any(_OPEN, ["chief", "cto", "ceo", "cfo", "coo", "executive"]), "'Executive'"),
                (s_any(_OPEN, ["director", "vp", "vice president", "head of"]), "'Director'"), (s_any(_ROLE, ["senior", "sr.", "sr ", "lead", "principal", "staff engineer", "staff scientist"]), "'Senior'"),
                (s_any(_OPEN, ["entry level", "entry-level", "junior", "jr.", "jr ", "graduate", "new grad", "fresher"]), "'Entry level'"), (s_any(_ROLE, ["associate"]), "'Associate'"), (s_any(_ROLE, ["manager", "management"]), "'Senior'"),
            ],
            "'Mid-Level'",
        )
        + " AS level, "
        + s_cascade([(s_blank("actual_role"), "''")] + [(s_any(_OPEN, k), quote(n)) for n, k in classify.FUNCTION_RULES], "'Engineering'")
        + " AS job_function FROM jobs"
    )
)
def title_extraction(spark, sf_dir):
    t, d = F.col("actual_role"), F.col("job_description")
    return texts(spark, sf_dir).select("job_id", classify.extract_level(t, d).alias("level"), classify.extract_function(t, d).alias("job_function"))


_FALL = "CASE WHEN job_level IS NULL OR job_level = '' THEN 'Mid-Level' ELSE job_level END"


@query(
    over(
        "SELECT job_id, "
        + s_cascade(
            [
                (s_blank("actual_role"), _FALL), (f"{s_low('job_level')} IN ('internship', 'entry level', 'director', 'executive')", "job_level"), (s_any(_ROLE, ["intern", "internship", "co-op", "coop"]), "'Internship'"),
                (s_any(_ROLE, ["junior", "jr.", "jr ", "entry", "graduate", "trainee", "new grad", "fresher", "apprentice"]), "'Entry Level'"), (s_any(_ROLE, ["director", "vp ", "vice president"]), "'Director'"), (s_any(_ROLE, ["chief", "cto", "ceo", "cfo", "coo"]), "'Executive'"),
                (s_any(_ROLE, ["senior", "sr.", "sr ", "lead ", "lead,", "principal", "staff engineer", "staff scientist", "staff developer", "team lead", "tech lead", "technical lead", "head of", "vp ", "vice president", "manager"]), "'Senior'"), (s_any(_ROLE, ["associate"]), "'Associate'"),
                (s_any(_ROLE, ["analyst", "specialist", "coordinator", "engineer", "scientist", "developer", "consultant", "researcher", "advisor", "planner"]) + f" OR {s_low('job_level')} IN ('mid-senior level', 'mid senior level')", "'Mid-Level'"),
            ],
            _FALL,
        )
        + " AS level FROM jobs"
    )
)
def level_refine(spark, sf_dir):
    return jobs(spark, sf_dir).select("job_id", classify.refine_level(F.col("job_level"), F.col("actual_role")).alias("level"))


_LEVEL_SQL = s_cascade([(f"{s_low('job_level')} = {quote(v)}", quote(n)) for v, n in vocab.LEVEL_VALUES.items()] + [(s_any(s_low("job_level"), k), quote(n)) for n, k in vocab.LEVEL_KEYWORDS.items()], "'Not Specified'")


@query(over(f"SELECT job_id, {_LEVEL_SQL} AS job_level_std FROM jobs"))
def level_standardize(spark, sf_dir):
    return jobs(spark, sf_dir).select("job_id", classify.standard_level(F.col("job_level")).alias("job_level_std"))


_TYPE_SQL = "CASE WHEN trim(coalesce(job_type, '')) = '' THEN " + s_cascade([(s_blank("job_description"), "'Full-time'")] + [(s_match("lower(job_description)", [p]), quote(n)) for n, p in vocab.JOB_TYPE_PATTERNS.items()], "'Full-time'") + " ELSE " + s_cascade([(s_any(s_low("job_type"), k), quote(n)) for n, k in vocab.JOB_TYPES.items()], "'Full-time'") + " END"


@query(over(f"SELECT job_id, {_TYPE_SQL} AS job_type_filled FROM jobs"))
def job_type_fill(spark, sf_dir):
    return texts(spark, sf_dir).select("job_id", classify.standard_job_type(F.col("job_type"), F.col("job_description")).alias("job_type_filled"))


def s_best(categories: dict[str, list[str]], weighted: list[tuple[str, float]]) -> str:
    scores = [" + ".join(f"{w} * CAST(contains({text}, {quote(k)}) AS INTEGER)" for text, w in weighted for k in keywords) for keywords in categories.values()]
    items = ", ".join(f"{{'s': CAST({s} AS DOUBLE), 'o': {-k}, 'n': {quote(name)}}}" for k, (name, s) in enumerate(zip(categories, scores)))
    best = f"list_max([{items}])"
    return f"CASE WHEN ({best}).s > 0 THEN ({best}).n ELSE 'Other' END"


_FN_SQL = s_best(vocab.JOB_FUNCTIONS, [("f", 1.0), ("d", 0.5)])


@query(over(f"SELECT job_id, {_FN_SQL} AS job_function_std FROM (SELECT job_id, trim({s_low('job_function')}) AS f, substr({s_low('job_description')}, 1, 1000) AS d FROM jobs)"))
def job_function_standardize(spark, sf_dir):
    return texts(spark, sf_dir).select("job_id", classify.standard_function(F.col("job_function"), F.col("job_description")).alias("job_function_std"))


_IND_SQL = s_best(vocab.INDUSTRIES, [("i", 3.0), ("c", 2.0), ("d", 0.5)])


@query(over(f"SELECT job_id, {_IND_SQL} AS company_industry_std FROM (SELECT job_id, {s_low('company_industry')} AS i, {s_low('company_name')} AS c, substr({s_low('job_description')}, 1, 500) AS d FROM jobs)"))
def company_industry_standardize(spark, sf_dir):
    return texts(spark, sf_dir).select("job_id", classify.standard_industry(F.col("company_industry"), F.col("company_name"), F.col("job_description")).alias("company_industry_std"))


_FIXED = [k.lower() for k in vocab.FREQUENCY_KEYWORDS]
_OWN = [k for k in dict.fromkeys(k.lower() for k in vocab.TITLE_KEYWORDS + vocab.STRONG_KEYWORDS) if k not in _FIXED]
_FREQ = " + ".join([s_count("m", k) for k in _FIXED] + [f"CASE WHEN list_contains(own, {quote(k)}) THEN {s_count('m', k)} ELSE 0 END" for k in _OWN])
_SCORED = (
    _TIERS
    + f", marked AS (SELECT *, {_MARKED.format('lower(concat(coalesce(actual_role, ' + chr(39) * 2 + '), ' + chr(39) + ' ' + chr(39) + ', coalesce(job_description, ' + chr(39) * 2 + ')))')} AS m, list_transform(list_concat(t1, t2), lambda x: lower(x)) AS own FROM tiers), freq AS (SELECT *, CAST({_FREQ} AS INTEGER) AS keyword_frequency FROM marked)"
    + """, scored AS (SELECT *, CASE WHEN len(t1) + len(t2) = 0 THEN 0 ELSE least(10, CASE WHEN len(t1) > 0 AND len(t2) > 0 THEN 4 WHEN len(t1) > 0 AND (contains(tier1, 'optim') OR len(t1) > 1) THEN 3 WHEN len(t1) > 0 OR len(t2) > 1 THEN 2 ELSE 1 END
  + CASE WHEN keyword_frequency >= 21 THEN 6 WHEN keyword_frequency >= 16 THEN 5 WHEN keyword_frequency >= 11 THEN 4 WHEN keyword_frequency >= 6 THEN 3 WHEN keyword_frequency >= 3 THEN 2 WHEN keyword_frequency >= 1 THEN 1 ELSE 0 END) END AS score FROM freq)"""
)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tiered(spark, sf_dir).withColumn("keyword_frequency", score.keyword_frequency(F.col("tier1"), F.col("tier2"), F.col("actual_role"), F.col("job_description")))
    return rows.withColumn("score", score.relevance_score(F.col("tier1"), F.col("tier2"), F.col("keyword_frequency")))


@query(over("SELECT job_id, keyword_frequency, score FROM scored", _SCORED))
def relevance_score(spark, sf_dir):
    return scored(spark, sf_dir).select("job_id", "keyword_frequency", "score")


@query(over("SELECT score, count(*) AS n, round(avg(keyword_frequency), 2) AS mean_frequency FROM scored GROUP BY score", _SCORED))
def score_distribution(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("score").agg(F.count("*").alias("n"), F.round(F.avg("keyword_frequency"), 2).alias("mean_frequency"))


@query(over("SELECT job_id, score, keyword_frequency FROM scored WHERE score >= 6 AND keyword_frequency >= 5 ORDER BY score DESC, keyword_frequency DESC, job_id LIMIT 20", _SCORED))
def top_relevant(spark, sf_dir):
    rows = scored(spark, sf_dir).filter("score >= 6 and keyword_frequency >= 5")
    return rows.orderBy(F.desc("score"), F.desc("keyword_frequency"), "job_id").limit(20).select("job_id", "score", "keyword_frequency")


_BUCKETS = [("0", "= 0"), ("1-2", "BETWEEN 1 AND 2"), ("3-5", "BETWEEN 3 AND 5"), ("6-10", "BETWEEN 6 AND 10"), ("11-15", "BETWEEN 11 AND 15"), ("16-20", "BETWEEN 16 AND 20"), ("21+", ">= 21")]


@query(over(" UNION ALL ".join(f"SELECT '{n}' AS bucket, count(*) FILTER (WHERE keyword_frequency {c}) AS n FROM freq" for n, c in _BUCKETS), _SCORED))
def frequency_histogram(spark, sf_dir):
    return profile.bucket_histogram(scored(spark, sf_dir), F.col("keyword_frequency"), profile.FREQUENCY_BUCKETS)


@query(over("SELECT company_industry AS industry, round(sum(score * keyword_frequency) * 1.0::DOUBLE / sum(score), 4) AS weighted_frequency, round(avg(keyword_frequency), 4) AS mean_frequency FROM scored WHERE company_industry IS NOT NULL GROUP BY company_industry HAVING sum(score) > 0", _SCORED))
def weighted_mean_by_industry(spark, sf_dir):
    rows = scored(spark, sf_dir).filter("company_industry is not null").groupBy(F.col("company_industry").alias("industry"))
    out = rows.agg(F.sum("score").alias("s"), F.sum(F.col("score") * F.col("keyword_frequency")).alias("w"), F.round(F.avg("keyword_frequency"), 4).alias("mean_frequency")).filter("s > 0")
    return out.select("industry", F.round(F.col("w") / F.col("s"), 4).alias("weighted_frequency"), "mean_frequency")


# --- features ----------------------------------------------------------------------------------

_DESC = "coalesce(job_description, '')"


def s_levels(table: dict[str, list[str]]) -> str:
    found = "array_to_string(" + s_list([(n, s_match(_DESC, p)) for n, p in table.items()]) + ", ', ')"
    return f"CASE WHEN {s_blank('job_description')} OR {found} = '' THEN 'NA' ELSE {found} END"


@query(over(f"SELECT job_id, {s_levels(vocab.EDUCATION_LEVELS)} AS education_level FROM jobs"))
def education_levels(spark, sf_dir):
    return texts(spark, sf_dir).select("job_id", features.education_levels(F.col("job_description")).alias("education_level"))


@query(over("SELECT job_id, " + f"CASE WHEN {s_blank('job_description')} THEN 'NA' WHEN len(f) = 0 THEN 'Other Fields' ELSE array_to_string(f, ', ') END AS education_field FROM (SELECT *, {s_list([(n, s_match(_DESC, p)) for n, p in vocab.EDUCATION_FIELDS.items()])} AS f FROM jobs)"))
def education_field(spark, sf_dir):
    return texts(spark, sf_dir).select("job_id", features.education_field(F.col("job_description")).alias("education_field"))


@query(over(f"SELECT job_id, CASE WHEN {s_blank('level')} OR level = 'NA' THEN {s_levels(vocab.EDUCATION_FILL)} ELSE level END AS edu_level_filled FROM (SELECT *, CASE WHEN id % 2 = 0 THEN {s_levels(vocab.EDUCATION_LEVELS)} END AS level FROM jobs)"))
def education_fill(spark, sf_dir):
    rows = texts(spark, sf_dir).withColumn("level", F.when(F.col("id") % 2 == 0, features.education_levels(F.col("job_description"))))
    return rows.select("job_id", features.fill_education(F.col("level"), F.col("job_description")).alias("edu_level_filled"))


@query(over(f"SELECT job_id, CASE WHEN {s_blank('job_description')} THEN 0 WHEN {s_match(_DESC, vocab.RESEARCH_PATTERNS)} OR {s_any(s_low('company_name'), vocab.ACADEMIC_NAMES)} THEN 1 ELSE 0 END AS is_research FROM jobs"))
def research_flag(spark, sf_dir):
    return texts(spark, sf_dir).select("job_id", features.is_research(F.col("job_description"), F.col("company_name")).alias("is_research"))


_TOOL_NAMES = sorted((n, p) for t in vocab.TOOLS.values() for n, p in t.items())
_TOOL_SQL = s_list([(n, s_match(_DESC, p)) for n, p in _TOOL_NAMES])


@query(over(f"SELECT job_id, array_to_string({_TOOL_SQL}, ', ') AS tools FROM jobs"))
def tools_extract(spark, sf_dir):
    return texts(spark, sf_dir).select("job_id", features.tools().found_string(F.col("job_description")).alias("tools"))


@query(over(f"SELECT job_id, array_to_string({s_list([(c, s_match(_DESC, [p for ps in t.values() for p in ps])) for c, t in sorted(vocab.TOOLS.items())])}, ', ') AS categories FROM jobs"))
def tool_categories(spark, sf_dir):
    return texts(spark, sf_dir).select("job_id", F.array_join(features.tools().found_categories(F.col("job_description")), ", ").alias("categories"))


@query(over(f"SELECT tool, count(*) AS n FROM (SELECT unnest({_TOOL_SQL}) AS tool FROM jobs) GROUP BY tool"))
def tool_counts(spark, sf_dir):
    return profile.tag_counts(texts(spark, sf_dir).select(features.tools().found_string(F.col("job_description")).alias("t")), "t").withColumnRenamed("tag", "tool")


def s_phrases(text: str, phrases: list[str]) -> str:
    """Any phrase between word borders; beside a sign a border needs a letter or digit on the other side."""
    import re

    edge = lambda c, plain: plain if c.isalnum() else r"[\p{L}\p{N}_]"
    parts = [edge(p[0], _IN) + r"\s+".join(re.escape(w).replace(r"\-", "-").replace(r"\#", "#").replace(r"\/", "/") for w in p.split()) + edge(p[-1], _OUT) for p in phrases]
    return f"coalesce(regexp_matches({text}, {quote('(?i)' + '|'.join(parts))}), false)"


_SKILLS = sorted((n, c, p) for c, names in vocab.SKILLS.items() for n, p in names.items())
_SKILL_SQL = s_list([(n, s_phrases(_DESC, p)) for n, _, p in _SKILLS])


@query(over(f"SELECT job_id, array_to_string({_SKILL_SQL}, ', ') AS skills FROM jobs"))
def skills_extract(spark, sf_dir):
    return texts(spark, sf_dir).select("job_id", features.skills().found_string(F.col("job_description")).alias("skills"))


@query(over(f"SELECT job_id, array_to_string({s_list([(c, '(' + ' OR '.join(s_phrases(_DESC, p) for p in names.values()) + ')') for c, names in sorted(vocab.SKILLS.items())])}, ', ') AS categories FROM jobs"))
def skill_categories(spark, sf_dir):
    return texts(spark, sf_dir).select("job_id", F.array_join(features.skills().found_categories(F.col("job_description")), ", ").alias("categories"))


_OF_CATEGORY = {c: f"list_filter(f, lambda x: list_contains([{', '.join(quote(n) for n in names)}], x))" for c, names in sorted(vocab.SKILLS.items())}
_BY_CATEGORY = "'{' || array_to_string(list_filter([" + ", ".join(f"CASE WHEN len({o}) > 0 THEN {quote(chr(34) + c + chr(34) + ':[' + chr(34))} || array_to_string({o}, {quote(chr(34) + ',' + chr(34))}) || {quote(chr(34) + ']')} END" for c, o in _OF_CATEGORY.items()) + "], lambda x: x IS NOT NULL), ',') || '}'"
_WITH_CATEGORY = "'[' || array_to_string(list_transform(f, lambda x: '{\"name\":\"' || x || '\",\"category\":\"' || " + "CASE " + " ".join(f"WHEN list_contains([{', '.join(quote(n) for n in names)}], x) THEN {quote(c)}" for c, names in vocab.SKILLS.items()) + " END || '\"}'), ',') || ']'"


@query(over(f"SELECT job_id, {_BY_CATEGORY} AS by_category, {_WITH_CATEGORY} AS with_category FROM found", f", found AS (SELECT job_id, {_SKILL_SQL} AS f FROM jobs)"))
def skills_by_category(spark, sf_dir):
    found = features.skills()
    text = F.col("job_description")
    return texts(spark, sf_dir).select("job_id", F.to_json(found.found_by_category(text)).alias("by_category"), F.to_json(found.found_with_category(text)).alias("with_category"))


@query(over(f"SELECT job_id, array_to_string({s_list([(n, f'contains({s_low(chr(106) + "ob_description")}, {quote(n.lower())})') for names in vocab.SKILLS.values() for n in names])}, ', ') AS skills FROM jobs"))
def skills_substring(spark, sf_dir):
    names = [n for group in vocab.SKILLS.values() for n in group]
    return texts(spark, sf_dir).select("job_id", F.array_join(features.substring_skills(F.col("job_description"), names), ", ").alias("skills"))


_PARTS = "list_filter(list_transform(string_split(coalesce({}, ''), ','), lambda x: trim(x)), lambda x: x <> '')"
_MOVED = ", ".join(map(quote, sorted(set(vocab.LEGACY_TOOLS) | {n for n, _ in _TOOL_NAMES})))


@query(
    over(
        f"SELECT id, skills, tools FROM (SELECT id, nullif(array_to_string(list_filter(i, lambda x: NOT list_contains([{_MOVED}], x)), ', '), '') AS skills, nullif(array_to_string(list_concat(h, list_filter(i, lambda x: list_contains([{_MOVED}], x) AND NOT list_contains(h, x))), ', '), '') AS tools, coalesce(s, '') AS s, coalesce(t, '') AS t FROM p) WHERE (s <> '' OR t <> '') AND (coalesce(skills, '') <> s OR coalesce(tools, '') <> t)",
        f", p AS (SELECT id, skills AS s, tools AS t, {_PARTS.format('skills')} AS i, {_PARTS.format('tools')} AS h FROM jobs)",
    )
)
def tool_skill_split(spark, sf_dir):
    return features.split_tools(jobs(spark, sf_dir), vocab.LEGACY_TOOLS + [n for n, _ in _TOOL_NAMES])


@query(f"SELECT doc_id, {s_cascade([(f'lang = {quote(c)}', quote(n)) for c, n in vocab.LANGUAGE_NAMES.items()], quote('Unknown'))} AS language FROM documents")
def language_names(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", features.language_name(F.col("lang")).alias("language"))


_WORDS = ", ".join(f"{{'n': {' + '.join(s_count('m', w) for w in words)}, 'o': {-k}, 'c': {quote(code)}}}" for k, (code, words) in enumerate(vocab.FUNCTION_WORDS.items()))


@query(f"WITH low AS (SELECT doc_id, lower(trim(coalesce(text, ''))) AS t FROM documents), best AS (SELECT doc_id, t, list_max([{_WORDS}]) AS b FROM (SELECT *, {_MARKED.format('t')} AS m FROM low)) SELECT doc_id, CASE WHEN length(t) < 20 OR b.n = 0 THEN 'NA' ELSE b.c END AS detected_language FROM best")
def language_detect(spark, sf_dir):
    return features.detect_language(spread(spark, sf_dir, "documents"), "text", None).select("doc_id", "detected_language")


def s_grams(source: str) -> str:
    """Tables word(key, w, n) and gram(key, gram, n) of the texts of ``source`` (key, t: lower case)."""
    return f"""word AS (
  SELECT key, '_' || w || '_' AS w, count(*) AS n FROM (SELECT key, unnest(regexp_extract_all(t, '\\p{{L}}+')) AS w FROM {source}) GROUP BY ALL
), gram AS (
  SELECT key, gram, sum(n)::BIGINT AS n FROM (SELECT key, n, substr(w, place, size) AS gram FROM (SELECT key, w, n, size, unnest(range(1, length(w) - size + 2)) AS place FROM word, (VALUES (1), (2), (3)) AS s(size)))
  WHERE gram <> '_' GROUP BY ALL
), ranked AS (SELECT key, gram, row_number() OVER (PARTITION BY key ORDER BY n DESC, gram) AS rank FROM gram QUALIFY rank <= 300)"""


_PROFILES = "profiled AS (WITH labelled AS (SELECT lang AS key, lower(coalesce(text, '')) AS t FROM documents WHERE lang IS NOT NULL), " + s_grams("labelled") + " SELECT key AS lang, gram, rank FROM ranked)"


@query("WITH " + _PROFILES + " SELECT lang, gram, CAST(rank AS INTEGER) AS rank FROM profiled")
def language_profiles(spark, sf_dir):
    return languages.learn(spread(spark, sf_dir, "documents"))


@query(
    "WITH " + _PROFILES + ", own AS (SELECT doc_id AS key, trim(lower(coalesce(text, ''))) AS t FROM documents WHERE length(trim(coalesce(text, ''))) >= 20), "
    + s_grams("own")
    + """, apart AS (
  SELECT key, l.lang, sum(coalesce(abs(r.rank - p.rank), 300)) AS d FROM ranked r CROSS JOIN (SELECT DISTINCT lang FROM profiled) l LEFT JOIN profiled p ON p.lang = l.lang AND p.gram = r.gram GROUP BY ALL
), best AS (SELECT key, first(lang ORDER BY d, lang) AS lang FROM apart GROUP BY key)
SELECT doc_id, coalesce(best.lang, 'NA') AS detected_language FROM documents LEFT JOIN best ON best.key = doc_id"""
)
def language_detect_profiles(spark, sf_dir):
    known = languages.Profiles(languages.learn(spread(spark, sf_dir, "documents")))
    return features.detect_language(spread(spark, sf_dir, "documents"), "text", None, known).select("doc_id", "detected_language")


# --- text --------------------------------------------------------------------------------------

_TAGS = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?i)<(br|p|div|h[1-6]|li|tr)[^>]*/?>', chr(10), 'g'), '<[^>]+>', '', 'g')"


@query(r"SELECT page_id, regexp_replace(regexp_replace(regexp_replace(" + _TAGS.format("html") + r", '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' *\n *', chr(10), 'g') AS text FROM pages")
def html_to_text(spark, sf_dir):
    return spread(spark, sf_dir, "pages").select("page_id", normalize.squeeze(normalize.strip_tags(F.col("html"))).alias("text"))


@query()
def text_normalize(spark, sf_dir):
    return spread(spark, sf_dir, "pages").select("page_id", normalize.normalize_text(F.col("html")).alias("text"))


def s_replaced(text: str, rules: list[tuple[str, str, str]]) -> str:
    """``text`` after every (pattern, replacement, flags), in order."""
    for pattern, to, flags in rules:
        begin = f"(?{flags})" if flags else ""
        text = f"regexp_replace({text}, {quote(begin + pattern)}, {quote(to.replace('$', chr(92)))}, 'g')"
    return text


_SQUEEZE = [(r"[ \t]+", " ", ""), (r"\n{3,}", "\n\n", ""), (r" *\n *", "\n", "")]


def s_section(p: str) -> tuple[str, str, str]:
    """A pattern up to the next heading or the end, without its look-ahead: what was to be seen is put back."""
    start, ahead, heading = p.partition(r".*?(?=")
    if not ahead:
        return p, "", "is"
    if heading.startswith("#"):
        return start + "[^#]*", "", "is"
    groups = len(re.findall(r"\((?!\?)", start)) + 1
    return f"(?:{start}.*?)+({heading.replace(chr(92) + 'Z', chr(92) + 'z')}", f"${groups}", "is"


_SECTIONS = [s_section(p) for p in vocab.BOILERPLATE]
_CLEAN = s_replaced(_TAGS.format("coalesce(html, '')"), [*normalize.MARKDOWN, *_SQUEEZE, *_SECTIONS])


@query(f"SELECT page_id, regexp_replace({s_replaced(f'lower({_CLEAN})', _SQUEEZE)}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') AS text FROM pages")
def text_clean(spark, sf_dir):
    """The chain without entities, which only a library's table decodes."""
    return spread(spark, sf_dir, "pages").select("page_id", normalize.normalize_text(F.col("html"), entities=False).alias("text"))


_BLANK = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+"
_AHEAD = "substr(rest, 201, 1800)"


def s_strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_BLANK}|{_BLANK}$', '', 'g')"


def s_last(stop: str, width: int) -> str:
    """Where the last ``stop`` of the part ahead stands, plus ``width``."""
    return f"(contains({_AHEAD}, {stop}), 200 + {width} + length(regexp_extract({_AHEAD}, '(?s)^(.*)' || regexp_escape({stop}), 1)))"


_CUTS = [s_last("chr(10) || chr(10)", 0)] + [s_last(x, 2) for x in ("'. '", "'.' || chr(10)", "'! '", "'? '")]
_CUT = "CASE " + " ".join(f"WHEN ({c})[1] THEN ({c})[2]" for c in _CUTS) + " ELSE 2000 END"
_CHUNKS = f"""WITH RECURSIVE cut(doc_id, step, chunk, rest) AS (
  SELECT doc_id, 0, '', {s_strip("coalesce(text, '')")} FROM documents
  UNION ALL SELECT doc_id, step + 1, {s_strip("substr(rest, 1, ends)")}, {s_strip("substr(rest, ends + 1)")} FROM (SELECT *, {_CUT} AS ends FROM cut WHERE length(rest) > 3200)
), piece AS (SELECT doc_id, step, chunk FROM cut WHERE step > 0 UNION ALL SELECT doc_id, step + 1, rest FROM cut WHERE length(rest) <= 3200)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY step) - 1 AS INTEGER) AS chunk_index, chunk AS chunk_text FROM piece WHERE length(chunk) >= 200"""


@query(_CHUNKS)
def text_chunks(spark, sf_dir):
    return chunk.explode_chunks(spread(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def chunk_embeddings(spark, sf_dir):
    rows = chunk.explode_chunks(spread(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.select("doc_id", "chunk_index", chunk.embed(F.col("chunk_text")).alias("embedding"))


# --- deduplication -----------------------------------------------------------------------------


@query(over("SELECT url, min(id) AS id FROM jobs WHERE trim(url) NOT IN ('', 'nan') GROUP BY url"))
def url_first_wins(spark, sf_dir):
    return dedup.first_by_url(jobs(spark, sf_dir).select("url", "id"), ["id"], url_cols=("url",)).select("url", "id")


@query(over("SELECT CASE WHEN company_url <> '' THEN company_url ELSE url END AS url, min(id) AS id FROM jobs WHERE company_url <> '' OR url <> '' GROUP BY ALL"))
def url_direct_first(spark, sf_dir):
    rows = jobs(spark, sf_dir)
    key = dedup.url_key("company_url", "url")
    return dedup.keep_first(rows.select("id", key.alias("url")), F.col("url"), ["id"]).select("url", "id")


_U = "nullif(regexp_replace(lower(url), '/+$', ''), '')"
_C = "nullif(regexp_replace(lower(company_url), '/+$', ''), '')"


@query(over(f"SELECT job_id, CASE WHEN ({_U} IS NOT NULL AND count(*) OVER (PARTITION BY {_U}) > 1) OR ({_C} IS NOT NULL AND count(*) OVER (PARTITION BY {_C}) > 1) THEN 1 ELSE 0 END AS has_url_duplicate FROM jobs"))
def url_duplicate_flag(spark, sf_dir):
    return dedup.flag_shared_urls(jobs(spark, sf_dir)).select("job_id", "has_url_duplicate")


@query("WITH newest AS (SELECT * FROM events ORDER BY event_id DESC LIMIT 500), first AS (SELECT user_id, event_type, min(event_id) AS keep FROM newest GROUP BY ALL) SELECT event_id FROM newest n JOIN first f ON n.user_id IS NOT DISTINCT FROM f.user_id AND n.event_type IS NOT DISTINCT FROM f.event_type WHERE event_id > keep")
def newest_n_duplicates(spark, sf_dir):
    return dedup.newest_duplicates(table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id", 500)


@query("SELECT min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def oldest_of_key(spark, sf_dir):
    return dedup.drop_newest_duplicates(table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id").select("event_id")


@query("WITH i AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY user_id), s AS (SELECT user_id, min(event_id) AS event_id FROM events WHERE event_type <> 'click' GROUP BY user_id) SELECT * FROM i UNION ALL SELECT * FROM s WHERE user_id NOT IN (SELECT user_id FROM i)")
def upsert_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    old = rows.filter("event_type <> 'click'").groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    return dedup.upsert(old, rows.filter("event_type = 'click'").select("user_id", "event_id"), "user_id", ["event_id"])


# --- retention ---------------------------------------------------------------------------------


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'MACHINERY')")
def orphan_rows(spark, sf_dir):
    parents = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'")
    return retention.orphans(table(spark, sf_dir, "orders"), parents, "o_custkey", "c_custkey").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE CAST(o_orderdate AS DATE) < DATE '1998-06-01' - 900")
def old_window_rows(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    out = retention.old_rows(table(spark, sf_dir, "lineitem"), parents, "l_orderkey", F.to_date("o_orderdate"), F.lit("1998-06-01").cast("date"), 900)
    return out.select("l_orderkey", "l_linenumber")


@query("SELECT count(*) FILTER (WHERE CAST(o_orderdate AS DATE) >= DATE '1998-06-01' - 900) AS chunks_inside_window, count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '1998-06-01' - 900) AS chunks_outside_window, count(*) FILTER (WHERE o_orderkey IS NULL) AS chunks_without_jobs FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 10 <> 3) ON o_orderkey = l_orderkey")
def live_window_counts(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").filter("o_orderkey % 10 <> 3").withColumnRenamed("o_orderkey", "l_orderkey")
    return retention.window_counts(table(spark, sf_dir, "lineitem"), parents, "l_orderkey", F.to_date("o_orderdate"), F.lit("1998-06-01").cast("date"), 900)


@query(over("SELECT job_id FROM jobs WHERE regexp_matches(posted_text, '^\\d{4}-\\d{2}-\\d{2}') AND CAST(substr(posted_text, 1, 10) AS DATE) < DATE '2024-02-01' - 30"))
def date_window_predicate(spark, sf_dir):
    return jobs(spark, sf_dir).filter(retention.is_old(retention.posted_day(F.col("posted_text")), F.lit("2024-02-01").cast("date"), 30)).select("job_id")


@query("SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def table_counts(spark, sf_dir):
    return retention.table_counts({t: table(spark, sf_dir, t) for t in ("orders", "customer", "lineitem")})


@query("SELECT l.doc_id FROM labels l WHERE l.doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 2 = 0)")
def already_done_exclusion(spark, sf_dir):
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").filter("doc_id % 2 = 0").select("doc_id"), "doc_id", "left_anti").select("doc_id")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)")
def restrict_to_pushed(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").filter("quality = 0"), "doc_id", "left_semi").select("doc_id", "n_chars")


@query(over("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {q}" for n, q in (("orphans", "(SELECT 1 FROM jobs j WHERE id % 7 = 0)"), ("old", "(SELECT 1 FROM jobs WHERE regexp_matches(posted_text, '^\\d{4}-\\d{2}-\\d{2}') AND CAST(substr(posted_text, 1, 10) AS DATE) < DATE '2024-02-01' - 30 AND id % 7 <> 0)"))) + ")"))
def cleanup_targets(spark, sf_dir):
    rows = jobs(spark, sf_dir).withColumn("posted_date", F.col("posted_text"))
    parents, chunks = rows.filter("id % 7 <> 0"), rows.select("id", "job_id")
    found = retention.targets(parents, chunks, chunks, F.lit("2024-02-01").cast("date"), 30)
    return retention.table_counts({"orphans": found[1].rows, "old": found[2].rows}).withColumnRenamed("table_name", "name")


# --- profiling ---------------------------------------------------------------------------------

_PROFILED = ["actual_role", "company_name", "country", "job_level", "job_type", "company_industry"]


@query(over(" UNION ALL ".join(f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ('', 'NA', 'Other')) AS filled, round(count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ('', 'NA', 'Other')) * 100.0::DOUBLE / count(*), 2) AS rate FROM jobs" for c in _PROFILED).replace(" AS column", ' AS "column"')))
def fill_rates(spark, sf_dir):
    return profile.fill_rate(jobs(spark, sf_dir), _PROFILED, ("", "NA", "Other")).withColumn("rate", F.col("rate").cast("double"))


@query(over(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT nullif({c}, '')) AS n_distinct, count(DISTINCT nullif({c}, '')) > 1 AND count(DISTINCT nullif({c}, '')) < 50 AS categorical FROM jobs" for c in [*_PROFILED, "url"])))
def distinct_counts(spark, sf_dir):
    out = profile.distinct_counts(jobs(spark, sf_dir), [*_PROFILED, "url"])
    return out.withColumn("categorical", profile.is_categorical(F.col("n_distinct")))


@query(over("SELECT job_level AS value, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM jobs), 2) AS percent FROM jobs WHERE job_level IS NOT NULL GROUP BY job_level ORDER BY n DESC, value LIMIT 10"))
def value_distribution(spark, sf_dir):
    return profile.value_distribution(jobs(spark, sf_dir), "job_level", 10).withColumn("percent", F.col("percent").cast("double"))


@query(over(f"SELECT job_level AS original, {_LEVEL_SQL} AS standard, count(*) AS n FROM jobs WHERE job_level IS NOT NULL GROUP BY ALL"))
def mapping_matrix(spark, sf_dir):
    return profile.mapping_matrix(jobs(spark, sf_dir).withColumn("std", classify.standard_level(F.col("job_level"))), "job_level", "std")


@query(over(f"SELECT 'job_level' AS original, 'job_level_std' AS standard, count(DISTINCT nullif(job_level, '')) AS n_original, count(DISTINCT {_LEVEL_SQL}) AS n_standard FROM jobs"))
def cardinality_change(spark, sf_dir):
    return profile.cardinality_change(jobs(spark, sf_dir).withColumn("job_level_std", classify.standard_level(F.col("job_level"))), [("job_level", "job_level_std")])


@query(over("SELECT 'level' AS \"column\", count(*) FILTER (WHERE job_level IS DISTINCT FROM CASE WHEN job_level IS NULL OR job_level IN ('', 'unknown', 'Unknown') THEN 'NA' ELSE job_level END) AS n_changed FROM jobs"))
def changed_values(spark, sf_dir):
    before = jobs(spark, sf_dir).select("job_id", "job_level")
    after = filters.standard_na(before, ["job_level"]).withColumnRenamed("job_level", "level")
    return profile.changed_rows(before, after, "job_id", [("job_level", "level")])


_AFTER = "SELECT job_id, country, CASE WHEN job_level IS NULL OR job_level IN ('', 'unknown', 'Unknown') THEN 'NA' ELSE job_level END AS job_level FROM jobs WHERE id % 10 <> 4"


@query(
    over(
        f"SELECT coalesce(b.job_id, a.job_id) AS job_id, CASE WHEN b.job_id IS NULL THEN 'added' WHEN a.job_id IS NULL THEN 'removed' ELSE 'changed' END AS change, CAST(b.job_id IS NOT NULL AS BIGINT) AS n_before, CAST(a.job_id IS NOT NULL AS BIGINT) AS n_after FROM (SELECT * FROM jobs WHERE id % 10 <> 3) b FULL JOIN ({_AFTER}) a ON a.job_id = b.job_id WHERE b.job_id IS NULL OR a.job_id IS NULL OR a.job_level IS DISTINCT FROM b.job_level OR a.country IS DISTINCT FROM b.country"
    )
)
def snapshot_changes(spark, sf_dir):
    rows = jobs(spark, sf_dir).select("id", "job_id", "country", "job_level")
    after = filters.standard_na(rows.filter("id % 10 <> 4"), ["job_level"])
    return profile.compare(rows.filter("id % 10 <> 3").drop("id"), after.drop("id"), ["job_id"])


@query("SELECT position, doc_id, lang, n_chars FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents) WHERE position IN (0, 100, 200, 300, 400)")
def fixed_sample(spark, sf_dir):
    return profile.fixed_sample(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id", [0, 100, 200, 300, 400])


@query("SELECT 'n_chars' AS \"column\", round(avg(n_chars), 2) AS mean, max(n_chars)::DOUBLE AS maximum, median(n_chars)::DOUBLE AS median FROM documents")
def length_summary(spark, sf_dir):
    return profile.summary(table(spark, sf_dir, "documents"), ["n_chars"])


@query(r"SELECT round(avg((length(text) - length(regexp_replace(text, '[ \t]+', ' ', 'g'))) * 100.0::DOUBLE / greatest(length(text), 1)), 4) AS reduction FROM documents")
def length_reduction(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.agg(F.round(profile.reduction_percent(F.col("text"), F.regexp_replace("text", r"[ \t]+", " ")), 4).cast("double").alias("reduction"))


@query(over("SELECT country, count(*) FILTER (WHERE platform = 'indeed') AS indeed, count(*) FILTER (WHERE platform = 'linkedin') AS linkedin FROM jobs WHERE country IS NOT NULL GROUP BY country"))
def country_platform_counts(spark, sf_dir):
    return profile.count_matrix(jobs(spark, sf_dir).filter("country is not null"), "country", "platform", ["indeed", "linkedin"])


@query(over("SELECT coalesce(country, CASE WHEN grouping(country) = 1 THEN 'TOTAL' END) AS country, coalesce(platform, CASE WHEN grouping(platform) = 1 THEN 'TOTAL' END) AS platform, count(*) AS n FROM jobs GROUP BY CUBE (country, platform)"))
def platform_totals(spark, sf_dir):
    rows = jobs(spark, sf_dir).cube("country", "platform").agg(F.count("*").alias("n"), F.grouping("country").alias("_c"), F.grouping("platform").alias("_p"))
    named = lambda c, flag: F.coalesce(c, F.when(F.col(flag) == 1, "TOTAL")).alias(c)
    return rows.select(named("country", "_c"), named("platform", "_p"), "n")


@query()
def normalize_reduction(spark, sf_dir):
    rows = spread(spark, sf_dir, "pages").withColumn("text", normalize.normalize_text(F.col("html")))
    return rows.agg(F.count("*").alias("n"), profile.reduction_percent(F.col("html"), F.col("text")).cast("double").alias("reduction"))


@query(over("SELECT count(*) AS n, coalesce(sum(is_remote), 0) AS remote FROM jobs"))
def flag_sum(spark, sf_dir):
    return jobs(spark, sf_dir).agg(F.count("*").alias("n"), F.coalesce(F.sum("is_remote"), F.lit(0)).alias("remote"))


@query("SELECT value FROM (SELECT c_mktsegment AS value FROM customer UNION SELECT o_orderstatus FROM orders)")
def value_union(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("value")).union(table(spark, sf_dir, "orders").select("o_orderstatus")).distinct()


# --- pipeline and streams ----------------------------------------------------------------------


@query()
def jobs_pipeline(spark, sf_dir):
    raw = jobs(spark, sf_dir).withColumn("posted_date", F.col("posted_text"))
    out = store.scratch_dir(spark, "jobs")
    plan.run(spark, raw, out)
    published = store.Snapshots(spark, out).read("jobs")
    return published.select("job_id", "platform", "job_relevance_score", "job_type_filled", "job_level_std", "job_function_std", "company_industry_std", "education_level", "tools", "is_research")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT DISTINCT concat(CAST(user_id AS VARCHAR), ':', event_type) AS key FROM events")
def stream_first_seen(spark, sf_dir):
    rows = _event_stream(spark, sf_dir).withColumn("key", F.concat_ws(":", "user_id", "event_type"))
    out = store.scratch_dir(spark, "stream")
    sink = ingest.first_seen(rows, "key", "ts", "60 days").select("key").writeStream.format("parquet").option("path", f"{out}/out").option("checkpointLocation", f"{out}/state")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("key string").parquet(f"{out}/out")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def stream_merge(spark, sf_dir):
    out = store.scratch_dir(spark, "merge")
    ingest.merge_into(_event_stream(spark, sf_dir).select("user_id", "event_id", "ts"), f"{out}/t", "user_id", ["ts", "event_id"], f"{out}/state").awaitTermination()
    return ingest.current(spark, f"{out}/t").select("user_id", "event_id")

"""The staged pipeline over job postings: raw, processed, enriched, published."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablemill.functions import chunk, classify, features, languages, normalize, score
from tablemill.operators import dedup, filters, report
from tablemill.sources import store

PERSISTED_NA = ["detected_language", "education_level", "education_field", "job_level"]


def collect(raw: DataFrame, now: Column | None = None, hours: int | None = None, platforms: list[str] | None = None, countries: list[str] | None = None) -> DataFrame:
    """Raw rows in their common form: wanted sources, ids, locations, flags and dates; recent ones if
    ``hours`` is given; of each id the last scanned row.

    A date that can't be read is missing (``preprocess`` assigns one).  An id that is missing is made
    from platform, country, source id and URL.  Columns whose name begins with an underscore go.
    """
    rows = store.without_internal(store.select_sources(raw, platforms, countries))
    have = set(rows.columns)
    text = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    made = filters.surrogate_id(F.coalesce(text("platform"), F.lit("")), F.coalesce(text("country"), F.lit("")), text("source_id"), text("url"))
    rows = rows.withColumn("job_id", F.coalesce(F.nullif(F.trim(text("job_id")), F.lit("")), made))
    if {"city", "state"} & have:
        place = filters.flat_location(text("city"), text("state"), text("country"))
        rows = rows.withColumn("location", F.coalesce(F.nullif(text("location"), F.lit("")), place))
    if "is_remote" in have:
        rows = rows.withColumn("is_remote", filters.flag(F.col("is_remote")))
    posted = filters.parse_posted(text("posted_date"))
    rows = rows.withColumn("posted_date", F.date_format(posted, "yyyy-MM-dd'T'HH:mm:ss"))
    if hours is not None:
        rows = rows.filter(filters.recent(F.try_to_timestamp("posted_date"), now if now is not None else F.current_timestamp(), hours))
    return dedup.last_of(rows, "job_id", ["scraped_at"])


def accept(raw: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Rows that pass the two-tier filter, first of each URL, with the keywords that let them in."""
    detail = filters.two_tier_detail(F.col("actual_role"), F.col("job_description"))
    rows = raw.withColumn("_d", detail).filter("_d.accepted")
    rows = rows.withColumn("filter_tier1_keywords", F.array_join("_d.tier1_keywords", ", ")).withColumn("filter_tier2_keywords", F.array_join("_d.tier2_keywords", ", ")).drop("_d")
    empty_level = F.coalesce(F.col("job_level"), F.lit("")) == ""
    indeed = F.col("platform") == "indeed"
    level = F.when(empty_level & indeed, classify.extract_level(F.col("actual_role"), F.col("job_description"))).otherwise(F.coalesce("job_level", F.lit("")))
    empty_function = F.coalesce(F.col("job_function"), F.lit("")) == ""
    function = F.when(empty_function & indeed, classify.extract_function(F.col("actual_role"), F.col("job_description"))).otherwise(F.coalesce("job_function", F.lit("")))
    rows = rows.withColumns({"job_level": level, "job_function": function})
    return dedup.first_by_url(rows, ["scraped_at", "job_id"], seen, ("url",))


def preprocess(raw: DataFrame, detector: Callable[[str], str] | languages.Profiles | None = None) -> DataFrame:
    """Dates, URL flag, clean text, language, education, research flag, level."""
    rows = filters.assign_dates(raw, "posted_date", F.col("scraped_at"))
    rows = dedup.flag_shared_urls(rows)
    rows = rows.withColumn("job_description_clean", normalize.normalize_text(F.col("job_description")))
    rows = features.detect_language(rows, "job_description_clean", "language", detector, source=raw)
    text = F.col("job_description")
    rows = rows.withColumns(
        {
            "education_level": features.education_levels(text),
            "education_field": features.education_field(text),
            "is_research": features.is_research(text, F.col("company_name")),
            "job_level": classify.refine_level(F.col("job_level"), F.col("actual_role")),
        }
    )
    return filters.standard_na(rows, PERSISTED_NA)


def enrich(processed: DataFrame, skills: features.Vocabulary | None = None, tools: features.Vocabulary | None = None) -> DataFrame:
    """Frequency and score, then the standardised columns; skills become categories."""
    skills, tools = skills or features.skills(), tools or features.tools()
    clean = F.col("job_description_clean")
    one, two = F.col("filter_tier1_keywords"), F.col("filter_tier2_keywords")
    rows = processed.withColumn("keyword_frequency", score.keyword_frequency(one, two, F.col("actual_role"), clean))
    return rows.withColumns(
        {
            "job_relevance_score": score.relevance_score(one, two, F.col("keyword_frequency")),
            "job_type_filled": classify.standard_job_type(F.col("job_type"), clean),
            "edu_level_filled": features.fill_education(F.col("education_level"), clean),
            "job_level_std": classify.standard_level(F.col("job_level")),
            "job_function_std": classify.standard_function(F.col("job_function"), clean),
            "company_industry_std": classify.standard_industry(F.col("company_industry"), F.col("company_name"), clean),
            "skills": F.array_join(skills.found_categories(clean), ", "),
            "tools": tools.found_string(clean),
        }
    )


def publish(enriched: DataFrame, jobs: DataFrame | None = None, details: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(jobs, details): the exported projection, and ids with descriptions, each merged by id into what was published before."""
    enriched = dedup.last_of(enriched, "job_id", ["scraped_at"] if "scraped_at" in enriched.columns else ["job_id"])
    rows = filters.export_projection(enriched)
    texts = enriched.select("job_id", F.coalesce("job_description", F.lit("")).alias("job_description"))
    merged = lambda old, new: new if old is None else dedup.upsert(old, new, "job_id")
    return merged(jobs, rows), merged(details, texts)


class Backfill:
    """Chunks and embeddings of the details that have none yet, and the counts that ride on writing them."""

    def __init__(self, details: DataFrame, chunks: DataFrame | None = None, only: DataFrame | None = None, model=None):
        self._told, self._made = Observation(f"details-{uuid.uuid4().hex}"), Observation(f"chunks-{uuid.uuid4().hex}")
        rows = details.select("job_id", F.col("job_description").cast("string").alias("job_description"))
        if only is not None:
            rows = rows.join(only.select("job_id").distinct(), "job_id", "left_semi")
        if chunks is None:
            rows = rows.withColumn("done", F.lit(False))
        else:
            rows = rows.join(chunks.select("job_id").distinct().withColumn("_d", F.lit(True)), "job_id", "left").withColumn("done", F.col("_d").isNotNull()).drop("_d")
        empty = F.trim(F.coalesce("job_description", F.lit(""))) == ""
        self._sorted = rows.withColumn("empty", empty)
        self._counts = {"processed": F.count_if(~F.col("empty") & ~F.col("done")), "skipped": F.count_if(F.col("done")), "empty": F.count_if(F.col("empty") & ~F.col("done"))}
        self._model = model

    def rows(self) -> DataFrame:
        """job_id, chunk_index, chunk_text, embedding."""
        todo = self._sorted.observe(self._told, *(c.alias(k) for k, c in self._counts.items())).filter("not done and not empty")
        made = chunk.explode_chunks(todo, "job_id", "job_description").observe(self._made, F.count("*").alias("inserted"))
        return made.withColumn("embedding", chunk.embed(F.col("chunk_text"), self._model))

    def counts(self) -> dict[str, int]:
        """Of the one write of ``rows``: details processed, had before, empty; chunks inserted."""
        return {k: int(v) for k, v in (self._told.get | self._made.get).items()}

    def failed(self) -> dict[str, int]:
        """The counts if writing failed: what was to do has failed."""
        found = self._sorted.agg(*(c.alias(k) for k, c in self._counts.items())).first().asDict()
        return {"processed": 0, "skipped": found["skipped"], "empty": found["empty"], "inserted": 0, "failed": found["processed"]}


def backfill_chunks(details: DataFrame, chunks: DataFrame | None = None, only: DataFrame | None = None, model=None) -> DataFrame:
    """job_id, chunk_index, chunk_text, embedding of the details that have no chunks yet."""
    return Backfill(details, chunks, only, model).rows()


def fingerprint(df: DataFrame, *more) -> str:
    """What tells an input from another: columns, rows (their order does not matter) and ``more`` that the result depends on."""
    row = F.xxhash64(*(F.col(f"`{c}`").cast("string") for c in df.columns))
    n, total, mix = df.agg(F.count("*"), F.sum(F.pmod(row, F.lit(1 << 31))), F.bit_xor(row)).first()
    return hashlib.sha256(json.dumps([df.columns, n, total, mix, *map(str, more)]).encode()).hexdigest()


def run(
    spark: SparkSession, raw: DataFrame | None, root: str, run: str | None = None, dry_run: bool = False, model=None, now: Column | None = None, hours: int | None = None,
    platforms: list[str] | None = None, countries: list[str] | None = None, embeddings: bool = True, detector: Callable[[str], str] | languages.Profiles | None = None, resume: bool = False, reports: bool = False,
) -> dict:
    """All stages, each a snapshot; any failure before publishing leaves the last run in place.

    ``hours``, ``platforms`` and ``countries`` narrow what is taken in; without ``raw`` the accepted rows of the last
    published run are taken again.  Jobs and details are merged into those published before.  Chunks and embeddings
    come last and may fail without failing the run, or be left out: those published before stay.  With ``resume`` a
    run of the same id and the same input goes on behind its last complete stage.  ``reports`` writes three texts beside the tables.  The manifest holds rows and seconds
    of each table, whether it was taken over, and how many details were embedded, had been before, were empty, or failed.
    """
    run = run or store.run_id()
    shots, tables = store.Snapshots(spark, root), []
    before = shots.latest()
    known = {t["table"] for t in before["tables"]} if before else set()
    old = lambda name: shots.read(name, before["run_id"]) if name in known else None
    if raw is None and "jobs_raw" not in known:
        raise ValueError("no rows are given and none are published")
    given = None
    if resume:
        source = raw if raw is not None else old("jobs_raw")
        given = fingerprint(source, raw is None, now, hours, platforms, countries, detector is not None, before and before["run_id"])

    def stage(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        done = shots.finished(run, name, given) if resume else None
        tables.append(done or shots.write(run, name, build()))
        if resume and not done:
            shots.finish(run, name, given, tables[-1])
        return shots.read(name, run)

    accepted = stage("jobs_raw", lambda: accept(collect(store.spread(raw), now, hours, platforms, countries)) if raw is not None else old("jobs_raw"))
    processed = stage("jobs_processed", lambda: preprocess(accepted, detector))
    enriched = stage("jobs_enriched", lambda: enrich(processed))
    if dry_run:
        return {"run_id": run, "tables": tables, "published": False}
    stage("jobs", lambda: publish(enriched, old("jobs"))[0])
    details = stage("job_details", lambda: publish(enriched, None, old("job_details"))[1])
    error, counts, have = None, None, old("job_chunks")
    if embeddings:
        work = Backfill(details, have, model=model)
        try:
            stage("job_chunks", lambda: work.rows() if have is None else have.unionByName(work.rows()))
            counts = {"failed": 0} if tables[-1].get("resumed") else work.counts() | {"failed": 0}
        except Exception as e:  # the run is complete without new embeddings
            error, counts = str(e)[:500], work.failed()
    if have is not None and (error or not embeddings):
        stage("job_chunks", lambda: have)
    if reports:
        for name, text in report.run_reports(accepted, processed, enriched).items():
            store.put_text(spark, f"{shots.root}/run_id={run}/reports/{name}.txt", text)
    return shots.publish(run, tables, embedding_error=error, backfill=counts, published=True)

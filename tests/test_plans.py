"""Staged pipeline, snapshots, retention modes and streams."""

import json

import pytest
from pyspark.sql import functions as F

from tablemill.operators import retention
from tablemill.plans import jobs
from tablemill.sources import store
from tablemill.standin import JOBS


@pytest.fixture(scope="module")
def raw(spark):
    docs = spark.range(120).select(F.col("id").alias("doc_id"), F.concat(F.lit("the text and more of the words in that line "), F.repeat(F.lit("word. "), 60)).alias("text"), F.lit("en").alias("lang"))
    return spark.sql(JOBS.replace("FROM documents", "FROM {documents}"), documents=docs).withColumn("posted_date", F.col("posted_text"))


def test_pipeline_runs_twice_and_merges(spark, raw, tmp_path):
    root = str(tmp_path / "w")
    first = jobs.run(spark, raw, root, "r1", reports=True)
    told = {k: (tmp_path / f"w/run_id=r1/reports/{k}.txt").read_text() for k in ("raw", "processed", "enriched")}
    assert "Values of platform" in told["raw"] and "First rows" in told["raw"] and "not_null" in told["raw"]
    assert "Not Duplicate" in told["processed"] and "mean_percent_removed" in told["processed"] and "job_description_clean" in told["processed"]
    assert "Before and after" in told["enriched"] and "Tags of skills" in told["enriched"] and "median" in told["enriched"]
    counts = {t["table"]: t["rows"] for t in first["tables"]}
    assert first["embedding_error"] is None and counts["jobs_raw"] == counts["jobs_processed"] == counts["jobs_enriched"] == counts["jobs"]
    second = jobs.run(spark, raw, root, "r2")
    assert {t["table"]: t["rows"] for t in second["tables"]}["jobs"] == counts["jobs"]
    shots = store.Snapshots(spark, root)
    assert shots.latest()["run_id"] == "r2"
    enriched = shots.read("jobs_enriched")
    assert {"keyword_frequency", "job_relevance_score", "job_type_filled", "edu_level_filled", "job_level_std", "job_function_std", "company_industry_std", "tools"} <= set(enriched.columns)
    assert enriched.filter("job_relevance_score < 1 or job_relevance_score > 10").count() == 0
    assert jobs.run(spark, raw, root, "r3", dry_run=True)["published"] is False and shots.latest()["run_id"] == "r2"


def test_embedding_failure_is_not_fatal(spark, raw, tmp_path):
    def broken(texts):
        raise ValueError("no model")

    out = jobs.run(spark, raw, str(tmp_path / "w"), "r1", model=broken)
    assert out["published"] is True and "no model" in out["embedding_error"]
    assert out["backfill"]["failed"] > 0 and out["backfill"]["processed"] == 0


def test_clean_up(spark, tmp_path):
    job = spark.createDataFrame([("a", "2020-01-01"), ("b", "2026-01-01"), ("c", "unknown")], "job_id string, posted_date string")
    details = spark.createDataFrame([(1, "a"), (2, "z")], "id int, job_id string")
    chunks = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "z", 0), (4, "c", 0)], "id int, job_id string, chunk_index int")
    found = retention.targets(job, details, chunks, F.lit("2026-01-15").cast("date"), 30)
    tables = {"job_details": details, "job_chunks": chunks}
    plan = store.clean_up(spark, tables, found, str(tmp_path), "r", 30)
    assert [t["rows_archived"] for t in plan["targets"]] == [1, 1, 1] and not (tmp_path / "r").exists()
    with pytest.raises(ValueError):
        store.clean_up(spark, tables, found, str(tmp_path), "r", 30, "APPLY")
    store.clean_up(spark, tables, found, str(tmp_path), "r", 30, "APPLY", store.CONFIRMATION)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "r/survivors/job_chunks")).collect()) == [2, 4]
    assert json.loads((tmp_path / "r/manifest.json").read_text())["mode"] == "APPLY"
    counts = retention.window_counts(chunks, job, "job_id", retention.posted_day(F.col("posted_date")), F.lit("2026-01-15").cast("date"), 30).first()
    assert tuple(counts) == (1, 1, 1)


def test_reduction_by_the_normaliser(spark):
    from tablemill.functions import normalize
    from tablemill.operators import profile

    texts = ["<p>Fish &amp; chips</p>", "", None, "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.agg(profile.reduction_percent(F.col("t"), normalize.normalize_text(F.col("t"))).cast("double")).first()[0]
    clean = ["fish & chips", "", "", "plain"]
    assert abs(got - sum((len(t or "") - len(c)) * 100 / max(len(t or ""), 1) for t, c in zip(texts, clean)) / 4) < 1e-4


def test_json_state(spark, tmp_path):
    path = str(tmp_path / "s.json")
    assert store.get_json(spark, path, {"x": 0}) == {"x": 0}
    store.put_json(spark, path, {"ids": [1, 2]})
    store.put_json(spark, path, {"ids": [3]})
    assert store.get_json(spark, path) == {"ids": [3]}
    assert store.delete_json(spark, path) and not store.exists(spark, path)


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    for kind in ("parquet", "orc", "json"):
        df.write.format(kind).save(str(tmp_path / f"t.{kind}"))
        assert [tuple(r) for r in store.read_landing(spark, str(tmp_path / f"t.{kind}")).select("i", "s").collect()] == [(1, "a")]
    store.compact(spark, str(tmp_path / "t.parquet"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1
    assert store.per_term_quota(10, 4) == 7 and store.per_term_quota(0, 4) == 1
    both = store.union_scans({"x": df, "y": df.drop("s")})
    assert both.count() == 2 and "search_term_used" in both.columns


def test_late_rows_do_not_replace_newer_ones(spark, tmp_path):
    from tablemill.streaming import ingest

    batches = [[(1, 5, "a"), (2, 5, "a")], [(1, 9, "b"), (3, 1, "b")], [(1, 3, "c"), (2, 7, "c"), (2, 6, "d")]]
    schema = "k int, t int, v string"
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        ingest.merge_into(stream, str(tmp_path / "t"), "k", ["t"], str(tmp_path / "state"), buckets=4).awaitTermination()
    got = {r.k: (r.t, r.v) for r in ingest.current(spark, str(tmp_path / "t")).select("k", "t", "v").collect()}
    assert got == {1: (9, "b"), 2: (7, "c"), 3: (1, "b")}
    assert ingest.current(spark, str(tmp_path / "none")) is None
    assert all(len(v) <= 2 for v in ingest._versions(spark, str(tmp_path / "t")).values())


def test_upsert_order(spark):
    from tablemill.operators import dedup

    stored = spark.createDataFrame([(1, 9, "old"), (2, 1, "old"), (None, 1, "n")], "k int, t int, v string")
    new = spark.createDataFrame([(1, 3, "late", 1), (2, 4, "x", 1), (2, 5, "y", 2), (4, 0, "z", 3)], "k int, t int, v string, w int")
    got = {(r.k, r.t, r.v, r.w) for r in dedup.upsert(stored, new, "k", ["t"]).collect()}
    assert got == {(1, 9, "old", None), (2, 5, "y", 2), (None, 1, "n", None), (4, 0, "z", 3)}
    assert {(r.k, r.v) for r in dedup.upsert(stored, new.drop("w"), "k").collect()} == {(1, "late"), (2, "y"), (None, "n"), (4, "z")}


def test_rows_are_brought_to_their_common_form(spark):
    rows = [
        ("linkedin", "US", "a", "2024-02-03", "2024-02-04T00:00:00", "true", "Springfield", "IL", "http://x/1", "i"), ("linkedin", "US", "a", "2024-02-05T10:00:00Z", "2024-02-05T00:00:00", "false", "", "IL", "http://x/1", "i"),
        ("Indeed", "DE", None, "soon", "2024-02-04T00:00:00", None, None, None, "http://x/2", "i"), ("other", "DE", "c", None, "2024-02-04T00:00:00", None, None, None, "http://x/3", "i"),
    ]
    raw = spark.createDataFrame(rows, "platform string, country string, job_id string, posted_date string, scraped_at string, is_remote string, city string, state string, url string, _internal string")
    got = {r.url: r for r in jobs.collect(raw, platforms=["LinkedIn", "indeed"]).collect()}
    assert set(got) == {"http://x/1", "http://x/2"} and "_internal" not in got["http://x/1"].asDict()
    one, two = got["http://x/1"], got["http://x/2"]
    assert (one.posted_date, one.is_remote, one.location) == ("2024-02-05T10:00:00", 0, "IL, US") and two.posted_date is None
    assert two.job_id.startswith("Indeed_DE__") and two.location == "DE"
    late = jobs.collect(raw, F.lit("2024-02-05 12:00:00").cast("timestamp"), hours=24)
    assert {r.url for r in late.collect()} == {"http://x/1", "http://x/2", "http://x/3"}
    assert jobs.collect(raw, F.lit("2024-03-05 12:00:00").cast("timestamp"), hours=24, platforms=["linkedin"]).count() == 0


def test_scan_stops_at_the_rate_limit(spark):
    df = spark.createDataFrame([(1,)], "i int")

    def fetch(term, quota):
        if term == "c":
            raise store.RateLimited
        if term == "b":
            raise ValueError("this term only")
        return df

    got = store.scan_terms(["a", "b", "c", "d"], fetch, 10)
    assert got.rows.count() == 1 and got.left == ["c", "d"] and got.failed == {"b": "this term only"}
    assert store.scan_terms([], fetch, 10) == store.Scan(None, [], {})
    got = store.scan_terms(["a", "b", "b2", "a", "b", "b2", "b3", "z"], lambda t, q: fetch("b" if t[0] == "b" else t, q), 10)
    assert got.left == ["z"] and set(got.failed) == {"b", "b2", "b3"}  # three in a row, not three in all
    first = got.rows.select("scraped_at").first()
    assert got.rows.select("scraped_at").first() == first


def test_published_tables_hold_all_runs(spark, raw, tmp_path):
    """Three runs of different rows, the third without a working model: nothing published before is lost."""
    shots = store.Snapshots(spark, str(tmp_path / "w"))

    def broken(texts):
        raise ValueError("no model")

    part = lambda k: raw.filter(f"id % 3 = {k}")
    ids = lambda name: {r.job_id for r in shots.read(name).select("job_id").distinct().collect()}
    jobs.run(spark, part(0), shots.root, "r1")
    one, chunks = ids("jobs"), ids("job_chunks")
    again = jobs.run(spark, part(1), shots.root, "r2")
    two, more = ids("jobs"), ids("job_chunks")
    assert one < two and chunks < more and ids("job_details") == two
    assert again["backfill"]["skipped"] == len(chunks) and again["backfill"]["processed"] + again["backfill"]["skipped"] + again["backfill"]["empty"] == len(two)
    assert again["backfill"]["inserted"] == shots.read("job_chunks", "r2").count() - shots.read("job_chunks", "r1").count()
    third = jobs.run(spark, part(2), shots.root, "r3", model=broken)
    assert "no model" in third["embedding_error"] and ids("job_chunks") == more and two < ids("jobs") == ids("job_details")
    assert third["backfill"]["failed"] == len(ids("jobs")) - len(two) and third["backfill"]["processed"] == 0
    jobs.run(spark, part(2).filter("id < 0"), shots.root, "r4", embeddings=False)
    assert ids("job_chunks") == more and len(ids("job_details")) == len(ids("jobs"))
    jobs.run(spark, None, shots.root, "r5", embeddings=False)
    assert ids("jobs") == ids("job_details") > two


def test_a_broken_run_resumes(spark, raw, tmp_path, monkeypatch):
    shots = store.Snapshots(spark, str(tmp_path / "w"))
    whole = jobs.run(spark, raw, str(tmp_path / "v"), "r1")
    enrich = jobs.enrich
    monkeypatch.setattr(jobs, "enrich", lambda rows: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.run(spark, raw, shots.root, "r1", resume=True)
    assert shots.latest() is None
    monkeypatch.setattr(jobs, "enrich", enrich)
    out = jobs.run(spark, raw, shots.root, "r1", resume=True)
    assert [t["table"] for t in out["tables"] if t.get("resumed")] == ["jobs_raw", "jobs_processed"]
    for t in whole["tables"]:
        a, b = spark.read.parquet(t["path"]), shots.read(t["table"], "r1")
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    # Another input does not take the old stages for its own.
    other = jobs.run(spark, raw.filter("id < 60"), shots.root, "r1", resume=True, dry_run=True)
    assert not any(t.get("resumed") for t in other["tables"])


def test_functions_are_known_to_sql(spark):
    from tablemill.functions import normalize, register

    register.register(spark)
    texts = ["<p>Fish &amp; **chips**</p><br>It's   `x`\n\n\n\n# Title", None, "", "<script>a</script>plain", "We are an equal opportunity employer. Apply now!"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df.createOrReplaceTempView("texts_for_sql")
    sql = [r[0] for r in spark.sql("SELECT normalize_text(t) FROM texts_for_sql").collect()]
    assert sql == [r[0] for r in df.select(normalize.normalize_text(F.col("t"))).collect()] and sql[0].startswith("fish & chips")
    assert spark.sql("SELECT size(chunk_text(repeat('word. ', 900))) AS n").first().n >= 2


def test_reports(spark):
    from tablemill.operators import report

    df = spark.createDataFrame([("a, b", "x"), ("b", "NA"), (None, "x")], "tags string, v string")
    assert tuple(report.tag_summary(df, "tags").first()) == (2, 3, 1.5)
    got = {r.column: (r.filled, r.rate, r.n_distinct) for r in report.completeness(df, ["tags", "v"]).collect()}
    assert got == {"tags": (2, 66.67, 2), "v": (2, 66.67, 2)}
    assert [r.column for r in report.column_diff(df.select("v"), df).collect()] == ["tags"] and report.column_diff(df, df).count() == 0
    text = report.table_report("Postings", df, ["v"], ["tags"])
    assert text.startswith("Postings\n========") and "Tags of tags" in text and "66.67" in text


def test_survivors_become_current(spark, tmp_path):
    shots = store.Snapshots(spark, str(tmp_path / "w"))
    job = spark.createDataFrame([("a", "2020-01-01"), ("b", "2026-01-01")], "job_id string, posted_date string")
    details = spark.createDataFrame([(1, "a"), (2, "b")], "id int, job_id string")
    chunks = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id int, job_id string, chunk_index int")
    shots.publish("r1", [shots.write("r1", n, t) for n, t in (("jobs", job), ("job_details", details), ("job_chunks", chunks))])
    found = retention.targets(job, details, chunks, F.lit("2026-01-15").cast("date"), 30)
    store.clean_up(spark, {"job_details": details, "job_chunks": chunks}, found, str(tmp_path / "c"), "r2", 30, "APPLY", store.CONFIRMATION, shots=shots)
    assert shots.latest()["run_id"] == "r2" and [r.id for r in shots.read("job_chunks").collect()] == [2] and shots.read("jobs").count() == 2
    assert shots.truncate("r3", "jobs")["rows"] == 0

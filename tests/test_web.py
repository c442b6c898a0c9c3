"""The board source and the upserting sink against a local server."""

import json
import os
import subprocess
import sys
import textwrap

import pytest
from fake_web import FakeWeb
from pyspark.sql import functions as F

from tablemill.plans import jobs
from tablemill.sources import boards, sink

HERE = os.path.dirname(os.path.abspath(__file__))


@pytest.fixture
def web():
    server = FakeWeb()
    yield server
    server.close()


def scan(spark, web, terms, stream=False, **options):
    boards.register(spark)
    reader = (spark.readStream if stream else spark.read).format("board")
    return reader.options(url=web.url, sites=json.dumps(["indeed", "linkedin"]), countries=json.dumps(["de", "fr"]), terms=json.dumps(terms), **options).load()


def test_board_batch(spark, web):
    web.sizes = {"a": 60, "b": 3, "c": 0}
    got = scan(spark, web, ["a", "b", "c"], page=25)
    assert got.rdd.getNumPartitions() == 4
    rows = got.collect()
    assert len(rows) == 4 * 63 and {r.scan_error for r in rows} == {None} and rows[0].is_remote == "true"
    assert len({r.job_url for r in rows}) == len(rows)
    assert sorted({(r.search_term_used, r.page_offset) for r in rows}) == [("a", 0), ("a", 25), ("a", 50), ("b", 0)]
    web.asked.clear()
    few = scan(spark, web, ["a", "b"], page=25, target=10).collect()  # 15 rows of each term and lane
    assert len(few) == 4 * (15 + 3) and {x[4] for x in web.asked} == {15}


def test_board_stops_and_tells(spark, web):
    """Three errors in a row stop a lane, a rate limit stops it at once, and every term that gave nothing is told."""
    web.sizes, web.fail = {t: 2 for t in "abcdefg"}, {"b": 404, "d": 404, "e": 410, "f": 404}
    rows = scan(spark, web, list("abcdefg")).cache()
    assert {r.search_term_used for r in rows.filter("scan_error is null").collect()} == {"a", "c"}
    told = {r.search_term_used: r.scan_error[:14] for r in boards.failures(rows).filter("site = 'indeed' and country = 'de'").collect()}
    assert sorted(told) == ["b", "d", "e", "f", "g"] and told["g"].startswith("not scanned") and told["e"].startswith("410")
    assert not any(x[2] == "g" for x in web.asked)
    rows.unpersist()
    web.asked.clear()
    web.fail = {"b": 429}
    told = boards.failures(scan(spark, web, list("abc"), tries=3, wait=0.01)).collect()
    assert len(told) == 8 and sum(x[2] == "b" for x in web.asked) == 4  # no lane asks again


def test_board_stream_resumes_without_repeating(spark, web, tmp_path):
    web.sizes = {"a": 60, "b": 3, "c": 30}

    def run(terms):
        rows = scan(spark, web, terms, stream=True, page=10, pages=2)
        sink = rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
        query = sink.trigger(processingTime="0 seconds").start()
        return query

    query = run(["a", "b", "c"])
    while sum(x[4] > 0 for x in web.asked) < 8:
        query.processAllAvailable()
    query.stop()
    query = run(["a", "b", "c"])
    query.processAllAvailable()
    query.stop()
    rows = spark.read.schema(f"{boards.SCAN}, {boards.ROWS}").parquet(str(tmp_path / "out"))
    assert rows.count() == rows.select("job_url").distinct().count() == 4 * 93
    pages = [x for x in web.asked if x[4] > 0]
    assert len(pages) == len(set(pages))


def test_board_stream_gives_up_a_lane(spark, web, tmp_path):
    web.sizes, web.fail = {t: 1 for t in "abcdef"}, {"b": 404, "c": 404, "d": 404}
    rows = scan(spark, web, list("abcdef"), stream=True)
    query = rows.writeStream.format("memory").queryName("lanes").option("checkpointLocation", str(tmp_path / "s")).start()
    query.processAllAvailable()
    query.stop()
    got = spark.table("lanes")
    assert {r.search_term_used for r in got.filter("scan_error is null").collect()} == {"a"} and not any(x[2] == "e" for x in web.asked)
    told = {r.search_term_used: r.scan_error for r in boards.failures(got).filter("site = 'indeed' and country = 'fr'").collect()}
    assert sorted(told) == list("bcdef") and told["b"].startswith("404") and told["f"].startswith("not scanned")


def test_postings_feed_the_pipeline(spark, web):
    web.sizes = {"a": 5}
    got = jobs.collect(boards.postings(scan(spark, web, ["a"])), platforms=["indeed"])
    assert got.count() == 10 and {r.job_id[:7] for r in got.collect()} == {"indeed_"}
    assert jobs.accept(got).filter("filter_tier1_keywords = 'optim'").count() == 10


def table(spark, n=230):
    return spark.range(n).select(F.concat(F.lit("job_"), F.col("id") % 200).alias("job_id"), F.col("id").alias("version"), F.lit("x").alias("_internal")).repartition(4)


def test_sink_waits_and_repeats(spark, web):
    web.broken_posts = [429, 503, 0, 500]
    sink.upsert(table(spark), web.url, "jobs", ["job_id"], ["version"], wait=0.01, pause=0)
    got = {k[0]: r for k, r in web.tables["jobs"].items()}
    assert len(got) == 200 and got["job_5"] == {"job_id": "job_5", "version": 205} and got["job_60"]["version"] == 60
    with pytest.raises(Exception, match="404"):
        web.broken_posts = [404] * 20
        sink.upsert(table(spark), web.url, "jobs", ["job_id"], ["version"], wait=0.01, pause=0)
    web.broken_posts = []
    with pytest.raises(Exception, match="no such key"):
        table(spark).write.format("rest_upsert").mode("append").options(url=web.url, table="jobs", key="nope").save()


def test_sink_commits_or_leaves_nothing(spark, web):
    sink.upsert(table(spark), web.url, "jobs", ["job_id"], ["version"], staging="staging", pause=0)
    assert len(web.tables["jobs"]) == 200 and web.tables["staging"] == {} and web.merged[0]["rows"] == 200
    web.broken_posts = [0, 0, 400]
    with pytest.raises(Exception, match="400"):
        sink.upsert(table(spark, 300).withColumn("version", F.lit(-1)), web.url, "jobs", ["job_id"], staging="staging", pause=0)
    assert web.tables["staging"] == {} and len(web.merged) == 1 and min(r["version"] for r in web.tables["jobs"].values()) >= 0


def test_sink_survives_killed_tasks(web, tmp_path):
    """Tasks whose worker is killed after some batches are repeated by Spark, and each key is there once."""
    script = textwrap.dedent(
        f"""
        import os, sys
        sys.path[:0] = [{os.path.dirname(HERE)!r}]
        from pyspark import TaskContext
        from pyspark.sql import SparkSession, functions as F
        from tablemill.sources import sink
        spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
        call = sink.web.call

        class Killing(sink._Writer):
            def write(self, rows):
                def some(rows):
                    for k, r in enumerate(rows):
                        if k == 70 and TaskContext.get().attemptNumber() < 2:
                            os._exit(9)
                        yield r
                return super().write(some(rows))

        class Source(sink.UpsertSource):
            def writer(self, schema, overwrite):
                return Killing(dict(self.options), schema)

        spark.dataSource.register(Source)
        df = spark.range(300).select(F.concat(F.lit("job_"), "id").alias("job_id")).repartition(2)
        df.write.format("rest_upsert").mode("append").options(url={web.url!r}, table="jobs", key="job_id", staging="staging", pause="0").save()
        """
    )
    path = tmp_path / "killed.py"
    path.write_text(script)
    done = subprocess.run([sys.executable, str(path)], env=os.environ | {"PYTHONPATH": os.path.dirname(HERE)}, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(web.tables["jobs"]) == 300 and web.tables["staging"] == {} and web.merged[0]["rows"] == 300 and web.posts > 7

"""Retention on laid-out tables, a database table by JDBC, and what a plan must not hold."""

from pyspark.sql import functions as F

from tablemill.operators import retention
from tablemill.sources import layout, store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orphans_and_old_rows_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = spark.range(1000).select(F.concat(F.lit("job_"), "id").alias("job_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("day"))
        days = days.unionByName(spark.createDataFrame([("job_x", None)], "job_id string, day date"))
        jobs = layout.write(days.filter("job_id != 'job_7'"), "laid_jobs", day=F.col("day"), buckets=4, path=str(tmp_path / "jobs"))
        chunks = layout.write(days.select("job_id", F.lit(0).alias("chunk_index")), "laid_chunks", buckets=4, path=str(tmp_path / "chunks"))
        lost = retention.orphans(chunks, jobs, "job_id")
        assert "Exchange" not in plan(lost) and [r.job_id for r in lost.collect()] == ["job_7"]
        old = layout.older_than(jobs, F.col("day"), "2024-03-31", 30)
        want = {r.job_id for r in days.filter("day < date'2024-03-01' and job_id != 'job_7'").collect()}
        assert {r.job_id for r in old.collect()} == want and len(want) > 100
        assert "PartitionFilters: [" in plan(old) and "posted_month" in plan(old).split("PartitionFilters")[1]
        kept = layout.drop_older(spark, "laid_jobs", "kept_jobs", F.col("day"), "2024-03-31", 30, buckets=4)
        assert kept.count() == jobs.count() - len(want) and "posted_month=none" in " ".join(kept.inputFiles())
        inner = chunks.join(jobs, "job_id")
        assert "Exchange" not in plan(inner) and inner.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("laid_jobs", "laid_chunks", "kept_jobs"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_table_by_jdbc(spark, tmp_path):
    """A database that comes with Spark stands for any other."""
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rows = spark.range(20).select(F.col("id").cast("int").alias("ID"), F.concat(F.lit("t"), "id").alias("NAME"))
    rows.write.format("jdbc").options(url=url, dbtable="JOBS", driver=driver).save()
    got = store.read_table(spark, url, "JOBS", driver=driver, partitionColumn="ID", lowerBound="0", upperBound="20", numPartitions="4")
    assert got.rdd.getNumPartitions() == 4 and got.count() == 20
    some = got.filter("ID >= 15").select("NAME")
    assert "PushedFilters: [*IsNotNull(ID), *GreaterThanOrEqual(ID,15)]" in plan(some) and sorted(r.NAME for r in some.collect()) == [f"t{k}" for k in range(15, 20)]


def test_tables_are_listed(spark):
    spark.range(3).selectExpr("id", "'x' AS s").createOrReplaceTempView("listed_rows")
    got = store.list_tables(spark)
    assert ("listed_rows", "id", "bigint", False) in {tuple(r) for r in got.select("table_name", "column", "type", "nullable").collect()}
    spark.catalog.dropTempView("listed_rows")

"""Order statistics, snapshot comparison and language profiles."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tablemill.functions import features, languages
from tablemill.operators import dedup, order, profile


def test_ranks_of_odd_values(spark):
    rng = random.Random(3)
    x = [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1) * 1e300, 0.0, -0.0, 5e-324, 7.0]) for _ in range(3000)] + [1.7e308, -1.7e308, math.inf, math.inf, -math.inf]
    n = [rng.choice([rng.randrange(-(2**63), 2**63), rng.randrange(10), 2**63 - 1, -(2**63)]) for _ in x]
    df = spark.createDataFrame([*zip(x, n), (None, None), (float("nan"), None)], "x double, n long").repartition(4)
    ranks = [0, 1, 7, 1500, 2999, len(x) - 1, len(x), -1]
    want = lambda v: [sorted(v)[r] if 0 <= r < len(v) else None for r in ranks]
    assert order.select_ranks(df, {"x": ranks, "n": ranks}) == {"x": want(x), "n": want(n)}
    assert order.quantiles(df, ["x"])["x"] == statistics.median(x)
    assert order.quantiles(df.limit(0), ["x", "n"]) == {"x": None, "n": None}
    assert order.quantiles(spark.range(11), ["id"], 0.25) == {"id": 2.5}


def test_median_of_ten_million_values(spark):
    """What comes back from a pass is bounded by the bins; Spark's own median would hold every distinct value in one task."""
    df = spark.range(10_000_001).select(((F.col("id") * 7_919) % 10_000_001).alias("v"))
    assert profile.summary(df, ["v"]).first().asDict() == {"column": "v", "mean": 5_000_000.0, "maximum": 10_000_000.0, "median": 5_000_000.0}


def test_newest_of_millions(spark):
    df = spark.range(3_000_000).select((F.col("id") * 3).alias("id"), (F.col("id") % 1_000_000).alias("k"))
    got = dedup.newest_duplicates(df, ["k"], newest=1_500_000)
    assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString() and "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.agg(F.count("*"), F.min("id")).first() == (500_000, 2_500_000 * 3)
    few = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a")], "id int, k string")
    assert sorted(r[0] for r in dedup.newest_duplicates(few, ["k"], newest=9).collect()) == [2]
    assert dedup.newest_duplicates(few, ["k"], newest=0).count() == 0 and dedup.newest_duplicates(few, ["k"], newest=1).count() == 0


def test_compare_versions(spark):
    schema = "k string, a string, b int"
    before = spark.createDataFrame([("same", "x", 1), ("gone", "x", 1), ("new value", "x", 1), ("to null", "x", 1), ("twice", "p", 1), ("twice", "q", 1), ("fewer", "x", 1), ("fewer", "x", 1), (None, "n", 1), ("", "", None), ("text", "null", 1)], schema)
    after = spark.createDataFrame([("same", "x", 1), ("come", "x", 1), ("new value", "y", 1), ("to null", None, 1), ("twice", "q", 1), ("twice", "p", 1), ("fewer", "x", 1), (None, "m", 1), ("", None, None), ("text", None, 1)], schema)
    got = {r.k: (r.change, r.n_before, r.n_after) for r in profile.compare(before, after, ["k"]).collect()}
    assert got == {"gone": ("removed", 1, 0), "come": ("added", 0, 1), "new value": ("changed", 1, 1), "to null": ("changed", 1, 1), "fewer": ("changed", 2, 1), None: ("changed", 1, 1), "": ("changed", 1, 1), "text": ("changed", 1, 1)}
    assert profile.compare(before, before, ["k"]).isEmpty() and profile.compare(before, after, ["k"], ["b"]).count() == 3
    assert {r.change for r in profile.compare(before, after, ["k", "a", "b"]).collect()} == {"added", "removed", "changed"}


def test_fixed_sample(spark):
    df = spark.createDataFrame([(i * 5, str(i)) for i in range(250)] + [(None, "n")], "i long, s string").repartition(3)
    assert sorted(map(tuple, profile.fixed_sample(df, "i", [0, 100, 200, 300]).collect())) == [(0, 0, "0"), (100, 500, "100"), (200, 1000, "200")]


SF = "/root/testdata/sf0.01/documents.parquet"


def test_language_profiles_on_unseen_documents(spark):
    docs = spark.read.parquet(SF).withColumn("held", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    ranks = languages.learn(docs.filter("not held"))
    assert "WindowGroupLimit" in ranks._jdf.queryExecution().executedPlan().toString()
    known = languages.Profiles(ranks)
    got = features.detect_language(docs.filter("held and length(text) >= 100"), "text", None, known)
    right = got.agg(F.avg((F.col("detected_language") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.97


@pytest.fixture(scope="module")
def profiles(spark):
    rows = [("en", "the cat and the dog sat on the mat with another one"), ("de", "der hund und die katze sitzen auf der matte"), ("ru", "собака и кошка сидят на ковре вместе"), (None, "x"), ("en", None)]
    return languages.Profiles(languages.learn(spark.createDataFrame(rows, "lang string, text string")))


def test_language_profiles_of_odd_texts(spark, profiles):
    texts = [None, "", "the dog", "   the dog and    ", "THE DOG AND THE CAT ARE THERE", "die katze und der hund sind da", "кошка и собака на ковре", "1234567890 1234567890 !!!", "the " * 20_000, "\U00010400" * 30]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [r.l for r in features.detect_language(df, "t", None, profiles, "l").orderBy("k").collect()]
    assert got[:9] == ["NA", "NA", "NA", "NA", "en", "de", "ru", "NA", "en"] and got[9] in ("en", "de", "ru")
    assert languages.Profiles(languages.learn(spark.createDataFrame([], "lang string, text string"))).detect("the dog and the cat are there") == "NA"

"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from tablemill import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    clean = lambda v: round(float(v), 8) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(clean(r[k]) for k in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    want = duck.sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, map(tuple, got.collect())) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


EDGES = [
    "MS Office and m.s.  office", "M.S. in physics", "ms", "m.s", "a ms offic", "ms\n\noffices", "knows m.a. position", "m.a. or b.a.", "BA positio", "b.s. in business",
    "B.S. in  businesslike, b.s. in bus", "bs in biology", "BS, ms office", "ms officms", "MBA", "ph.d", "Dr. of engineering", "4-year degree", "a.s. degree", "", "alumni",
]


@pytest.mark.parametrize("table", [queries.vocab.EDUCATION_LEVELS, queries.vocab.EDUCATION_FILL], ids=["levels", "fill"])
def test_look_aheads_without_look_aheads(spark, duck, table):
    got = spark.createDataFrame([(k, t) for k, t in enumerate(EDGES)], "k int, t string").select("k", queries.features.education_levels(queries.F.col("t"), table))
    values = ", ".join(f"({k}, {queries.quote(t)})" for k, t in enumerate(EDGES))
    want = duck.sql(f"SELECT k, {queries.s_levels(table)} FROM (VALUES {values}) AS v(k, job_description)").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


PAGES = [
    "<h1>Role</h1><p># Head\n* one\n2. two\n**bold** _it_ `code` [a](http://b) \\* \\_</p>",
    "Work. Equal  opportunity employer of all. Rest", "## About us we are\nlong # Tasks do", "about us without a mark", "# who we are to the end",
    "** About us** x", "***about us***** foo **about us** bar **next** end", "**about the company** text", "x **about us\n** y **z",
    "Apply now. Salary range 1.", "compensation of $5,000 a month. Ok", "A\u00a0B\u2003 \t\n\n\n\n C", "<script>a<b</script><STYLE x>s</style>t<br/>u<li>v", "---\nafter\n***\n", None, "", "   ",
]


def test_clean_text_in_sql(spark, tmp_path):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(PAGES)], "page_id bigint, html string")
    rows.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = queries.QUERIES["text_clean"](spark, str(tmp_path)).select("page_id", "text")
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(queries.ORACLES["text_clean"]).select("page_id", "text").fetchall())

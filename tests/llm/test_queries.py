"""Every registered query over the smallest tables, against DuckDB where SQL can say the same."""

import os

import duckdb
import pytest

from tablemill.llm import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    clean = lambda v: round(float(v), 8) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(clean(r[k]) for k in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    values = [tuple(r) for r in got.collect()]
    assert values and len(set(got.columns)) == len(got.columns)
    if "doc_id" in got.columns:
        k = got.columns.index("doc_id")
        assert sorted(v[k] for v in values) == [r[0] for r in duck.sql("select doc_id from documents order by 1").fetchall()]
    if name in registry.ORACLES:
        want = duck.sql(registry.ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got.columns, values) == rows(want.columns, want.fetchall())

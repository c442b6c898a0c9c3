"""The pipeline's stages one after the other against plain forms."""

import os

import brute
import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert sorted(out.columns) == sorted(docs.columns)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append({r.doc_id: r for r in docs.collect()})
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(seen[0]) == {i for i, t in source.items() if any(c.isalpha() for c in t)}
    assert set(seen[1]) == {i for i, v in brute.near_duplicates([(i, r.text) for i, r in seen[0].items()]).items() if v[2]}
    hits = brute.decontaminate([(i, r.text) for i, r in seen[1].items()], bench)
    assert set(seen[2]) == {i for i in seen[1] if not hits[i][1]}
    assert set(seen[3]) == set(seen[2]) == set(seen[4])
    for i, r in seen[3].items():
        assert brute.personal_data(r.text) == [] and (r.text == seen[2][i].text) == (not brute.personal_data(seen[2][i].text))
        assert r.n_chars == len(r.text)


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


EDGES = [
    (1, None, None), (2, "", "en"), (3, "   \n", "en"), (4, "12 34 !!", "en"), (None, "the and of that with for one document without an id", None), (None, "the and of that with for one document without an id", "en"),
    (5, "the and of that with for one document without an id", "en"), (6, "der und die mit nicht für ein", None), (6, "der und die mit nicht für ein", None), (7, "the mail of one is a.b@c.example.org and of that", "en"),
    (8, "the and of to that with " * 30_000, "en"), (9, "the and of to that with " * 30_000, "en"),
]


@pytest.fixture(scope="module")
def edges(spark):
    learnt = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = [(i, t, g, "s", 1, 0.5, "w", "x") for i, t, g in EDGES] + [(1000 + r.doc_id, r.text, r.lang, "s", 1, 0.5, "w", "x") for r in learnt[:60]]
    # Names that the operators use for columns of their own.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, row string, k1 int, score double, spans string, `found.id` string")


@pytest.mark.parametrize("k", range(5))
def test_each_stage_takes_odd_rows(spark, edges, k):
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, edges, SF)
    rows = out.collect()
    if k < 4:
        assert out.columns == edges.columns and out.dtypes == edges.dtypes
    own = [r for r in rows if r.doc_id is None or r.doc_id < 1000]
    ids = sorted((r.doc_id for r in own), key=str)
    if name == "language_id":
        assert not {1, 2, 3, 4} & set(ids) and {7, 8, 9, None} <= set(ids)
        assert {r.lang for r in own if r.doc_id in (6, None)} <= {"de", "en"}
    elif name == "near_dedup":
        assert ids == sorted([1, 2, 3, 4, 5, 6, 7, 8], key=str)
    elif name == "decontaminate":
        assert len(own) == len(EDGES)
    elif name == "pii":
        text = {r.doc_id: r.text for r in own}
        assert len(own) == len(EDGES) and text[7] == "the mail of one is [EMAIL] and of that" and text[1] is None and text[2] == "" and len(text[8]) == len(EDGES[10][1])
    else:
        assert len(own) == len(EDGES) and [r.n_tokens for r in own if r.doc_id in (1, 2)] == [0, 0]


@pytest.mark.parametrize("k", range(5))
def test_each_stage_takes_an_empty_table(spark, edges, k):
    assert corpus_pipeline.STAGES[k][1](spark, edges.limit(0), SF).count() == 0

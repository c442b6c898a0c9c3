"""Workers hold a bounded part of a table's texts: batches are short, and long texts are counted in parts."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablemill.functions import batches, chunk, features, languages, normalize

LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.execution.arrow.maxBytesPerBatch": str(2**31 - 1)}


@pytest.fixture
def wide(spark):
    """A session with Spark's own limits, whatever ran in it before."""
    before = {k: spark.conf.get(k) for k in LIMITS}
    for k, v in LIMITS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def seen(spark, rows):
    """Rows of the largest batch that a worker gets of ``rows`` texts of 10 characters."""
    texts = spark.range(rows, numPartitions=1).select(F.lpad(F.col("id").cast("string"), 10, "a").alias("t"))
    return texts.select(F.pandas_udf(lambda t: pd.Series([len(t)] * len(t)), "int")("t").alias("n")).agg(F.max("n")).first()[0]


@pytest.mark.parametrize("step", ["profiles", "detect", "unescape", "embed", "detector"])
def test_batches_are_short(wide, step):
    assert seen(wide, 3_000) == 3_000
    df = wide.createDataFrame([("en", "the cat and the dog sat on the mat")], "lang string, text string")
    if step == "profiles":
        languages.learn(df)
    elif step == "detect":
        languages.detect(F.col("text"), languages.Profiles(pd_ranks(wide)), wide)
    elif step == "unescape":
        normalize.normalize_text(F.col("text"))
    elif step == "embed":
        chunk.embed(F.col("text"))
    else:
        features.detect_language(df, "text", None, lambda t: "en")
    assert seen(wide, 3_000) <= batches.BATCH_ROWS


def pd_ranks(spark):
    return spark.createDataFrame([("en", "the", 1)], "lang string, gram string, rank int")


def counted(texts):
    found = {}
    for out in languages._counter(iter([pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])])):
        for gram, n in zip(out.column(1).to_pylist(), out.column(2).to_pylist()):
            found[gram] = found.get(gram, 0) + n
    return found


def test_parts_count_the_same(monkeypatch):
    texts = ["the cat² and_the dog", None, "", "ab", "c d " * 9, "x" * 70, "кошка 12 и собака, " * 5, "\U00010400a " * 20, "end"]
    codes = np.unique(np.concatenate([languages._codes(t or "") for t in texts]), return_counts=True)
    want = {languages._gram(c): n for c, n in zip(*(x.tolist() for x in codes))}
    for piece in (1, 7, 30, 1 << 17):
        monkeypatch.setattr(languages, "_PIECE", piece)
        assert counted(texts) == want
        for t in texts:
            own, n = np.unique(languages._codes(t or ""), return_counts=True)
            assert [x.tolist() for x in languages._counts(t or "")] == [own.tolist(), n.tolist()]


def test_memory_of_many_and_long_texts():
    """10,000 texts of a batch, or one of 4 MB: the n-grams of all of it at once took 100 bytes a character."""
    for texts in (["some words of a text " * 20] * 10_000, ["some words of a text " * 200_000]):
        batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])
        tracemalloc.start()
        try:
            n = sum(sum(out.column(2).to_pylist()) for out in languages._counter(iter([batch])))
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert n == len(texts) * len(languages._codes(texts[0][:21])) * (len(texts[0]) // 21) and peak < 60 << 20

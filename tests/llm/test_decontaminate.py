"""Longest matches, and benchmarks whose items share their words."""

import random
import re
import resource
import time

import brute
import numpy as np
import pyarrow as pa
import pytest

from tablemill.llm import decontaminate


def longest(docs, items, window):
    """{id: (words, place, item, place in it)} of the longest stretch that a document shares with an item, a window at least."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(brute.LOW))
    out = {}
    for i, text in docs:
        w, best = split(text), (0, 0, "", 0)
        for item, other in sorted(set(items)):
            v = split(other)
            least = min(window, len(v))
            for p in range(len(w)):
                for q in range(len(v) - least + 1):
                    n = 0
                    while p + n < len(w) and q + n < len(v) and w[p + n] == v[q + n]:
                        n += 1
                    if least and n >= least and (-n, p, item, q) < (-best[0], best[1], best[2], best[3]):
                        best = (n, p, item, q)
        out[i] = best if best[0] else (0, -1, None, -1)
    return out


@pytest.mark.parametrize("window", [4, 10])
def test_longest_matches(spark, window):
    rng = random.Random(window)
    words = "a b c é".split()
    parts = [[rng.choice(words) for _ in range(rng.choice((3, 5, 9, 14, 30)))] for _ in range(10)]
    some = lambda n: " ".join(" ".join(rng.choice(parts)) for _ in range(rng.randrange(n)))
    items = [(str(k), some(4)) for k in range(25)] + [("s", "b c"), ("t", "é a b")]
    docs = [(k, some(7)) for k in range(60)]
    found = decontaminate.match_benchmark(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), window=window)
    got = {r.doc_id: (r.longest_words, r.longest_at, r.longest_item, r.longest_item_at) for r in found.collect()}
    assert got == longest(docs, items, window)


def test_items_that_share_a_header():
    """2,000 items begin alike and one text of 450 KB repeats that beginning: places and items are listed, not their pairs."""
    header = " ".join(f"h{k}" for k in range(10))
    index = decontaminate._Index([(str(i), header + " " + " ".join(f"x{i}_{k}" for k in range(30))) for i in range(2_000)], 10)

    class Shared:
        value = index

    text = f"{header} " * 15_000 + header + " x7_0 x7_1 x8_2"
    row = [pa.array([1]), pa.array([text]), pa.array([[]], pa.list_(pa.int32())), pa.array([[]], pa.list_(pa.string())), pa.array([0]), pa.array([-1]), pa.array([None], pa.string()), pa.array([-1])]
    began, before = time.time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    (out,) = decontaminate._scanner(Shared)([pa.RecordBatch.from_arrays(row, decontaminate._STATE[:-1])])
    assert time.time() - began < 5 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000
    assert len(out.column(3)[0]) == 2_000 and [out.column(k)[0].as_py() for k in (4, 5, 6, 7)] == [14, 150_000, "7", 0]
    assert np.array_equal(out.column(2)[0].values, [0, 150_014])

"""Connected components against union-find: long chains, stars, cycles and repeated links."""

import random

import pytest

from tablemill.llm.components import components


def plain(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def chain(n, seed):
    ids = list(range(n))
    random.Random(seed).shuffle(ids)
    return list(zip(ids, ids[1:]))


CASES = {
    "none": [],
    "self": [(3, 3)],
    "chain": chain(150, 1),
    "ordered chain": [(i, i + 1) for i in range(60)],
    "star": [(500, i) for i in range(100)] + [(i, 500) for i in range(50)],
    "mixed": chain(40, 2) + [(100 + a, 100 + b) for a, b in chain(30, 3)] + [(200, 201), (201, 202), (202, 200), (200, 201)] + [(5, 5)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    df = spark.createDataFrame(CASES[name], "a long, b long")
    rows = components(df).collect()
    assert {r.node: r.root for r in rows} == plain(CASES[name]) and len(rows) == len({r.node for r in rows})

"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves; each half is quantised by its own codebook, and a pair of
centroids is a cell of the index.  A query visits cells in the order of the inner product that their
entries can reach, popped from a heap; the entries visited are reranked by the exact measure.  What
entries of a cell can reach is summed over the halves: the query's product with the centroid, which
is their mean, and ``SPREAD`` standard deviations of it, by the cell's radius and the query's
length.  Distances would not do: of vectors of unequal length the nearest by inner product are long,
and lie far away.

How far a query goes follows from the data.  Means, deviations and sizes of the cells tell how many
of the k nearest each cell should hold, and the query stops when the cells visited should hold a
certain share of them.  That share is chosen on the fitting sample, as the least of ``SHARES`` with
which queries of the sample find ``RECALL`` of their nearest there.  Vectors in clusters need a few
hundredths of the entries, vectors spread evenly over a sphere about half.

Codebooks are fitted on a bounded sample and grow with the fourth root of the table; every row is
indexed.  The cells of one first-half centroid form a row of the index, and of a row a query visits
the cells of its best second-half centroids; so a visit is a row and how many of its cells.  Rows
are put together into groups of about ``BLOCK`` entries, larger rows are cut by a number that each
entry has, and a query goes once to each block of the groups it visits; so a cell that holds a third
of all entries is many tasks.  A block returns the best ``k`` of each of its queries, never its pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablemill.llm.scratch import store

SAMPLE = 20_000
MOST_CENTROIDS = 256
ITERATIONS = 15
SPREAD = 2.0
RECALL = 0.96
#: Shares of the expected nearest, tried in this order, and sample queries that try them.
SHARES = (0.9, 0.95, 0.97, 0.98, 0.99, 0.995, 0.999)
TRIALS = 150
BLOCK = 6_000
QUERY_BLOCK = 4_000
_AT_ONCE = 256  # queries whose products with a block are held at once


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    random = np.random.default_rng(seed)
    k = min(k, len(np.unique(x, axis=0)))
    centre = x[random.choice(len(x), 1)]
    far = ((x - centre[0]) ** 2).sum(axis=1)
    while len(centre) < k:  # k-means++ seeding
        pick = random.choice(len(x), p=far / far.sum()) if far.sum() > 0 else random.integers(len(x))
        centre = np.vstack([centre, x[pick]])
        far = np.minimum(far, ((x - x[pick]) ** 2).sum(axis=1))
    for _ in range(ITERATIONS):
        near = _distance(x, centre).argmin(axis=1)
        count = np.bincount(near, minlength=len(centre))
        total = np.stack([np.bincount(near, weights=x[:, d], minlength=len(centre)) for d in range(x.shape[1])], axis=1)
        centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre)
    return centre


def _distance(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] - 2 * x @ centre.T + (centre**2).sum(axis=1)


def _radius(x: np.ndarray, centre: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Root mean square deviation, per dimension, of the rows of each centre."""
    far = ((x - centre[near]) ** 2).sum(axis=1) / max(1, x.shape[1])
    count = np.bincount(near, minlength=len(centre))
    return np.sqrt(np.bincount(near, weights=far, minlength=len(centre)) / np.maximum(count, 1))


def reach_in_order(first: np.ndarray, second: np.ndarray, size: np.ndarray, wanted: float) -> np.ndarray:
    """How many cells of each row are visited, cells (i, j) being taken by rising first[i] + second[j]
    until they hold ``wanted`` of ``size``.  Of a row the cells come by rising second[j], so their
    number tells which."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y, held_by = first[a].tolist(), second[b].tolist(), size[np.ix_(a, b)].tolist()
    reach, held, heap = [0] * len(x), 0, [(x[0] + y[0], 0, 0)]
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        reach[i] += 1
        held += held_by[i][j]
        # A cell is offered once its neighbours before it are taken: at most one of a row is in the heap.
        if j + 1 < len(y) and (i == 0 or reach[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if i + 1 < len(x) and reach[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
    out = np.zeros(len(first), dtype=np.int32)
    out[a] = reach
    return out


def _above(level: float, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """The share of a normal law above a level (a close form of its tail)."""
    z = (mean - level) / sd
    return 0.5 * (1 + np.tanh(0.7978845608 * (z + 0.044715 * z * z * z)))


class Codebooks:
    def __init__(self, sample: np.ndarray, centroids: int):
        self.width = sample.shape[1]
        self.half = max(1, self.width // 2)
        self.first = _kmeans(sample[:, : self.half], centroids, 1)
        self.second = _kmeans(sample[:, self.half :], centroids, 2) if self.width > 1 else np.zeros((1, 0))
        self.shape = len(self.first), len(self.second)
        i, j = self.cell(sample)
        self.radius = _radius(sample[:, : self.half], self.first, i), _radius(sample[:, self.half :], self.second, j)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distance(x[:, : self.half], self.first), _distance(x[:, self.half :], self.second)

    def shortfalls(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each half: the less, the larger the inner products that a centroid's entries can reach."""
        halves = (x[:, : self.half], self.first, self.radius[0]), (x[:, self.half :], self.second, self.radius[1])
        a, b = (-(q @ c.T) - SPREAD * np.sqrt((q**2).sum(axis=1))[:, None] * radius for q, c, radius in halves)
        return a, b

    def expected(self, q: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
        """How many of the k nearest of ``q`` each cell should hold, products in a cell being normal."""
        mean, var = [], []
        for half, centre, radius in ((q[: self.half], self.first, self.radius[0]), (q[self.half :], self.second, self.radius[1])):
            mean.append(centre @ half)
            var.append((half @ half) * radius**2)
        i, j = np.nonzero(sizes)
        m, held = mean[0][i] + mean[1][j], sizes[i, j]
        s = np.sqrt(var[0][i] + var[1][j]) + 1e-12
        low, high = (m - 8 * s).min(), (m + 8 * s).max()
        for _ in range(12):  # the level that k entries should pass
            level = (low + high) / 2
            low, high = (level, high) if (held * _above(level, m, s)).sum() > k else (low, level)
        out = np.zeros(sizes.shape)
        out[i, j] = held * _above(low, m, s)
        return out

    def choose_share(self, sample: np.ndarray, k: int, recall: float) -> float:
        """The least of SHARES that finds ``recall`` of the nearest within the sample; else all."""
        i, j = self.cell(sample)
        sizes = np.zeros(self.shape, dtype=np.int64)
        np.add.at(sizes, (i, j), 1)
        some = np.random.default_rng(3).choice(len(sample), min(TRIALS, len(sample)), replace=False)
        k = min(k, len(sample) - 1)
        first, second = self.shortfalls(sample[some])
        caught = np.zeros(len(SHARES))
        for q, a, b in zip(some, first, second):
            product = sample @ sample[q]
            product[q] = -np.inf
            top = np.argpartition(-product, k - 1)[:k] if k else []
            held = self.expected(sample[q], sizes, k)
            order = np.argsort((a[:, None] + b[None, :]).ravel(), kind="stable")
            before = np.empty(held.size)
            before[order] = np.cumsum(held.ravel()[order]) - held.ravel()[order]
            before = before.reshape(held.shape)[i[top], j[top]]
            caught += [(before < share * held.sum()).mean() if k else 1.0 for share in SHARES]
        return next((share for share, c in zip(SHARES, caught / max(1, len(some))) if c >= recall), 1.0)

    def cell(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.distances(x)
        return a.argmin(axis=1), b.argmin(axis=1)


def usable(column: str) -> Column:
    """Not null, not empty, no null or non-finite component, not zero."""
    c = F.col(column)
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return c.isNotNull() & finite & F.exists(c, lambda v: v != 0)


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)


def _assigner(shared):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                i, j = shared.value.cell(_rows(batch.column(1), shared.value.width))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))], ["id", "vector", "number", "i", "j"])

    return assign


def _prober(shared, sizes: np.ndarray, share: float, k: int, group: np.ndarray):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch.column(1), book.width)
                reach = []
                for q, a, b in zip(x, *book.shortfalls(x)):
                    if share >= 1:
                        reach.append(np.full(len(a), len(b), dtype=np.int32))
                        continue
                    held = book.expected(q, sizes, k)
                    # At least the entries of k others than the query itself.
                    reach.append(np.maximum(reach_in_order(a, b, held, share * held.sum()), reach_in_order(a, b, sizes, k + 1)))
                groups = [np.unique(group[np.flatnonzero(r)]) for r in reach]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reach, pa.list_(pa.int32())), pa.array(groups, pa.list_(pa.int32()))], ["id", "vector", "number", "reach", "groups"])

    return probe


def _reranker(shared, k: int):
    none = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})

    def compare(a: np.ndarray, q_id: np.ndarray, reach: np.ndarray, b: np.ndarray, e_id: np.ndarray, i: np.ndarray, j: np.ndarray) -> pd.DataFrame:
        _, far = shared.value.shortfalls(a)
        place = np.empty(far.shape, dtype=np.int32)
        np.put_along_axis(place, far.argsort(axis=1, kind="stable"), np.arange(far.shape[1], dtype=np.int32)[None, :], axis=1)
        seen = place[:, j] < reach[:, i]
        seen &= q_id[:, None] != e_id[None, :]
        rough = np.where(seen, a @ b.T, -np.inf)
        # The product's rounding depends on the place in the block: what is near the k-th is summed
        # again in one order, so that equal vectors get equal scores.
        slack = 1e-12 * a.shape[1] * np.sqrt((a**2).sum(axis=1)[:, None] * (b**2).sum(axis=1).max())
        last = np.partition(rough, -k, axis=1)[:, -k, None] if rough.shape[1] > k else np.full((len(a), 1), -np.inf)
        row, col = np.nonzero(seen & (rough >= last - slack))
        score = np.zeros(len(row))
        for d in range(a.shape[1]):
            score += a[row, d] * b[col, d]
        order = np.lexsort((e_id[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        return pd.DataFrame({"query_id": q_id[row[keep]], "vec_id": e_id[col[keep]], "score": score[keep]})

    def rerank(block: pd.DataFrame) -> pd.DataFrame:
        side = block["side"].to_numpy()
        q, e = block[side == 0], block[side == 1]
        if not len(q) or not len(e):
            return none
        b, e_id, i, j = np.stack(e["vector"].to_numpy()).astype(np.float64), e["id"].to_numpy(), e["i"].to_numpy(), e["j"].to_numpy()
        parts = []
        for at in range(0, len(q), _AT_ONCE):
            some = q.iloc[at : at + _AT_ONCE]
            parts.append(compare(np.stack(some["vector"].to_numpy()).astype(np.float64), some["id"].to_numpy(), np.stack(some["reach"].to_numpy()), b, e_id, i, j))
        return pd.concat(parts)

    return rerank


def _groups(sizes: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
    """(group of each row of the index, blocks of each group): rows in order, put together up to BLOCK entries."""
    group, blocks, held = np.zeros(len(sizes), dtype=np.int32), {0: 1}, 0
    for i, n in enumerate(sizes.sum(axis=1).tolist()):
        if held and held + n > BLOCK:
            blocks[len(blocks)] = 1
            held = 0
        group[i] = len(blocks) - 1
        held += n
        blocks[len(blocks) - 1] = max(1, -(-held // BLOCK))
    return group, blocks


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int | None = None,
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest inner products found for each row
    for which ``queries`` holds, among all other rows; ties go to the smaller id.

    ``centroids`` of each half are three times the fourth root of the rows (16 to ``MOST_CENTROIDS``) if not
    given.  A query visits cells as the module tells, and at least the entries of ``k`` others; with
    a ``recall`` above 1 it visits all, and the result is exact.
    Vectors that are null, empty, zero, of another width than the commonest, or hold null or
    non-finite components take no part, nor do rows without id; rows that repeat an id are entries of
    their own, but no query finds its own id.  Queries without candidates have no rows; nor has an empty
    table.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), queries.alias("is_query")).filter(F.col("id").isNotNull() & usable("vector"))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    widths = rows.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if widths is None:
        return empty
    width, total = widths
    rows = rows.filter(F.size("vector") == width)
    share = min(1.0, SAMPLE / total)
    picked = rows.filter(F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 40)) <= int(share * (1 << 40))).select("id", "vector").limit(2 * SAMPLE).collect()
    sample = np.array([r["vector"] for r in sorted(picked, key=lambda r: (r["id"], r["vector"]))]).reshape(-1, width)
    if not len(sample):  # a few rows, none of them chosen
        sample = np.array([r["vector"] for r in rows.select("vector").limit(1).collect()])
    codebooks = Codebooks(sample, centroids or min(MOST_CENTROIDS, max(16, int(3 * total**0.25))))
    wanted = codebooks.choose_share(sample, k, recall)
    book = spark.sparkContext.broadcast(codebooks)
    numbered = rows.select("id", "vector", F.monotonically_increasing_id().alias("number"))
    entries = store(numbered.mapInArrow(_assigner(book), "id long, vector array<double>, number long, i int, j int"), "cells")
    sizes = np.zeros(codebooks.shape, dtype=np.int64)
    for i, j, count in entries.groupBy("i", "j").count().collect():
        sizes[i, j] = count
    group, entry_blocks = _groups(sizes)
    asked = rows.filter("is_query").select("id", "vector", F.monotonically_increasing_id().alias("number"))
    probes = asked.mapInArrow(_prober(book, sizes, wanted, k, group), "id long, vector array<double>, number long, reach array<int>, groups array<int>")
    probes = store(probes, "probes")
    visits = dict(probes.select(F.explode("groups").alias("g")).groupBy("g").count().collect())
    # Bounded tables: at most as many rows as the first half has centroids.
    blocks = spark.createDataFrame([(g, n, max(1, -(-visits[g] // QUERY_BLOCK))) for g, n in entry_blocks.items() if g in visits], "g int, entry_blocks int, query_blocks int")
    of_row = spark.createDataFrame([(i, int(g)) for i, g in enumerate(group)], "i int, g int")
    part = lambda n: F.pmod(F.xxhash64("number"), F.col(n)).cast("int")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = probes.select("id", "vector", "number", "reach", F.explode("groups").alias("g")).join(F.broadcast(blocks), "g")
    q = q.select("g", part("query_blocks").alias("x"), span("entry_blocks").alias("y"), "id", "vector", "reach", F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(0).alias("side"))
    e = entries.join(F.broadcast(of_row), "i").join(F.broadcast(blocks), "g")
    e = e.select("g", span("query_blocks").alias("x"), part("entry_blocks").alias("y"), "id", "vector", F.lit(None).cast("array<int>").alias("reach"), "i", "j", F.lit(1).alias("side"))
    near = q.unionByName(e).groupBy("g", "x", "y").applyInPandas(_reranker(book, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_inverted_multi_index(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)

"""Benchmark decontamination by suffix arrays of the training text.

A shard is a run of documents in one task.  Its suffix array holds the word positions at which a
match can begin (the next words are the beginning of some benchmark window), sorted by the words
that follow, as far as a window reaches.  Every distinct beginning of a benchmark suffix is binary-searched
in it.  How far a match goes on beyond the window is found among the benchmark's whole suffixes, which are sorted too:
the longest is beside the place where the document's own suffix would stand.  So the work goes by the places found
and not by the pairs of a place with each item that has the same words.  Nothing is shuffled: documents
are read once for each block of the benchmark, and a block holds at most ``BLOCK_BYTES`` of text,
so what is broadcast is bounded whatever the benchmark's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm import textbuf
from tablemill.llm.scratch import short_batches, small_or_shuffled, store

WINDOW = 10
BLOCK_BYTES = 8 << 20
RUN_BYTES = 1 << 19
_HEAD = 3


class _Index:
    """One block of the benchmark: its vocabulary, its suffixes as search keys, and the window heads."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        raw, at = textbuf.utf8(pa.array([t for _, t in items], pa.string()))
        raw = textbuf.LOWER[raw]
        start, end, first = textbuf.words(raw, at, textbuf.ALNUM_WORDS)
        hashes = textbuf.word_hashes(raw, start, end)
        self.vocabulary, number = np.unique(hashes, return_inverse=True)
        number = number.astype(np.int64) + 1
        self.names = [i for i, _ in items]
        size = np.diff(first)
        windows = np.where(size >= window, size - window + 1, np.minimum(size, 1))
        self.item = np.repeat(np.arange(len(items)), windows)
        self.offset = np.arange(len(self.item)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.length = np.minimum(size, window)[self.item]
        self.head = int(min(_HEAD, self.length.min())) if len(self.length) else _HEAD
        place = first[:-1][self.item] + self.offset
        keys = _keys(number, place, place + self.length, window)
        order = np.lexsort((_suffix_ranks(number, first)[place], keys))
        # Equal beginnings are searched once; the suffixes that have them stand together, in their own order.
        self.key, begin = np.unique(keys[order], return_index=True)
        self.begin = np.append(begin, len(order))
        self.item, self.offset, self.length, self.place = self.item[order], self.offset[order], self.length[order], place[order]
        self.stop = first[1:][self.item]
        self.key_length = self.length[begin]
        own = np.unique(np.repeat(np.arange(len(self.key)), np.diff(self.begin)) * max(len(items), 1) + self.item)
        self.items_of = own % max(len(items), 1)
        self.items_begin = np.searchsorted(own, np.arange(len(self.key) + 1) * max(len(items), 1))
        self.prefix = _prefixes(number)
        self.number = number
        self.heads = np.unique(_heads(number, place, self.head, len(self.vocabulary) + 1)) if len(place) else np.zeros(0, np.int64)


def _suffix_ranks(number: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The place of each word's suffix (as far as its item goes) among all, by prefix doubling; equal suffixes share one."""
    last = np.repeat(first[1:], np.diff(first))
    rank, wide, here = number.copy(), 1, np.arange(len(number))
    longest = int(np.diff(first).max(initial=0))
    while wide < longest:
        ahead = here + wide
        follow = np.where(ahead < last, rank[np.minimum(ahead, max(len(rank) - 1, 0))] + 1, 0) if len(rank) else rank
        rank = np.unique(rank * (int(follow.max(initial=0)) + 1) + follow, return_inverse=True)[1].ravel().astype(np.int64)
        wide *= 2
    return rank


_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


def _prefixes(number: np.ndarray) -> np.ndarray:
    """Running hashes, by which any two stretches of words are compared at once."""
    weight = _powers(len(number))
    out = np.zeros(len(number) + 1, dtype=np.uint64)
    # Read from the end, a stretch's hash is a difference times a power; the power is made equal when two are compared.
    np.cumsum(textbuf.mix64(number.astype(np.uint64)) * weight[: len(number)], out=out[1:])
    return out


def _powers(n: int) -> np.ndarray:
    steps = np.full(n + 1, _BASE, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


class _Reach:
    """How far a shard's words agree with the benchmark's."""

    def __init__(self, index: _Index, number: np.ndarray, last: np.ndarray):
        self.index, self.number, self.last = index, number, last
        self.prefix = _prefixes(number)
        self.power = _powers(max(len(number), len(index.number)))

    def same(self, at: np.ndarray, entry: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The ``size`` words from ``at`` are those from the entry's place."""
        own, place = self.prefix, self.index.place[entry]
        a = (own[at + size] - own[at]) * self.power[place]
        b = (self.index.prefix[place + size] - self.index.prefix[place]) * self.power[at]
        return a == b

    def agreed(self, at: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Words on which both agree, by bisection."""
        low = np.zeros(len(at), dtype=np.int64)
        high = np.minimum(self.last[at] - at, self.index.stop[entry] - self.index.place[entry])
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = self.same(at, entry, middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def farthest(self, at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, entry): the longest agreement from ``at`` with a suffix that has the beginning ``key``."""
        index = self.index
        low, high = index.begin[key], index.begin[key + 1]
        best, which = np.zeros(len(at), dtype=np.int64), low.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            words = self.agreed(at[open_], middle)
            better = words > best[open_]
            best[open_[better]], which[open_[better]] = words[better], middle[better]
            # What follows the agreement tells on which side the document's suffix stands; an end comes first.
            mine, its = at[open_] + words, index.place[middle] + words
            next_ = lambda numbers, k, stop: np.where(k < stop, numbers[np.minimum(k, max(len(numbers) - 1, 0))], -1)
            after = next_(self.number, mine, self.last[at[open_]]) > next_(index.number, its, index.stop[middle])
            low[open_[after]], high[open_[~after]] = middle[after] + 1, middle[~after]
        return best, which

    def first_entry(self, at: int, key: int, which: int, size: int) -> int:
        """Of the entries that agree on ``size`` words, the first in the benchmark."""
        index = self.index

        def agrees(entry: int) -> bool:
            return index.stop[entry] - index.place[entry] >= size and bool(self.same(np.array([at]), np.array([entry]), np.array([size]))[0])

        low, high = int(index.begin[key]), which
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if agrees(middle) else (middle + 1, high)
        begin, low, high = low, which, int(index.begin[key + 1]) - 1
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if agrees(middle) else (low, middle - 1)
        own = np.arange(begin, low + 1)
        return int(own[np.lexsort((index.offset[own], index.item[own]))[0]])


def _keys(number: np.ndarray, start: np.ndarray, stop: np.ndarray, window: int) -> np.ndarray:
    """Byte strings that sort like the words number[start:stop]; four bytes a word, the last never zero."""
    grid = start[:, None] + np.arange(window)
    inside = grid < stop[:, None]
    codes = np.where(inside, number[np.minimum(grid, max(len(number) - 1, 0))] * 2 + 1, 0) if len(start) else np.zeros((0, window))
    return np.ascontiguousarray(codes.astype(">u4")).view(f"S{4 * window}").ravel()


def _heads(number: np.ndarray, place: np.ndarray, head: int, base: int) -> np.ndarray:
    out = number[place].copy()
    for k in range(1, head):
        out = out * base + number[place + k]
    return out


def _matches(index: _Index, number: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key): every place in the shard where a benchmark suffix's beginning stands."""
    none = np.zeros(0, np.int64)
    n = len(number) - index.head + 1
    if n <= 0 or not len(index.key):
        return none, none
    last = np.repeat(first[1:], np.diff(first))
    known = number > 0
    ok = known[:n] & (np.arange(n) + index.head <= last[:n])
    for k in range(1, index.head):
        ok &= known[k : k + n]
    place = np.flatnonzero(ok)
    found = _heads(number, place, index.head, len(index.vocabulary) + 1)
    at = np.searchsorted(index.heads, found)
    at[at == len(index.heads)] = 0
    place = place[index.heads[at] == found]
    if not len(place):
        return none, none
    keys = _keys(number, place, np.minimum(last[place], place + index.window), index.window)
    order = np.argsort(keys, kind="stable")
    array, place = keys[order], place[order]
    # All shard suffixes that begin with a key: from the key itself to the key followed by the highest bytes.
    low = np.searchsorted(array, index.key, side="left")
    top = index.key.copy().view(np.uint8).reshape(len(index.key), -1)
    top[np.arange(top.shape[1]) >= 4 * index.key_length[:, None]] = 255
    high = np.searchsorted(array, np.ascontiguousarray(top).view(index.key.dtype).ravel(), side="right")
    key = np.repeat(np.arange(len(index.key)), high - low)
    position = place[np.repeat(low - np.cumsum(high - low) + (high - low), high - low) + np.arange(len(key))]
    return position, key


def _longest(index: _Index, number: np.ndarray, first: np.ndarray, position: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each document, the words, document position, item and item position of its longest match."""
    docs = len(first) - 1
    out = [np.full(docs, v, dtype=np.int64) for v in (0, -1, -1, -1)]
    if not len(position):
        return tuple(out)
    reach = _Reach(index, number, np.repeat(first[1:], np.diff(first)))
    whole = index.key_length[key] == index.window
    size, entry = index.key_length[key].copy(), index.begin[key].copy()
    size[whole], entry[whole] = reach.farthest(position[whole], key[whole])
    doc = np.searchsorted(first, position, side="right") - 1
    pick = np.lexsort((position, -size, doc))
    owner, at = np.unique(doc[pick], return_index=True)
    for d, k in zip(owner.tolist(), pick[at].tolist()):
        # A text may hold a short item and the beginning of a longer one at one place: all keys there count.
        level = np.flatnonzero((position == position[k]) & (size == size[k])) if (position == position[k]).sum() > 1 else [k]
        found = [reach.first_entry(int(position[j]), int(key[j]), int(entry[j]), int(size[j])) for j in level]
        best = min(found, key=lambda e: (index.item[e], index.offset[e]))
        out[0][d], out[1][d], out[2][d], out[3][d] = size[k], position[k], index.item[best], index.offset[best]
    return tuple(out)


def _scanner(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: _Index = shared.value
        for batch in batches:
            for run in textbuf.runs(batch, "text", RUN_BYTES):
                raw, at = textbuf.utf8(run.column(1))
                raw = textbuf.LOWER[raw]
                start, end, first = textbuf.words(raw, at, textbuf.ALNUM_WORDS)
                hashes = textbuf.word_hashes(raw, start, end)
                number = np.searchsorted(index.vocabulary, hashes)
                number[number == len(index.vocabulary)] = 0
                number = np.where(index.vocabulary[number] == hashes, number + 1, 0) if len(index.vocabulary) else np.zeros(len(hashes), np.int64)
                position, key = _matches(index, number, first)
                docs = run.num_rows
                doc = np.searchsorted(first, position, side="right") - 1
                covered = np.zeros(len(number) + 1, dtype=np.int64)
                np.add.at(covered, position, 1)
                np.add.at(covered, position + index.key_length[key], -1)
                old = run.column(2)
                for d, spans in enumerate(old.to_pylist()):
                    for a, b in zip(spans[::2], spans[1::2]):
                        covered[first[d] + a] += 1
                        covered[first[d] + b] -= 1
                hit = np.zeros(len(number) + 2, dtype=np.int8)
                hit[1:-1] = np.cumsum(covered)[:-1] > 0
                words_of = np.repeat(np.arange(docs), np.diff(first))
                cut = np.ones(len(number) + 1, dtype=bool)
                cut[1:-1] = words_of[1:] != words_of[:-1]
                is_start = np.flatnonzero((hit[1:-1] == 1) & ((hit[:-2] == 0) | cut[:-1]))
                is_end = np.flatnonzero((hit[1:-1] == 1) & ((hit[2:] == 0) | cut[1:])) + 1
                owner = words_of[is_start]
                flat = np.stack([is_start - first[owner], is_end - first[owner]], axis=1).ravel().astype(np.int32)
                bound = np.searchsorted(owner, np.arange(docs + 1)) * 2
                spans = pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(flat))
                items: list[set] = [set(x) for x in run.column(3).to_pylist()]
                own = np.unique(doc * max(len(index.key), 1) + key)  # each beginning once for each document
                for d, k in zip((own // max(len(index.key), 1)).tolist(), (own % max(len(index.key), 1)).tolist()):
                    items[d].update(index.names[i] for i in index.items_of[index.items_begin[k] : index.items_begin[k + 1]].tolist())
                size, where, item, offset = _longest(index, number, first, position, key)
                before = np.asarray(run.column(4))
                better = size > before
                name = pa.array([index.names[i] if i >= 0 else None for i in item.tolist()], pa.string())
                choose = lambda new, k: pa.compute.if_else(pa.array(better), new, run.column(k))
                yield pa.RecordBatch.from_arrays(
                    [
                        run.column(0), run.column(1), spans, pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                        pa.array(np.maximum(size, before)), choose(pa.array(where - np.where(where >= 0, first[:-1], 0)), 5), choose(name, 6), choose(pa.array(offset), 7), pa.array(np.diff(first)),
                    ],
                    _STATE,
                )

    return scan


_STATE = ["id", "text", "spans", "items", "longest_words", "longest_at", "longest_item", "longest_item_at", "n_words"]


def match_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, spans, items, longest_words, longest_at,
    longest_item, longest_item_at.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is
    one window.  spans are the merged word ranges that occurring windows cover (start, end, start,
    end ... with exclusive ends), items the ids (as strings, sorted) of the items of these windows.
    longest_* tell the longest verbatim match; of equal ones the first in the document, then in the
    benchmark.  Words are runs of digits, letters and characters beyond ASCII, after lower-casing
    A-Z.  Null and empty texts have no words; items without id or words never match; repeated items
    count once.  Other columns are ignored.
    """
    spark = docs.sparkSession
    short_batches(spark)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).filter("item is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, text string, spans array<int>, items array<string>, longest_words long, longest_at long, longest_item string, longest_item_at long, n_words long"
    none = lambda t: F.lit(-1).cast(t)
    state = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"),
        F.lit(0).cast("long").alias("longest_words"), none("long").alias("longest_at"), F.lit(None).cast("string").alias("longest_item"), none("long").alias("longest_item_at"),
    )
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        index = _Index(sorted({(r["item"], r["text"]) for r in block.toLocalIterator()}), window)
        if k:
            state = store(state.drop("n_words"), "matched")
        state = state.mapInArrow(_scanner(spark.sparkContext.broadcast(index)), schema)
    return state.drop("text").withColumnRenamed("id", id_col)


def summary(matched: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated of ``match_benchmark``."""
    ends, starts = F.filter("spans", lambda x, i: i % 2 == 1), F.filter("spans", lambda x, i: i % 2 == 0)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x)
    out = matched.select(
        id_col, "n_words", (total(ends) - total(starts)).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "longest_words", "longest_at", "longest_item", "longest_item_at",
    )
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows in which some window of ``benchmark`` occurs.

    Rows are told by their text (two hashes), so null and repeated ids do not matter.
    """
    data = F.col(text_col).cast("string")
    keys = {"_k1": F.xxhash64(data), "_k2": F.crc32(data.cast("binary"))}
    rows = docs.filter(data.isNotNull()).select(F.struct(*(c.alias(k) for k, c in keys.items())).alias("_key"), data.alias("text"))
    matched = match_benchmark(rows, benchmark, "_key", "text", **options)
    gone = store(matched.filter(F.size("spans") > 0).select("_key._k1", "_key._k2").distinct(), "contaminated")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(c.alias(k) for k, c in keys.items()))
    return rows.join(small_or_shuffled(gone), list(keys), "left_anti").select("row.*")


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return summary(match_benchmark(docs, items))

"""Repeated passages by relative Lempel-Ziv parsing against blocks of reference text.

A window is ``WINDOW`` consecutive words; what an earlier place of the corpus (smaller id, or earlier in the same document)
also holds as a window is a copy.  Comparing every document with every other would be quadratic, so text
is routed: each window goes where its smallest seed (a run of ``SEED`` words, by hash) sends it, and
equal windows choose the same seed.  Consecutive windows of one seed travel together as a segment.

1. Seeds that segments choose are counted.  One that occurs once cannot belong to a copy.  The others are
   marked in a bitmap of fixed size; a mark too many costs work, not results.
2. Segments with a marked seed leave the texts.  Equal ones become one, which keeps its earliest place: all
   its other places are copies throughout.  Seeds that more than ``HOT`` different segments share (the edges of
   passages that very many documents quote) have their segments cut into single windows, which
   again become one where they are equal.
3. Segments of many seeds make a reference block.  A block is indexed by sorting its word sequences by prefix doubling up to a
   window, and its segments are parsed in the order of the corpus against all that stands before them: from a
   word where an earlier window begins the same, a factor runs along that source for as long as words agree.
   Factors of at least a window are copies; the parse goes on with the first window that reaches over the factor's
   end, so windows that lie across a boundary are looked up like all others.  What no factor covers is new.
4. New windows go back to their documents.  Marked windows that are not new are copies, and the words they cover are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.llm import textbuf
from tablemill.llm.scratch import short_batches, small_or_shuffled, store

WINDOW = 20
SEED = 8
#: Bits of the bitmap of repeated seeds: 16 MB, sent to every worker.
MARK_BITS = 1 << 27
#: Most windows of a segment, different segments of one seed, and segments of a block.
SEGMENT = 64
HOT = 500
BLOCK = 4_000
_LAST_ID = (1 << 63) - 1


class _Run:
    """Words and windows of some documents' texts."""

    def __init__(self, texts: pa.Array, window: int):
        self.window = window
        self.raw, self.edges = textbuf.utf8(texts)
        self.start, self.end, self.first = textbuf.words(self.raw, self.edges, textbuf.SPACE_WORDS)
        n = len(self.start)
        seed = min(SEED, window)
        self.seeds = least = textbuf.window_hashes(textbuf.word_hashes(self.raw, self.start, self.end), seed)
        wide, self.span = 1, window - seed + 1
        while wide < self.span:  # the smallest of ``span`` neighbours, by doubling
            step = min(wide, self.span - wide)
            least = np.minimum(least[: max(len(least) - step, 0)], least[step:])
            wide += step
        self.doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        last = self.first[1:][self.doc]
        self.seed = least
        #: First words of the windows that lie within one document.
        self.at = np.flatnonzero(np.arange(len(least)) + window <= last[: len(least)]) if n >= window else np.zeros(0, np.int64)

    def segments(self, marks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(first window, windows) of each run of windows that share their seed, of those that are marked."""
        at = self.marked(marks) if marks is not None else self.at
        if not len(at):
            return at, at
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (np.diff(at) > 1) | (self.seed[at[1:]] != self.seed[at[:-1]])
        begin = np.flatnonzero(fresh)
        run = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
        begin = np.flatnonzero(run % SEGMENT == 0)
        return at[begin], np.diff(np.append(begin, len(at)))

    def repeats(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """How often each segment holds its seed: a passage that repeats within one segment does so more than once."""
        size = n + self.span - 1
        out = np.zeros(len(at), dtype=np.int64)
        for a, b in _spans(np.cumsum(size)):
            own = size[a:b]
            begin = np.cumsum(own) - own
            place = np.repeat(at[a:b] - begin, own) + np.arange(own.sum())
            out[a:b] = np.add.reduceat(self.seeds[place] == np.repeat(self.seed[at[a:b]], own), begin, dtype=np.int64)
        return out

    def marked(self, marks: np.ndarray) -> np.ndarray:
        slot = self.seed[self.at] & np.uint64(64 * len(marks) - 1)
        return self.at[(marks[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1]

    def joined(self, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets): all words, or those ``kept``, each followed by one space, and where each begins."""
        keep = np.ones(len(self.start), dtype=bool) if kept is None else kept
        size = np.where(keep, self.end - self.start + 1, 0)
        at = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size, out=at[1:])
        # A space behind each document, so that each word has one to itself; then the bytes of words and their spaces stay.
        spaced = np.insert(self.raw, self.edges[1:], 32)
        inside = np.zeros(len(spaced) + 1, dtype=np.int8)
        inside[(self.start + self.doc)[keep]] = 1
        np.add.at(inside, (self.end + self.doc)[keep] + 1, -1)
        out = spaced[np.cumsum(inside, dtype=np.int8)[:-1] > 0]
        out[at[1:][keep] - 1] = 32
        return out, at


def _slices(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The texts data[begin:end]."""
    at = np.zeros(len(begin) + 1, dtype=np.int64)
    np.cumsum(end - begin, out=at[1:])
    flat = data[np.repeat(begin - at[:-1], end - begin) + np.arange(at[-1])]
    return pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(at), pa.py_buffer(flat)).cast(pa.string())


def _spans(sums: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of rows of at most a run's bytes (or one row), by their running ``sums``."""
    a = 0
    while a < len(sums):
        b = max(a + 1, int(np.searchsorted(sums, (sums[a - 1] if a else 0) + textbuf.RUN_BYTES, side="right")))
        yield a, b
        a = b


def _seed_counter(window: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textbuf.runs(batch, "text"):
                run = _Run(part.column(2), window)
                at, n = run.segments()
                seed, own = np.unique(run.seed[at], return_inverse=True)
                total = np.bincount(own.ravel(), run.repeats(at, n), minlength=len(seed)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(total)], ["seed", "n"])

    return count


def _cutter(shared, window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textbuf.runs(batch, "text", textbuf.RUN_BYTES // 2):
                run = _Run(part.column(2), window)
                at, n = run.segments(shared.value)
                flat, place = run.joined()
                sums = np.cumsum(place[at + n + window - 1] - place[at]) if len(at) else at
                for a, b in _spans(sums):
                    own, size = at[a:b], n[a:b]
                    owner = run.doc[own]
                    texts = _slices(flat, place[own], place[own + size + window - 1] - 1)
                    columns = [pa.array(run.seed[own].view(np.int64)), part.column(0).take(pa.array(owner)), part.column(1).take(pa.array(owner)), pa.array((own - run.first[owner]).astype(np.int32)), texts]
                    yield pa.RecordBatch.from_arrays(columns, ["seed", "id", "tie", "start", "text"])

    return cut


def _ranks(word: np.ndarray, window: int) -> np.ndarray:
    """For each place, the number of the ``window`` words from there on: equal ones share it.  By prefix doubling."""
    same = lambda x: np.unique(x, return_inverse=True)[1].ravel().astype(np.int64)
    rank, wide = same(word), 1
    while wide < window:
        step = min(wide, window - wide)
        n = max(len(rank) - step, 0)
        rank = same(rank[:n] * (int(rank.max(initial=0)) + 1) + rank[step:])
        wide += step
    return rank


def _parser(window: int):
    def parse(block: pa.Table) -> pa.Table:
        ident, tie, start = (np.asarray(block[c].combine_chunks()).astype(np.int64) for c in ("id", "tie", "start"))
        order = np.lexsort((start, tie, ident))
        ident, tie, start = ident[order], tie[order], start[order]
        run = _Run(block["text"].combine_chunks().take(pa.array(order)), window)
        rank = _ranks(textbuf.word_hashes(run.raw, run.start, run.end), window)[run.at] if len(run.at) else run.at
        # The earliest place of each window; the order of places is that of the corpus.
        _, first, number = np.unique(rank, return_index=True, return_inverse=True)
        earliest = first[number.ravel()] if len(rank) else rank
        own = np.arange(len(run.at))
        copy = earliest < own
        segment = run.doc[run.at]
        # A factor ends where its segment, its source's segment, or their agreement does.
        goes_on = np.zeros(len(own), dtype=bool)
        goes_on[1:] = (segment[1:] == segment[:-1]) & (copy[1:] == copy[:-1]) & (~copy[1:] | ((np.diff(earliest) == 1) & (segment[earliest[1:]] == segment[earliest[:-1]])))
        begin = np.flatnonzero(~goes_on)
        n = np.diff(np.append(begin, len(own)))
        place = lambda k: start[segment[k]] + run.at[k] - run.first[segment[k]]
        from_ = earliest[begin]
        known = pa.array(~copy[begin])  # new text has no source
        blank = lambda x: pa.compute.if_else(known, pa.scalar(None, pa.int64()), pa.array(x))
        return pa.table(
            {
                "id": ident[segment[begin]], "tie": tie[segment[begin]], "start": place(begin).astype(np.int64), "windows": n.astype(np.int64),
                "source_id": blank(ident[segment[from_]]), "source_tie": blank(tie[segment[from_]]), "source_start": blank(place(from_).astype(np.int64)),
            }
        )

    return parse


_FACTOR = "id long, tie long, start long, windows long, source_id long, source_tie long, source_start long"


def _remover(shared, window: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textbuf.runs(batch, "text"):
                run = _Run(part.column(2), window)
                n = len(run.start)
                copy = np.zeros(n + 1, dtype=bool)
                copy[run.marked(shared.value)] = True
                new = part.column(3)
                doc = np.repeat(np.arange(part.num_rows), np.asarray(pa.compute.fill_null(pa.compute.list_value_length(new), 0)))
                begin, size = (np.asarray(pa.compute.struct_field(new.flatten(), k)) for k in (0, 1))
                begin = run.first[doc] + begin
                known = np.zeros(n + 1, dtype=np.int64)
                np.add.at(known, begin, 1)
                np.add.at(known, begin + size, -1)
                copy &= np.cumsum(known) == 0
                covered = np.zeros(n + window + 1, dtype=np.int64)
                place = np.flatnonzero(copy)
                covered[place] += 1
                covered[place + window] -= 1
                gone = np.cumsum(covered)[:n] > 0
                flat, at = run.joined(~gone)
                data, ends = flat.tobytes(), at[run.first]
                total = np.zeros(n + 1, dtype=np.int64)
                np.cumsum(gone, out=total[1:])
                kept = [data[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                removed = total[run.first[1:]] - total[run.first[:-1]]
                yield pa.RecordBatch.from_arrays([part.column(4), pa.array(np.diff(run.first)), pa.array(removed), pa.array([x.decode() for x in kept], pa.string())], ["row", "n_words", "n_removed", "kept"])

    return remove


def _digested(shared, window: int):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _remover(shared, window)(batches):
            sums = [hashlib.sha256(x.encode()).hexdigest() for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.string())], [*batch.schema.names[:3], "kept_sha256"])

    return digest


def _marks(counts: DataFrame):
    """The bitmap of the seeds that occur more than once."""
    slot = F.col("seed").bitwiseAND(F.lit(MARK_BITS - 1)).alias("slot")
    repeated = counts.groupBy("seed").agg(F.sum("n").alias("n")).filter("n > 1").select(slot)
    words = repeated.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toArrow()
    marks = np.zeros(MARK_BITS // 64, dtype=np.uint64)
    marks[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return counts.sparkSession.sparkContext.broadcast(marks)


def _earliest(segments: DataFrame, key: list[str]) -> DataFrame:
    """One row for equal segments, at their earliest place."""
    return segments.groupBy(*key, "text").agg(F.min(F.struct("id", "tie", "start")).alias("at")).select(*key, "text", "at.*")


def _singles(segments: DataFrame, window: int) -> DataFrame:
    """Each window of ``segments`` as one of its own, under a seed of its own."""
    words = F.split("text", " ")
    each = segments.select("id", "tie", "start", words.alias("w")).select("id", "tie", "start", "w", F.explode(F.sequence(F.lit(0), F.size("w") - window)).alias("k"))
    text = F.array_join(F.slice("w", F.col("k") + 1, window), " ")
    return _earliest(each.select(text.alias("text"), "id", "tie", (F.col("start") + F.col("k")).cast("int").alias("start")), []).withColumn("seed", F.xxhash64("text"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """id (rows without one come last), tie (tells rows that repeat an id by their texts), text."""
    text = F.col(text_col).cast("string")
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text")]


def _factors(texts: DataFrame, marks, window: int) -> DataFrame:
    segments = texts.mapInArrow(_cutter(marks, window), "seed long, id long, tie long, start int, text string")
    own = store(_earliest(segments, ["seed"]), "segments")
    hot = store(own.groupBy("seed").count().filter(F.col("count") > HOT).select("seed"), "hot")
    columns = ["seed", "text", "id", "tie", "start"]
    if not hot.isEmpty():
        hint = small_or_shuffled(hot)
        split = _singles(own.join(hint, "seed", "left_semi"), window)
        own = store(own.join(hint, "seed", "left_anti").select(columns).unionByName(split.select(columns)), "segments")
    blocks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-own.count() // BLOCK))
    block = F.pmod(F.xxhash64("seed"), F.lit(blocks))
    return own.withColumn("block", block).groupBy("block").applyInArrow(_parser(window), _FACTOR)


def factors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The parse of all segments that share a seed with another, each at its earliest place: id, tie, start, windows, source_id,
    source_tie, source_start.  A factor covers ``windows`` + ``window`` - 1 words from ``start`` on; it copies them from its source, or is new
    where that is null.  (A null id shows as the largest long.)"""
    short_batches(docs.sparkSession)
    texts = docs.select(*_texts(docs, id_col, text_col))
    return _factors(texts, _marks(texts.mapInArrow(_seed_counter(window), "seed long, n long")), window)


def _removed(docs: DataFrame, row: Column, kind: str, id_col: str, text_col: str, window: int, worker, last: str) -> DataFrame:
    short_batches(docs.sparkSession)
    texts = docs.select(*_texts(docs, id_col, text_col))
    marks = _marks(texts.mapInArrow(_seed_counter(window), "seed long, n long"))
    new = _factors(texts, marks, window).filter("source_id is null").groupBy("id", "tie").agg(F.collect_list(F.struct("start", "windows")).alias("new"))
    rows = docs.select(*_texts(docs, id_col, text_col), row.alias("row"))
    both = rows.join(new, ["id", "tie"], "left").select("id", "tie", "text", F.coalesce("new", F.array().cast("array<struct<start:bigint,windows:bigint>>")).alias("new"), "row")
    return both.mapInArrow(worker(marks, window), f"row {kind}, n_words long, n_removed long, {last} string")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the words of repeated windows removed from the text (what is left is joined by single spaces), and
    ``n_words`` and ``n_removed`` in a struct ``repeats``.  A null text becomes empty.  See ``summary`` for odd rows."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    kind = docs.select(row.alias("row")).schema["row"].dataType.simpleString()
    out = _removed(docs, row, kind, id_col, text_col, window, _remover, "kept")
    columns = [F.col("kept").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*columns, F.struct("n_words", "n_removed").alias("repeats"))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256 (of the kept words, joined by single spaces).

    Words are what ASCII white space separates, unchanged.  Null, empty and short texts have no window and lose nothing.
    Rows without an id stand behind all others, ordered, like rows that repeat an id, by a hash of their texts; rows
    that repeat id and text are one document.  Other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return _removed(docs, F.col(id_col), kind, id_col, text_col, window, _digested, "kept_sha256").withColumnRenamed("row", id_col)


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return summary(spark.read.parquet(f"{sf_dir}/documents.parquet"))

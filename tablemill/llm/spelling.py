"""Spelling variants of a corpus's words, by a positional q-gram index with a count filter.

Words are padded and cut into positional ``Q``-grams.  One edit spoils at most ``Q`` of them, so two near
words share at least max(length) + Q - 1 - Q grams at the same place, or one apart behind an inserted letter.

1. Words are counted: each task counts its own texts, then Spark sums.
2. Each word is posted under its rarest grams.  Of any ``Q`` + 1 grams of a word one stands unspoilt in each near
   word, and if both order their grams alike the rarest unspoilt one is among the first ``Q`` + 1 of both.
   A posting list is a gram, its place and the word's length; a word of one letter less also looks into the lists of
   the next length at its place and the next.  Lists of more than ``CELL`` words are dealt to several
   cells: their own words stand in each cell and look from one, so no list is one task's work.
3. In a cell the lists of all its looking words are merged, in blocks of bounded size, over arrays: a 64-bit set of
   grams first, then the count filter on places, then the exact comparison.  A pair that meets in several lists counts in that
   of its rarest unspoilt gram, so pairs need no shuffle to become distinct; each cell sums what a word has found.
4. Forms point to words at least twice as frequent, so they make a forest, and roots are found by pointer jumping.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm import textbuf
from tablemill.llm.scratch import short_batches, small_or_shuffled, store

DIVISOR = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
Q = 3
CELL = 4_096
#: Rows of postings in a group, and pairs compared at once.
GROUP_ROWS = 20_000
PAIRS = 1 << 18
#: Distinct words that a task counts before it passes its counts on.
HELD = 200_000
_RUN = re.compile("[a-zÀ-ÿ]+")
#: Letters of runs, numbered from 1; 0 pads.  So a gram is a number below _SYMBOLS ** Q.
_LETTERS = [*range(97, 123), *range(0xC0, 0x100)]
_SYMBOLS = len(_LETTERS) + 1


def _counter(divisor: int):
    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for run in textbuf.runs(batch, "text"):
                raw, at = textbuf.utf8(run.column(1))
                data = textbuf.LOWER[raw].tobytes()
                for k, i in enumerate(run.column(0).to_pylist()):
                    own = Counter(_RUN.findall(data[at[k] : at[k + 1]].decode()))
                    begin = zlib.crc32(f"{'' if i is None else i}:".encode())
                    for word, n in own.items():
                        h = zlib.crc32(word.encode(), begin)
                        if not h % divisor:
                            cut = h % len(word)
                            word = word[:cut] + word[cut + 1 :]
                        total[word] += n
                    if len(total) > HELD:
                        yield emit(total)
                        total = Counter()
        yield emit(total)

    return count


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR, length: int = LEAST_LENGTH, least: int = LEAST_COUNT) -> DataFrame:
    """word, n: runs of letters (A-Z lower-cased) with the planted deletions, of ``length`` letters and ``least`` occurrences at least.
    A null text has no words; a row without an id takes the empty text for it; rows that repeat an id count one by one."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(_counter(divisor), "word string, n long")
    return counted.filter(F.char_length("word") >= length).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _grams(words: list[str], wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, grams, lengths): letter numbers padded to ``wide`` columns and each word's positional grams (-1 beyond its end)."""
    n = len(words)
    codes = np.array(words, dtype=f"<U{wide}").view(np.uint32).reshape(n, wide)
    table = np.zeros(0x100, dtype=np.int64)
    table[_LETTERS] = np.arange(1, _SYMBOLS)
    letters = table[codes]
    length = (codes > 0).sum(axis=1)
    padded = np.zeros((n, wide + 2 * (Q - 1)), dtype=np.int64)
    padded[:, Q - 1 : Q - 1 + wide] = letters
    grams = np.zeros((n, wide + Q - 1), dtype=np.int64)
    for k in range(Q):
        grams = grams * _SYMBOLS + padded[:, k : k + wide + Q - 1]
    grams[np.arange(wide + Q - 1) >= (length + Q - 1)[:, None]] = -1
    return letters.astype(np.uint8), grams.astype(np.int32), length


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = np.zeros(_SYMBOLS**Q, dtype=np.int64)
    for batch in batches:
        words = batch.column(0).to_pylist()
        if words:
            grams = _grams(words, max(map(len, words)))[1]
            count += np.bincount(grams[grams >= 0], minlength=len(count))
    gram = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(count[gram])], ["gram", "n"])


def _poster(shared):
    """Postings: (gram, length, place) of each word's rarest grams, and the two lists of the next length (``shorter``)."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            if not words:
                continue
            _, grams, length = _grams(words, max(map(len, words)))
            order = np.where(grams >= 0, rank[grams], np.iinfo(np.int32).max)
            bound = np.sort(order, axis=1)[:, Q]  # the first Q + 1; every place of the last one's gram counts too
            row, place = np.nonzero((order <= bound[:, None]) & (grams >= 0))
            # A gram that stands at two places in a row looks into the list between them once.
            look = np.unique(np.stack([np.tile(row, 2), np.tile(grams[row, place], 2), np.concatenate([place, place + 1])], axis=1), axis=0)
            columns = np.concatenate([grams[row, place], look[:, 1]]), np.concatenate([length[row], length[look[:, 0]] + 1]), np.concatenate([place, look[:, 2]])
            shorter = np.repeat([False, True], [len(row), len(look)])
            owner = pa.array(np.concatenate([row, look[:, 0]]))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x.astype(np.int32)) for x in columns), pa.array(shorter), batch.column(0).take(owner), batch.column(1).take(owner)], ["gram", "length", "place", "shorter", "word", "n"]
            )

    return post


def _bits(grams: np.ndarray) -> np.ndarray:
    """The set of a word's grams in 64 bits."""
    bit = textbuf.mix64(grams.astype(np.uint64)) >> np.uint64(58)
    return np.bitwise_or.reduce(np.where(grams >= 0, np.uint64(1) << bit, np.uint64(0)), axis=1)


def _near(letters, grams, rank, length, bits, a, b, place_b):
    """Which pairs (a no longer than b; both posted under the gram at ``place_b`` of b) are near and belong to that list."""
    one = length[a] < length[b]
    # One edit spoils at most Q grams on either side.
    ok = np.bitwise_count(bits[a] ^ bits[b]) <= 2 * Q
    a, b, place_b, one = a[ok], b[ok], place_b[ok], one[ok]
    at = np.flatnonzero(ok)
    ga, gb = grams[a], grams[b]
    here = (ga == gb) & (ga >= 0)
    moved = np.zeros_like(here)
    moved[:, :-1] = (ga[:, :-1] == gb[:, 1:]) & (ga[:, :-1] >= 0) & one[:, None]
    enough = (here | moved).sum(axis=1) >= length[b] + Q - 1 - Q
    a, b, place_b, one, here, moved, at, ga = (x[enough] for x in (a, b, place_b, one, here, moved, at, ga))
    la, lb = letters[a], letters[b]
    same = la == lb
    wide = la.shape[1]
    column = np.arange(wide)
    replaced = (~same).sum(axis=1) == 1
    # An insertion: equal before some place, and equal one apart from there on.
    front = np.where(same.all(axis=1), wide, np.argmin(same, axis=1))
    later = np.ones_like(same)
    later[:, :-1] = la[:, :-1] == lb[:, 1:]
    inserted = (later | (column < front[:, None]) | (column >= length[a][:, None])).all(axis=1)
    near = np.where(one, inserted, replaced)
    # The rarest unspoilt gram of the alignment, at its first place, decides which list the pair belongs to.
    # (Before the edit grams stay where they are, behind it they move; both kinds may show for one gram.)
    edge = np.where(one, front, wide + Q)
    spot = np.arange(here.shape[1])
    fits = np.where(one[:, None], (here & (spot < edge[:, None])) | (moved & (spot >= edge[:, None])), here)
    order = np.where(fits, rank[ga], np.iinfo(np.int32).max)
    first = np.argmin(order, axis=1)
    target = first + (one & (first >= edge))
    return at[near & (target == place_b)]


def _cells(shared):
    def compare(group: pa.Table) -> pa.Table:
        rank = shared.value
        words = group["word"].combine_chunks()
        coded = words.dictionary_encode()
        names, word = coded.dictionary.to_pylist(), np.asarray(coded.indices)
        wide = max(map(len, names)) + 1
        letters, grams, length = _grams(names, wide)
        bits, n = _bits(grams), np.zeros(len(names), dtype=np.int64)
        n[word] = np.asarray(group["n"].combine_chunks())
        gram, long, place, cell = (np.asarray(group[c].combine_chunks()).astype(np.int64) for c in ("gram", "length", "place", "cell"))
        shorter, looks = (np.asarray(group[c].combine_chunks()) for c in ("shorter", "looks"))
        key = np.unique(np.stack([gram, long, place, cell], axis=1), axis=0, return_inverse=True)[1].ravel()
        # Entries of the lists, in the order of lists and words; each word that looks gets the entries behind it, or all.
        alphabetical = np.argsort(np.argsort(np.array(names, dtype=object), kind="stable"), kind="stable") if names else np.zeros(0, np.int64)
        entry = np.flatnonzero(~shorter)
        entry = entry[np.lexsort((alphabetical[word[entry]], key[entry]))]
        ask = np.flatnonzero(looks)
        sort_key = key[entry] * (len(names) + 1) + alphabetical[word[entry]]
        low = np.where(shorter[ask], np.searchsorted(key[entry], key[ask], "left"), np.searchsorted(sort_key, key[ask] * (len(names) + 1) + alphabetical[word[ask]], "right"))
        size = np.searchsorted(key[entry], key[ask], "right") - low
        found_a, found_b = [], []
        ends = np.cumsum(size)
        begin = 0
        while begin < len(ask):
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS, "right")))
            own = size[begin:stop]
            k = np.repeat(low[begin:stop] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            a, b = np.repeat(word[ask[begin:stop]], own), word[entry[k]]
            hit = _near(letters, grams, rank, length, bits, a, b, place[entry[k]])
            found_a.append(a[hit])
            found_b.append(b[hit])
            begin = stop
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_a, found_b))
        one, other = np.concatenate([a, b]), np.concatenate([b, a])
        order = np.lexsort((alphabetical[other], -n[other], one))
        one, other = one[order], other[order]
        owner, first, count = np.unique(one, return_index=True, return_counts=True)
        best = other[first]
        pick = lambda x: pa.array([names[k] for k in x.tolist()], pa.string())
        return pa.table({"word": pick(owner), "n_near": pa.array(count.astype(np.int64)), "form": pick(best), "form_n": pa.array(n[best])})

    return compare


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, form, form_n of every word of ``words`` (word, n; each once) that has a near word; form is the most frequent one."""
    spark = words.sparkSession
    # One number for each gram that the alphabet allows.
    held = words.select("word").mapInArrow(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(_SYMBOLS**Q, dtype=np.int64)
    count[held["gram"].to_numpy()] = held["n"].to_numpy()
    rank = np.empty(len(count), dtype=np.int32)
    rank[np.lexsort((np.arange(len(count)), count))] = np.arange(len(count))
    shared = spark.sparkContext.broadcast(rank)
    postings = words.select("word", "n").mapInArrow(_poster(shared), "gram int, length int, place int, shorter boolean, word string, n long")
    key = ["gram", "length", "place"]
    sizes = store(postings.groupBy(*key).agg(F.count("*").alias("rows"), F.count_if(~F.col("shorter")).alias("entries")).filter("entries > 0 and rows > 1"), "lists")
    cells = F.ceil(F.col("rows") / CELL).cast("int")
    lists = sizes.select(*key, cells.alias("cells"))
    total = sizes.agg(F.sum(F.col("rows") + F.col("entries") * (cells - 1))).first()[0] or 0
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // GROUP_ROWS))
    own = F.pmod(F.xxhash64("word"), F.col("cells")).cast("int")
    placed = postings.join(lists, key).select(
        *key, "shorter", "word", "n", own.alias("own"), F.explode(F.when(F.col("shorter"), F.array(own)).otherwise(F.sequence(F.lit(0), F.col("cells") - 1))).alias("cell")
    ).withColumn("looks", F.col("own") == F.col("cell")).drop("own")
    group = F.pmod(F.xxhash64(*key, "cell"), F.lit(groups))
    found = placed.withColumn("group", group).groupBy("group").applyInArrow(_cells(shared), "word string, n_near long, form string, form_n long")
    best = F.min_by(F.struct("form", "form_n"), F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("f")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", "best.form", "best.form_n")


def roots(links: DataFrame) -> DataFrame:
    """word, root: where ``links`` (word, form; without cycles) lead, by doubling the steps until nothing moves."""
    now = store(links.select("word", F.col("form").alias("root")), "steps")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = store(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of ``words`` (word, n).

    Words are near if they differ by one inserted, deleted or replaced letter.  form is the near word of largest n (of
    equal ones the first in code-point order) if that is at least ``ratio`` times the word's, else null; root is where forms
    end, the word itself without one.  An empty table has no rows; a word that is near none has n_near 0.
    """
    words = store(words.select("word", "n"), "words")
    found = words.join(near_words(words), "word", "left")
    is_form = F.col("form_n") >= ratio * F.col("n")
    linked = store(
        found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "linked"
    )
    ends = roots(linked.filter("form is not null"))
    return linked.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(count_words(spark.read.parquet(f"{sf_dir}/documents.parquet")))

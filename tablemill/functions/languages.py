"""Language detection by character n-gram rank profiles.

A profile is a language's ``PROFILE`` most frequent n-grams of letters (one to three, of words between marks) in
their order.  A text has a profile of its own; its distance to a language is how far its n-grams are
out of place there, and the nearest language wins.  Profiles are learnt by Spark from labelled rows: each task
counts the n-grams of its texts, languages and n-grams are summed, and the first of each language are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablemill.functions import batches, rx, vocab

PROFILE = 300
#: Characters below which a text is not judged.
LEAST = 20
#: Distinct (language, n-gram) counts that a task holds before it passes them on.
_HELD = 100_000
#: Characters whose n-grams are listed at once: each takes about 100 bytes while they are.
_PIECE = 1 << 17
_BITS = np.int64(21)
_MARK = ord("_")


def _codes(text: str) -> np.ndarray:
    """The text's n-grams as numbers that sort like the n-grams: three code points, missing ones zero."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    own, at = np.unique(chars, return_inverse=True)
    letter = np.array([chr(c).isalpha() for c in own.tolist()], dtype=bool)[at.ravel()] if len(chars) else np.zeros(0, bool)
    # Words, each between two marks: two marks side by side part words, and no n-gram holds both.
    edge = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, np.int64)
    size = end - begin + 2
    first = np.cumsum(size) - size
    line = np.full(size.sum(), _MARK, dtype=np.int64)
    inside = np.ones(len(line), dtype=bool)
    inside[first] = inside[first + size - 1] = False
    line[inside] = chars[letter]
    word = np.repeat(np.arange(len(size)), size)
    one = line[inside] << (2 * _BITS)
    two = ((line[:-1] << (2 * _BITS)) | (line[1:] << _BITS))[word[:-1] == word[1:]]
    three = ((line[:-2] << (2 * _BITS)) | (line[1:-1] << _BITS) | line[2:])[word[:-2] == word[2:]]
    return np.concatenate([one, two, three])


_NO_LETTER = re.compile(r"[\W\d_]")


def _pieces(texts: Iterable[str]) -> Iterator[str]:
    """The texts, short ones together and long ones in parts: words stay whole, so the n-grams are the same."""
    held, size = [], 0
    for text in texts:
        at = 0
        while len(text) - at > _PIECE:
            stop = _NO_LETTER.search(text, at + _PIECE)
            end = stop.end() if stop else len(text)
            yield text[at:end]
            at = end
        if size + len(text) - at > _PIECE:
            yield " ".join(held)
            held, size = [], 0
        held.append(text[at:])
        size += len(text) - at
    yield " ".join(held)


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's distinct n-grams, in their order, and how often each occurs."""
    own, n = zip(*(np.unique(_codes(x), return_counts=True) for x in _pieces([text])))
    every, at = np.unique(np.concatenate(own), return_inverse=True)
    total = np.zeros(len(every), dtype=np.int64)
    np.add.at(total, at.ravel(), np.concatenate(n))
    return every, total


def _gram(code: int) -> str:
    low = (1 << int(_BITS)) - 1
    return "".join(chr(c) for c in (code >> 42, (code >> 21) & low, code & low) if c)


def _counter(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(held: dict) -> pa.RecordBatch:
        flat = [(lang, _gram(c), n) for (lang, c), n in held.items()]
        columns = zip(*flat) if flat else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["lang", "gram", "n"])

    held: dict = {}
    for batch in rows:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        for lang in set(langs.tolist()):
            texts = (batch.column(1)[k].as_py() or "" for k in np.flatnonzero(langs == lang).tolist())
            for piece in _pieces(texts):
                for c, n in zip(*(x.tolist() for x in np.unique(_codes(piece), return_counts=True))):
                    held[lang, c] = held.get((lang, c), 0) + n
                if len(held) > _HELD:
                    yield emit(held)
                    held = {}
        batches.give_back()
    yield emit(held)


def gram_counts(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, gram, n over all rows with a language; texts in lower case, null texts empty."""
    batches.short_batches(rows.sparkSession)
    labelled = rows.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"))
    return labelled.mapInArrow(_counter, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """lang, gram, rank (from 1): each language's most frequent n-grams, equal ones in code-point order.

    Every task keeps only its first ``size`` of a language before they meet."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return gram_counts(rows, text_col, lang_col).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size).select("lang", "gram", "rank")


class Profiles:
    """Learnt profiles, on the driver: ``size`` n-grams of each language."""

    def __init__(self, ranks: DataFrame, size: int = PROFILE):
        found = ranks.toPandas()
        self.size = size
        self.langs = sorted(found["lang"].unique())
        codes = [int(np.dot([ord(c) for c in (g + "\0\0")[:3]], [1 << 42, 1 << 21, 1])) for g in found["gram"]]
        self.grams, at = np.unique(np.array(codes, dtype=np.int64), return_inverse=True)
        self.ranks = np.zeros((len(self.grams) + 1, len(self.langs)), dtype=np.int64)  # 0: not in the profile; last row: no n-gram of any
        self.ranks[at.ravel(), [self.langs.index(x) for x in found["lang"]]] = found["rank"]

    def detect(self, text: str | None) -> str:
        """The nearest language; NA for texts (in lower case) of under 20 characters, stripped, or without letters."""
        text = (text or "").strip()
        if len(text) < LEAST or not self.langs:
            return vocab.NA
        own, n = _counts(text)
        if not len(own):
            return vocab.NA
        own = own[np.lexsort((own, -n))][: self.size]
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.ranks[np.where(self.grams[at] == own, at, len(self.grams))]
        apart = np.where(known > 0, np.abs(known - np.arange(1, len(own) + 1)[:, None]), self.size).sum(axis=0)
        return self.langs[int(np.argmin(apart))]


def detect(text: Column, profiles: Profiles, spark) -> Column:
    batches.short_batches(spark)
    shared = spark.sparkContext.broadcast(profiles)  # ``size`` n-grams a language

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        found = texts.map(shared.value.detect)
        batches.give_back()
        return found

    return run(F.lower(rx.strip(F.coalesce(text.cast("string"), F.lit("")))))

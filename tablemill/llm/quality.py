"""Quality classifier: a generalised additive model with pairwise interactions.

Texts become a fixed row of features (shares of character classes, word and line statistics,
repetition).  Training cuts every feature into quantile bins and boosts cyclically: feature after
feature, a shallow tree over the bins is fitted to the current residual and added to the feature's
lookup table; then the pairs with the strongest interaction get two-way tables in the same way.
A score is the sum of table entries, looked up for all documents of a run at once.

The model is fitted on the driver from the features of at most ``SAMPLE`` labelled rows a class;
texts stay on the executors.  Its size depends on features and bins only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm import textbuf
from tablemill.llm.labelled import bounded_sample, crc_mod
from tablemill.llm.scratch import short_batches

SAMPLE = 6_000
BINS = 32
PAIR_BINS = 8
PAIRS = 10
ROUNDS = 300
PAIR_ROUNDS = 100
RATE = 0.05
PRIOR = 20.0
THRESHOLD = 0.7

FEATURES = [
    "log_bytes", "log_words", "word_length", "word_length_sd", "upper", "digit", "punctuation", "symbol", "beyond_ascii", "space",
    "lines_log", "words_a_line", "line_sd", "distinct_words", "distinct_lines", "distinct_pairs", "top_word", "brief_words", "symbol_ends",
    "capital_words", "pipes", "adjacent_repeats", "sentence_ends", "short_words", "long_words", "distinct_triples", "commas",
]

_CLASS = np.full(256, 3, dtype=np.uint8)  # 0 lower, 1 upper, 2 digit, 3 punctuation, 4 symbol, 5 beyond, 6 space
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 5
_CLASS[[32, 9, 10, 11, 12, 13]] = 6
for _c in b"#$%&*+<=>@\\^_`{|}~/[]":
    _CLASS[_c] = 4
_NOT_NEWLINE = np.ones(256, dtype=bool)
_NOT_NEWLINE[10] = False


def _distinct(values: np.ndarray, owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, occurrences of the commonest) for each document."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    begin = np.flatnonzero(new)
    most = np.zeros(docs, dtype=np.int64)
    np.maximum.at(most, o[begin], np.diff(np.append(begin, len(v))))
    return np.bincount(o[begin], minlength=docs), most


def features(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """documents x FEATURES of UTF-8 texts raw[at[d]:at[d+1]]; an empty text has zeros throughout."""
    docs = len(at) - 1
    size = np.diff(at)
    of_byte = np.repeat(np.arange(docs), size)
    kind = _CLASS[raw]
    share = np.zeros((docs, 7))
    for k in range(7):
        share[:, k] = np.bincount(of_byte[kind == k], minlength=docs)
    count = lambda hit, of: np.bincount(of[hit], minlength=docs).astype(float)
    start, end, first = textbuf.words(raw, at, textbuf.SPACE_WORDS)
    words = np.diff(first)
    of_word = np.repeat(np.arange(docs), words)
    length = (end - start).astype(float)
    low = textbuf.LOWER[raw]
    hashes = textbuf.word_hashes(low, start, end)
    some_words, some_bytes = np.maximum(words, 1), np.maximum(size, 1)
    mean = np.bincount(of_word, weights=length, minlength=docs) / some_words
    square = np.bincount(of_word, weights=length**2, minlength=docs) / some_words
    begin, stop, line_first = textbuf.words(raw, at, _NOT_NEWLINE)
    lines = np.diff(line_first)
    of_line = np.repeat(np.arange(docs), lines)
    line_words = (np.searchsorted(start, stop) - np.searchsorted(start, begin)).astype(float)
    some_lines = np.maximum(lines, 1)
    line_mean = np.bincount(of_line, weights=line_words, minlength=docs) / some_lines
    line_square = np.bincount(of_line, weights=line_words**2, minlength=docs) / some_lines
    distinct, most = _distinct(hashes, of_word, docs)
    distinct_lines, _ = _distinct(textbuf.word_hashes(low, begin, stop), of_line, docs)
    same = of_word[1:] == of_word[:-1]
    pair = textbuf.window_hashes(hashes, 2)[same] if len(hashes) > 1 else hashes[:0]
    distinct_pairs, _ = _distinct(pair, of_word[1:][same], docs)
    same3 = of_word[2:] == of_word[:-2]
    triple = textbuf.window_hashes(hashes, 3)[same3] if len(hashes) > 2 else hashes[:0]
    distinct_triples, _ = _distinct(triple, of_word[2:][same3], docs)
    last = kind[end - 1] if len(end) else kind[:0]
    head = kind[start] if len(start) else kind[:0]
    tail = raw[end - 1] if len(end) else raw[:0]
    repeated = np.zeros(len(hashes), dtype=bool)
    repeated[1:] = (hashes[1:] == hashes[:-1]) & same
    per_word = lambda hit: count(hit, of_word) / some_words
    columns = [
        np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(square - mean**2, 0)),
        *(share[:, k] / some_bytes for k in (1, 2, 3, 4, 5, 6)),
        np.log1p(lines), line_mean, np.sqrt(np.maximum(line_square - line_mean**2, 0)),
        distinct / some_words, distinct_lines / some_lines, distinct_pairs / np.maximum(words - 1, 1), most / some_words,
        per_word(length <= 3), per_word(last == 4), per_word(head == 1), count(raw == 124, of_byte) / some_bytes, per_word(repeated),
        per_word(tail == 46), per_word(length == 1), per_word(length >= 12), distinct_triples / np.maximum(words - 2, 1), per_word(tail == 44),
    ]
    out = np.stack(columns, axis=1)
    out[size == 0] = 0
    return out


def _boost(code: np.ndarray, cells: int, y: np.ndarray, margin: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """One shallow tree over the ordered cells of a lookup table: leaf values by Newton steps."""
    p = 1 / (1 + np.exp(-margin))
    g = np.bincount(code, weights=weight * (y - p), minlength=cells)
    h = np.bincount(code, weights=weight * p * (1 - p), minlength=cells)
    out = np.zeros(cells)
    parts = [(0, cells)]
    for _ in range(leaves - 1):
        best = None
        for lo, hi in parts:
            if hi - lo < 2:
                continue
            gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            gt, ht = g[lo:hi].sum(), h[lo:hi].sum()
            gain = gl**2 / (hl + PRIOR) + (gt - gl) ** 2 / (ht - hl + PRIOR) - gt**2 / (ht + PRIOR)
            k = int(gain.argmax())
            if best is None or gain[k] > best[0]:
                best = (gain[k], lo, hi, lo + k + 1)
        if best is None or best[0] <= 0:
            break
        _, lo, hi, cut = best
        parts.remove((lo, hi))
        parts += [(lo, cut), (cut, hi)]
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + PRIOR)
    return out


def _interaction(a: np.ndarray, b: np.ndarray, y: np.ndarray, margin: np.ndarray) -> float:
    """How much a two-way table would explain of the residual."""
    p = 1 / (1 + np.exp(-margin))
    code = a * PAIR_BINS + b
    g = np.bincount(code, weights=y - p, minlength=PAIR_BINS**2)
    h = np.bincount(code, weights=p * (1 - p), minlength=PAIR_BINS**2)
    return float((g**2 / (h + PRIOR)).sum())


class Model:
    """Bin edges, one table for each feature, and two-way tables."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        y = y.astype(float)
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
        self.coarse = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for k in range(x.shape[1])]
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        bins, coarse = self._codes(x, self.edges), self._codes(x, self.coarse)
        margin = np.full(len(y), self.base)
        flat = np.ones(len(y))
        for _ in range(ROUNDS):
            for k, table in enumerate(self.tables):
                step = RATE * _boost(bins[:, k], len(table), y, margin, flat, leaves=3)
                table += step
                margin += step[bins[:, k]]
        count = x.shape[1]
        strength = {(a, b): _interaction(coarse[:, a], coarse[:, b], y, margin) for a in range(count) for b in range(a)}
        chosen = sorted(strength, key=lambda p: (-strength[p], p))[:PAIRS]
        tables = {p: np.zeros((PAIR_BINS, PAIR_BINS)) for p in chosen}
        for _ in range(PAIR_ROUNDS):
            for (a, b), table in tables.items():
                for one, two, turned in ((a, b, table), (b, a, table.T)):
                    # A tree of depth two: one cut of the first feature, then cuts of the second on either side.
                    first = _boost(coarse[:, one], PAIR_BINS, y, margin, flat, leaves=2)
                    side = first > first.mean()
                    for s in (False, True):
                        rows = side[coarse[:, one]] == s
                        if rows.any():
                            step = RATE * _boost(coarse[rows, two], PAIR_BINS, y[rows], margin[rows], flat[rows], leaves=2)
                            turned[side == s] += step
                            margin[rows] += step[coarse[rows, two]]
        self.pairs = [(a, b, t) for (a, b), t in tables.items()]

    @staticmethod
    def _codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins, coarse = self._codes(x, self.edges), self._codes(x, self.coarse)
        margin = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            margin += table[bins[:, k]]
        for a, b, table in self.pairs:
            margin += table[coarse[:, a], coarse[:, b]]
        return 1 / (1 + np.exp(-margin))


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in textbuf.runs(batch, "text"):
            x = features(*textbuf.utf8(run.column(1)))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([run.column(0), rows], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_label: int = SAMPLE) -> Model | None:
    """A model of label 1 against others; None if no labelled document was found.

    At most 2 * ``per_label`` rows of each label are used.  Rows of ``labels`` without id or label
    are ignored.  The sampled ids are broadcast (their number is that bound), the documents are
    scanned once.
    """
    short_batches(docs.sparkSession)
    known = labels.select(F.col(id_col), (F.col(label_col) == 1).cast("int").alias("label")).filter(F.col(id_col).isNotNull() & F.col("label").isNotNull())
    sample = bounded_sample(known, "label", F.xxhash64(id_col), per_label, 2)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample.select(F.col(id_col).alias("id"), "label")), "id")
    # One text for each sampled label, however often its id is repeated.
    texts = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = texts.select("label", "text").mapInArrow(_featurize, "label int, x array<double>").toPandas()
    if not len(rows):
        return None
    x = np.stack(rows["x"].to_numpy())
    order = np.lexsort((*x.T, rows["label"].to_numpy()))  # the same model however rows arrive
    return Model(x[order], rows["label"].to_numpy()[order])


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in textbuf.runs(batch, "text"):
                s = shared.value.score(features(*textbuf.utf8(run.column(1))))
                yield pa.RecordBatch.from_arrays([run.column(0), pa.array(s)], ["id", "score"])

    return score


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1).  Null and empty texts get the score of an
    empty text; without a model every score is 0.5.  Other columns are ignored."""
    if model is None:
        return docs.select(id_col, F.lit(0.5).alias("score"))
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model)), f"id {kind}, score double").withColumnRenamed("id", id_col)


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    scored = score_documents(docs, fit(docs, labels.filter(~out)))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

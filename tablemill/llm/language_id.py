"""Language identification by cross-parsing entropy.

Each language's labelled text makes a suffix automaton.  A text is cut into the longest phrases
that occur in a language's text; a language that explains the text needs few phrases.  Phrases
times log2(reference length) is the text's code length in that language; the smallest, per symbol,
wins.  All documents of a run are parsed together: their symbols are laid out in segments of
``SEGMENT`` symbols, every automaton advances one symbol of every segment at a step, so a very long
document is no longer than others, and all of it counts.

The model is fitted on the driver from a bounded sample (``PER_LANGUAGE`` documents and
``REFERENCE`` characters a language; with very many languages ``ROWS`` documents and
``TOTAL_REFERENCE`` characters over all of them) and broadcast.  Every language and every letter of
the sample is learnt.  Transitions are kept sparsely, about 30 bytes for each character of the
sample, so the model's size is bounded by these parameters, whatever the corpus or its script.
"""

from __future__ import annotations

import functools
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.llm import textbuf
from tablemill.llm.labelled import bounded_sample, crc_mod
from tablemill.llm.scratch import short_batches

PER_LANGUAGE = 150
REFERENCE = 30_000
#: Documents (at most twice that) and characters of the sample over all languages, and characters of one document in it.
ROWS = 12_000
TOTAL_REFERENCE = 2_400_000
SLICE = 4_000
#: Labels that are counted: more than there are living languages.
LABELS = 8_192
SEGMENT = 1_024
RUN_BYTES = 1 << 20
#: Characters of a long text that are held in wide form at once.
PIECE = 1 << 20
#: A text is of no learnt language if its phrases exceed FREE_PHRASES and MARGIN times the highest rate of learnt text.
MARGIN = 1.2
FREE_PHRASES = 2
LEAST_LEFT = 20
UNKNOWN = "und"
_OTHER, _GAP = 0, 1
_TRIES = 12


@functools.cache
def _letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def _automaton(text: list[int]) -> list[dict[int, int]]:
    """The transitions of each state of the suffix automaton of ``text``; state 0 is the root."""
    step, link, length = [{}], [-1], [0]
    last = 0
    for c in text:
        here = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = here
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[here] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[here] = twin
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
        last = here
    return step


def _packed(step: list[dict[int, int]], symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, owner, target): the transition of state s by symbol c is at k = base[s] + c, if owner[k] is s.

    Rows of the sparse table are laid over each other where they leave room: widest rows first, each
    at one of the first free places that fit, or behind all others.
    """
    room = symbols + sum(map(len, step))
    used = bytearray(2 * room + symbols)
    base = [0] * len(step)
    low = end = symbols  # so that no base lies before the table
    for state in sorted(range(len(step)), key=lambda s: -len(step[s])):
        row = step[state]
        if not row:
            continue
        first = min(row)
        shift = [c - first for c in row if c != first]
        low = at = used.find(0, low)
        for _ in range(_TRIES):
            if at >= end or not any(used[at + c] for c in shift):
                break
            at = used.find(0, at + 1)
        else:
            at = end
        most = at + max(shift, default=0) + 1
        if most + symbols > len(used):
            used += bytearray(most + room)
        used[at] = 1
        for c in shift:
            used[at + c] = 1
        end = max(end, most)
        base[state] = at - first
    owner, target = np.full(end, -1, np.int64), np.zeros(end, np.int64)
    from_, chars, to = (np.array([x[k] for x in ((s, c, t) for s, row in enumerate(step) for c, t in row.items())], np.int64) for k in range(3))
    place = np.array(base, np.int64)[from_] + chars
    owner[place], target[place] = from_, to
    return np.array(base, np.int64), owner, target


class Model:
    """The languages' automata in one sparse transition table."""

    def __init__(self, texts: dict[str, str]):
        #: The highest rate of phrases a symbol seen on learnt text; ``fit`` measures it.
        self.rate = np.inf
        self.languages = sorted(texts)
        self.alphabet = sorted({c for t in texts.values() for c in t.lower() if c.isalpha()})
        self.symbols = len(self.alphabet) + 2
        base, owner, target, weight = [], [], [], []
        self.root, self.dead, states, slots = [], [], 0, 0
        coder = Coder(self.alphabet)
        for name in self.languages:
            coded = coder.encode([texts[name].lower()])[0].tolist()
            step = _automaton(coded)
            b, o, t = _packed(step, self.symbols)
            base += [b + slots, np.zeros(1, np.int64)]  # from the dead state nothing leads on
            owner.append(np.where(o >= 0, o + states, -1))
            target.append(t + states)
            self.root.append(states)
            self.dead.append(states + len(step))
            weight.append(np.log2(max(2, len(coded))))
            states += len(step) + 1
            slots += len(o)
        self.base = np.concatenate(base).astype(np.int32)
        pad = np.full(self.symbols, -1)  # a row at the end may reach beyond it
        self.owner = np.concatenate([*owner, pad]).astype(np.int32)
        self.target = np.concatenate([*target, pad]).astype(np.int32)
        self.root = np.array(self.root, dtype=np.int32)
        self.dead = np.array(self.dead, dtype=np.int32)
        self.weight = np.array(weight)

    def phrases(self, coded: np.ndarray, first: np.ndarray) -> np.ndarray:
        """documents x languages phrase counts of symbol runs coded[first[d]:first[d+1]].

        A symbol that no text of the language holds is a phrase of its own.
        """
        size = np.diff(first)
        parts = -(-size // SEGMENT)
        owner = np.repeat(np.arange(len(size)), parts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = first[:-1][owner] + number * SEGMENT
        length = np.minimum(SEGMENT, first[1:][owner] - begin)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        active = np.searchsorted(-length, -np.arange(SEGMENT), side="left")
        languages = len(self.languages)
        out = np.zeros((len(size), languages))
        for k in range(languages):
            dead = self.dead[k]
            to_root = self.base[self.root[k]]
            state = np.full(len(owner), dead, dtype=np.int32)
            count = np.zeros(len(owner), dtype=np.int32)
            for t in range(SEGMENT):
                n = active[t]
                if not n:
                    break
                symbol = coded[begin[:n] + t]
                now = state[:n]
                at = self.base[now] + symbol
                to = self.target[at]
                miss = np.flatnonzero(self.owner[at] != now)
                if len(miss):
                    # The phrase ends before this symbol; the next begins with it, or is the symbol itself.
                    again = to_root + symbol[miss]
                    to[miss] = np.where(self.owner[again] == self.root[k], self.target[again], dead)
                    count[miss] += 1
                state[:n] = to
            out[:, k] = np.bincount(owner, weights=count, minlength=len(size))
        return out

    def rates(self, texts: list[str]) -> np.ndarray:
        """Phrases a symbol, beyond the free ones, in the language that explains each text best; texts without letters have none."""
        coded, first, letters = Coder(self.alphabet).encode([t.lower() for t in texts])
        count, size = self.phrases(coded, first).min(axis=1), np.diff(first)
        return ((count - FREE_PHRASES) / np.maximum(size, 1))[letters > 0]

    def explains(self, count: np.ndarray, coded: np.ndarray, first: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Is each text (with these phrase counts) as well explained by some language as learnt text is?
        Short texts are, unless most of their letters occur in no language."""
        alike = count.min(axis=1) <= FREE_PHRASES + MARGIN * self.rate * np.diff(first)
        foreign = np.concatenate([[0], np.cumsum(coded == _OTHER)])
        return (letters > 0) & alike & (2 * np.diff(foreign[first]) <= letters)

    def predict(self, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language number, its posterior under the code lengths) of phrase counts."""
        bits = count * self.weight
        gap = np.minimum(bits - bits.min(axis=1, keepdims=True), 200.0)
        return bits.argmin(axis=1), 1.0 / np.exp2(-gap).sum(axis=1)


class Coder:
    """Lower-case texts as symbols: letters of the alphabet, other letters, and one gap between words."""

    def __init__(self, alphabet: list[str]):
        kind = np.uint8 if len(alphabet) < 250 else np.uint16 if len(alphabet) < 65_000 else np.int32
        self.symbol = np.where(_letters(), _OTHER, _GAP).astype(kind)
        for k, c in enumerate(alphabet):
            self.symbol[ord(c)] = k + 2

    def _one(self, text: str) -> np.ndarray:
        parts = [self.symbol[np.frombuffer(text[k : k + PIECE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)] for k in range(0, len(text), PIECE)]
        return parts[0] if len(parts) == 1 else np.concatenate([self.symbol[:0], *parts])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, first symbol of each text, letters in each text)"""
        raw = [self._one(t) for t in texts]
        first = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        coded = np.concatenate([self.symbol[:0], *raw])
        gap = coded == _GAP
        letters = first[1:] - first[:-1] - _between(gap, first)
        keep = np.ones(len(coded), dtype=bool)
        keep[1:] = ~(gap[1:] & gap[:-1])
        starts = first[:-1][first[:-1] < len(coded)]
        keep[starts] = True  # a text's first gap is its own
        size = _between(keep, first)
        return coded[keep], np.concatenate([[0], np.cumsum(size)]), letters


def _between(hit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many hits lie in each stretch hit[first[d]:first[d+1]]."""
    place = np.flatnonzero(hit)
    return np.diff(np.searchsorted(place, first))


def fit(labelled: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """A model from a bounded sample of ``labelled``; None if no row has both text and language.

    Of a document at most ``SLICE`` characters, from a place that its hash chooses, are brought to
    the driver: the sample is bounded in characters as well as in rows.
    """
    text = F.col(text_col).cast("string")
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), text.alias("text"))
    sample = bounded_sample(rows, "lang", F.xxhash64("id", "text"), PER_LANGUAGE, LABELS, ROWS).filter("length(text) > 0")
    spare = F.greatest(F.char_length("text") - SLICE, F.lit(0))
    cut = F.substring(F.col("text"), F.pmod(F.crc32(F.col("text").cast("binary")), spare + 1).cast("int") + 1, F.lit(SLICE))
    texts: dict[str, list[tuple]] = {}
    for i, lang, part in sample.select("id", "lang", cut).collect():
        texts.setdefault(lang, []).append((hash_order(i, part), part))
    if not texts:
        return None
    size = min(REFERENCE, max(1, TOTAL_REFERENCE // len(texts)))
    used, left = {}, {}
    for lang, found in texts.items():
        room, parts, rest = size, [], []
        for _, part in sorted(found):
            if len(part) <= room:
                parts.append(part)
                room -= len(part) + 1
            else:
                rest.append(part)
        used[lang], left[lang] = parts or [min((t for _, t in found), key=lambda t: (len(t), t))[:size]], rest
    model = Model({lang: "\n".join(parts) for lang, parts in used.items()})
    model.rate = _learnt_rate(model, used, left)
    return model


def _learnt_rate(model: Model, used: dict[str, list[str]], left: dict[str, list[str]]) -> float:
    """The highest rate on labelled texts that the automata do not hold; where too few were left over,
    on each half of the texts by automata of the other half.  The highest of all languages: text with
    more noise than a language's sample happens to hold stays."""
    rates = [model.rates([t for texts in left.values() for t in texts])]
    few = {lang: parts for lang, parts in used.items() if len(left[lang]) < LEAST_LEFT and len(parts) > 1}
    for k in (0, 1) if few else ():
        half = Model({lang: "\n".join(parts[k::2] if lang in few else parts) for lang, parts in used.items()})
        rates.append(half.rates([t for parts in few.values() for t in parts[1 - k :: 2]]))
    found = np.concatenate(rates)
    # Learnt text that repeats itself tells nothing of other text: no less than an entropy of 2.5 bits a symbol.
    return max(float(found.max()), 2.5 / float(model.weight.max())) if len(found) else np.inf


def hash_order(key, text: str) -> int:
    return zlib.crc32(f"{key}\0{text}".encode("utf-8", "surrogatepass"))


def _counted(model: Model, coder: Coder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(phrase counts, symbols, first symbol of each text, letters) of a column of texts."""
    coded, first, letters = coder.encode([(t or "").lower() for t in texts.to_pylist()])
    return model.phrases(coded, first), coded, first, letters


def _predictor(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        coder = Coder(model.alphabet)
        for batch in batches:
            for run in textbuf.runs(batch, "text", RUN_BYTES):
                count, _, _, letters = _counted(model, coder, run.column(1))
                best, score = model.predict(count)
                some = letters > 0
                names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), some.tolist())]
                yield pa.RecordBatch.from_arrays([run.column(0), pa.array(names, pa.string()), pa.array(np.where(some, score, 0.0))], ["id", "lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score (0 to 1: the winner's share of 2**-bits).

    Null texts and texts without a letter are ``und`` with score 0; so is every text if there was
    nothing to learn from.  Of equal languages the first by name wins.  Rows that repeat an id are
    rows of their own; an empty table has no rows; very long texts are read in pieces and count
    whole.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return rows.select(F.col("id").alias(id_col), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(_predictor(docs.sparkSession.sparkContext.broadcast(model)), f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(crc_mod(id_col, 3) == 1, F.lit(False))


def fit_documents(docs: DataFrame) -> Model | None:
    return fit(docs.filter(~held_out()))


def learnt_language(text: Column, model: Model, spark) -> Column:
    """The language of ``text``; null where it has no letter, or no learnt language explains it as it does learnt text.

    What counts is the cross-parsing rate itself and not the score, which only compares languages:
    foreign text and gibberish may score 1, and a clean word that several languages hold scores low.
    Only the texts go to Python, and only names come back.
    """
    shared = spark.sparkContext.broadcast(model)

    def named(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held: Model = shared.value
        coder = Coder(held.alphabet)
        for column in columns:
            batch, parts = pa.RecordBatch.from_arrays([column], ["text"]), []
            for run in textbuf.runs(batch, "text", RUN_BYTES):
                count, coded, first, letters = _counted(held, coder, run.column(0))
                known = held.explains(count, coded, first, letters)
                best, _ = held.predict(count)
                parts += [held.languages[b] if ok else None for b, ok in zip(best.tolist(), known.tolist())]
            yield pa.array(parts, pa.string())

    named.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(named, "string").asNondeterministic()(text)


def keep_identified(docs: DataFrame, model: Model | None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without those that have no letter (null and empty texts too), or that no learnt language
    explains as it does learnt text; where a row has no language and ``docs`` has the column ``lang_col``,
    the one found is written there.

    Without a model (nothing to learn from) every row stays.  Columns keep their names, types and
    order, whatever they are called; rows that repeat an id are judged one by one; very long texts
    are judged whole.
    """
    if model is None:
        return docs
    spark = docs.sparkSession
    short_batches(spark)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row).select("row", learnt_language(F.col("row")[text_col].cast("string"), model, spark).alias("found")).filter("found is not null")
    cell = lambda c: F.col("row")[c]
    kind = {f.name: f.dataType for f in docs.schema}
    told = lambda c: F.coalesce(cell(c), F.col("found").cast(kind[c])) if c == lang_col else cell(c)
    return rows.select(*(told(c).alias(c) for c in docs.columns))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, fit_documents(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

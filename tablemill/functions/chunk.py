"""Chunks for embedding, and a pluggable embedder."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.functions import batches

LEAST, TARGET, MOST = 200, 2000, 3200
DIMENSIONS = 512


_STOPS = (". ", ".\n", "! ", "? ")
_INK = re.compile(r"\S")


def _cut(text: str, at: int) -> int:
    """Where the chunk that begins ``at`` ends: at a paragraph, else behind a sentence, else at the target."""
    lo, hi = at + LEAST, at + TARGET
    end = text.rfind("\n\n", lo, hi)
    if end >= 0:
        return end
    for stop in _STOPS:
        end = text.rfind(stop, lo, hi)
        if end >= 0:
            return end + len(stop)
    return hi


def chunks_of(text: str | None) -> Iterator[str]:
    """Chunks of at least 200 characters, one at a time; a text of up to 3200 is one.

    The text is walked by offsets: what is left is never copied, so the work is in proportion to the length.
    """
    text = (text or "").strip()
    at = 0
    while len(text) - at > MOST:
        end = _cut(text, at)
        chunk = text[at:end].strip()
        if len(chunk) >= LEAST:
            yield chunk
        ink = _INK.search(text, end)
        at = ink.start() if ink else len(text)
    if len(text) - at >= LEAST:
        yield text[at:]


@F.udtf(returnType="chunk_index int, chunk_text string")
class ChunkText:
    """Table function: the chunks of a text in rows, as they are cut."""

    def eval(self, text: str):
        yield from enumerate(chunks_of(text))


def explode_chunks(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, chunk_index (among the kept chunks), chunk_text."""
    rows = df.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return rows.lateralJoin(ChunkText(F.col("_text").outer())).select(id_col, "chunk_index", "chunk_text")


def hashed_vector(text: str, dimensions: int = DIMENSIONS) -> list[float]:
    """A deterministic stand-in for an embedding model: hashed word counts of unit length."""
    v = np.zeros(dimensions)
    for w in re.findall(r"\w+", text.lower()):
        v[zlib.crc32(w.encode()) % dimensions] += 1
    norm = np.linalg.norm(v)
    return (v / norm if norm else v).tolist()


def embed(text: Column, model: Callable[[list[str]], list[list[float]]] | None = None) -> Column:
    """An array<float> per text; ``model`` takes a batch of texts, of 1,000 at most."""
    batches.short_batches(SparkSession.active())

    def run(texts: pd.Series) -> pd.Series:
        batch = [t or "" for t in texts]
        # Own vectors as arrays: a list holds each number as an object of its own.
        found = pd.Series(model(batch)) if model else pd.Series([np.array(hashed_vector(t), dtype=np.float32) for t in batch], dtype=object)
        batches.give_back()
        return found

    return F.pandas_udf(run, "array<float>")(text)

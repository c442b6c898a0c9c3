"""Text functions under SQL names."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tablemill.functions import batches, chunk, normalize, rx, vocab


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def normalize_sql(text: str) -> str:
    """The chain of ``normalize.normalize_text`` as an SQL expression of an SQL expression."""
    steps = [(rx.java(rf"<{name}[^>]*>.*?</{name}>", "is"), "") for name in ("script", "style")]
    steps += [(rx.java(normalize.BLOCKS), "\n"), (rx.java(r"<[^>]+>", ""), "")]
    steps += [(rx.java(pattern, flags), to) for pattern, to, flags in normalize.MARKDOWN]
    squeeze = [(r"[ \t]+", " "), (r"\n{3,}", "\n\n"), (r" *\n *", "\n")]
    steps += squeeze + [(rx.java(pattern, "is"), "") for pattern in vocab.BOILERPLATE]
    out = f"unescape_entities(coalesce({text}, ''))"
    for pattern, to in steps:
        out = f"regexp_replace({out}, {_literal(pattern)}, {_literal(to)})"
    out = f"lower({out})"
    for pattern, to in [*squeeze, (r"(?U)^\s+|\s+$", "")]:
        out = f"regexp_replace({out}, {_literal(pattern)}, {_literal(to)})"
    return out


def register(spark: SparkSession) -> list[str]:
    """Make ``unescape_entities``, ``normalize_text``, ``chunk_text`` and the table function ``text_chunks`` known to SQL in this session."""

    def chunks(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: list(chunk.chunks_of(t)))

    batches.short_batches(spark)
    spark.udf.register("unescape_entities", F.pandas_udf(normalize.unescape_batch, "string"))
    spark.udf.register("chunk_text", F.pandas_udf(chunks, "array<string>"))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION normalize_text(t STRING) RETURNS STRING RETURN {normalize_sql('t')}")
    spark.udtf.register("text_chunks", chunk.ChunkText)
    return ["unescape_entities", "normalize_text", "chunk_text", "text_chunks"]

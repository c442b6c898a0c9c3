"""Text normalisation: HTML, markdown, white space, boilerplate, case."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tablemill.functions import batches, rx, vocab

#: Fixed value: tags that end a line.
BLOCKS = r"<(br|p|div|h[1-6]|li|tr)[^>]*/?>"
#: Fixed values: (pattern, replacement, flags) in order.
MARKDOWN = [
    (r"^#{1,6}\s*", "", "m"),
    (r"\*{1,2}([^*]+)\*{1,2}", "$1", ""),
    (r"_{1,2}([^_]+)_{1,2}", "$1", ""),
    (r"\[([^\]]+)\]\([^)]+\)", "$1", ""),
    (r"`([^`]+)`", "$1", ""),
    (r"^[\-\*_]{3,}\s*$", "", "m"),
    (r"^\s*[\-\*\+]\s+", "", "m"),
    (r"^\s*\d+\.\s+", "", "m"),
    (r"\\([*_`\[\]()#+-.])", "$1", ""),
]


def unescape_batch(texts: pd.Series) -> pd.Series:
    out = texts.map(html.unescape, na_action="ignore")
    batches.give_back()
    return out


def unescape(text: Column) -> Column:
    """Named and numeric entities; the library function, in short Arrow batches, of texts with an ampersand.
    Other texts stay where they are and travel as nulls."""
    batches.short_batches(SparkSession.active())
    some = F.contains(text, F.lit("&"))
    return F.when(some, F.pandas_udf(unescape_batch, "string")(F.when(some, text))).otherwise(text)


def strip_tags(text: Column) -> Column:
    """Scripts and styles go with their content, block tags become newlines, other tags go."""
    for name in ("script", "style"):
        text = F.regexp_replace(text, rx.java(rf"<{name}[^>]*>.*?</{name}>", "is"), "")
    text = F.regexp_replace(text, rx.java(BLOCKS), "\n")
    return F.regexp_replace(text, rx.java(r"<[^>]+>", ""), "")


def strip_markdown(text: Column) -> Column:
    for pattern, to, flags in MARKDOWN:
        text = F.regexp_replace(text, rx.java(pattern, flags), to)
    return text


def squeeze(text: Column) -> Column:
    """Runs of blanks to one, three and more newlines to two, no blanks around newlines."""
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return F.regexp_replace(text, r" *\n *", "\n")


def strip_boilerplate(text: Column) -> Column:
    for pattern in vocab.BOILERPLATE:
        text = F.regexp_replace(text, rx.java(pattern, "is"), "")
    return text


def normalize_text(text: Column, boilerplate: bool = True, lowercase: bool = True, entities: bool = True) -> Column:
    """The whole chain; null and empty become ''.  ``entities=False`` keeps the plan free of Python
    where texts are known to hold no entity."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    if entities:
        out = unescape(out)
    out = squeeze(strip_markdown(strip_tags(out)))
    if boilerplate:
        out = strip_boilerplate(out)
    if lowercase:
        out = F.lower(out)
    return rx.strip(squeeze(out))

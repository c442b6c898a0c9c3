"""Column helpers for keyword and pattern tests.

Patterns are written for Unicode-aware matching: ``\\b``, ``\\s`` and case folding follow Unicode,
and ``^ $ .`` know only newline as a line end.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def java(pattern: str, flags: str = "i") -> str:
    """``pattern`` with Unicode semantics under Java's engine."""
    return f"(?{flags}dU)" + pattern.replace(r"\Z", r"\z")


def any_of(patterns: Iterable[str]) -> str:
    """One alternation: true where any of the patterns is found.

    Patterns that begin at a word border share one test of it; testing it for each of them at each
    character is what such an alternation would spend its time on.
    """
    distinct = list(dict.fromkeys(patterns))
    border = [p[2:] for p in distinct if p.startswith(r"\b") and "|" not in _outside_groups(p)]
    rest = [p for p in distinct if not (p.startswith(r"\b") and "|" not in _outside_groups(p))]
    parts = [r"\b(?:" + "|".join(f"(?:{p})" for p in border) + ")"] if border else []
    return "|".join(parts + [f"(?:{p})" for p in rest])


def _outside_groups(pattern: str) -> str:
    """What of a pattern stands outside parentheses, classes and escapes."""
    depth, out, k = 0, [], 0
    while k < len(pattern):
        c = pattern[k]
        if c == "\\":
            k += 2
            continue
        if c == "[":
            k = pattern.index("]", k + 2)
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif not depth:
            out.append(c)
        k += 1
    return "".join(out)


def let(value: Column, body) -> Column:
    """``body`` of a name for ``value``, which is computed once however often the body asks for it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def needed_literals(pattern: str) -> list[str]:
    """Plain texts of which every match holds one; empty if there are none of two characters or more."""
    if "|" in _outside_groups(pattern):
        return []
    best, run, k = "", "", 0
    choice: list[str] = []

    def close() -> None:
        nonlocal best, run
        best, run = max(best, run, key=len), ""

    while k < len(pattern):
        c = pattern[k]
        if c == "\\":
            if pattern[k + 1].isalnum():
                close()
            else:
                run += pattern[k + 1]
            k += 2
            continue
        if c in "?*{":
            run = run[:-1]
            close()
            k = pattern.index("}", k) if c == "{" else k
        elif c in "+.^$":
            close()
        elif c == "[":
            close()
            k = pattern.index("]", k + 2)
            if pattern[k + 1 : k + 2] in ("?", "*", "+"):
                k += 1
        elif c == "(":
            close()
            depth, begin = 1, k + 1
            while depth:
                k += 1
                k += pattern[k] == "\\"
                depth += (pattern[k] == "(") - (pattern[k] == ")")
            options = pattern[begin:k].split("|")
            if pattern[k + 1 : k + 2] in ("?", "*", "+"):
                k += 1
            elif all(o.isalnum() for o in options) and min(map(len, options)) > min(map(len, choice), default=1):
                choice = options
        else:
            run += c
        k += 1
    close()
    if choice and min(map(len, choice)) > len(best):
        return [o.lower() for o in choice]
    return [best.lower()] if len(best) > 1 else []


#: Letters beyond ASCII that fold to ASCII ones (i, i, s, k): texts with them are not settled by the byte search.
FOLDING = ["\u0130", "\u0131", "\u017f", "\u212a"]


def bind(text: Column, body) -> Column:
    """``body`` of a row with text, low (lower case) and odd (holds a letter that folds to ASCII)."""
    odd = F.contains(text, F.lit(FOLDING[0]))
    for letter in FOLDING[1:]:
        odd |= F.contains(text, F.lit(letter))
    return let(F.struct(text.alias("text"), F.lower(text).alias("low"), odd.alias("odd")), body)


def found(row: Column, patterns: Iterable[str]) -> Column:
    """Any pattern is found in a row of ``bind``, whatever the case.

    A pattern is tried only where the text holds the plain part of one, which a byte search settles;
    the few patterns without such a part are always tried.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in dict.fromkeys(patterns):
        groups.setdefault(tuple(needed_literals(p)), []).append(p)
    out = None
    for keys, own in groups.items():
        tried = row["text"].rlike(java(any_of(own)))
        for_keys = row["odd"]
        for k in keys:
            for_keys |= F.contains(row["low"], F.lit(k))
        tried = for_keys & tried if keys else tried
        out = tried if out is None else out | tried
    return F.coalesce(out, F.lit(False))


def matches(text: Column, patterns: Iterable[str]) -> Column:
    """Any pattern is found, whatever the case."""
    return bind(text, lambda row: found(row, patterns))


def literals(keywords: Iterable[str]) -> str:
    return "|".join(re.escape(k) for k in dict.fromkeys(keywords))


def contains_any(text: Column, keywords: Iterable[str]) -> Column:
    """Any keyword is a substring of ``text``, letter by letter."""
    distinct = list(dict.fromkeys(keywords))
    short = [k for k in distinct if not any(o != k and o in k for o in distinct)]
    return F.coalesce(let(text, lambda t: F.exists(F.lit(short), lambda k: F.contains(t, k))), F.lit(False))


def count_contained(text: Column, keywords: Iterable[str]) -> Column:
    """How many of the keywords are substrings of ``text`` (a name bound by ``let``)."""
    return F.size(F.filter(F.lit(list(keywords)), lambda k: F.contains(text, k)))


def found_keywords(text: Column, keywords: Iterable[str]) -> Column:
    """The keywords that are substrings of ``lower(text)``, in their order and spelling."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return let(low, lambda t: F.filter(F.lit(list(keywords)), lambda k: F.contains(t, F.lower(k))))


def blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind (trim() takes spaces only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")

"""Many phrases in one pass over a text.

A pattern for each phrase reads the text once for each.  Here all phrases share one trie, written as one
pattern: at every word border it follows the letters that are there and keeps the longest phrase that fits,
so the cost follows the text and not the number of phrases.  Shorter phrases that begin at the same place are
beginnings of the longest, so a table made beforehand names them all.  The plan holds one pattern and one
table, whatever their size.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablemill.functions import rx


def fold(text: Column) -> Column:
    """Lower case, with the letters beyond ASCII that match ASCII ones when case does not count."""
    return F.lower(F.translate(text, "".join(rx.FOLDING), "iisk"))


def _is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def border(text: str, at: int) -> bool:
    """A word border inside ``text``."""
    return _is_word(text[at - 1]) != _is_word(text[at])


def overlaps_itself(phrase: str) -> bool:
    """Occurrences of the phrase can overlap, so counting them one after the other may differ from counting all."""
    return any(phrase[k:] == phrase[:-k] and border(phrase, k) for k in range(1, len(phrase)))


class PhraseTable:
    """Phrases between word borders.  Their letters are ASCII, in lower case; single spaces part words and stand for any white space
    unless ``exact``."""

    def __init__(self, phrases: Iterable[str], exact: bool = False):
        self.phrases = sorted(set(phrases))
        if bad := [p for p in self.phrases if not p or not p.isascii() or p != p.lower() or p != " ".join(p.split())]:
            raise ValueError(f"not phrases: {bad[:3]}")
        self.space = " " if exact else r"\s+"
        trie: dict = {}
        for p in self.phrases:
            node = trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = {}
        # A phrase may end where a longer one goes on: longer ones are tried first.
        self.pattern = rf"(?dU)\b(?=({self._write(trie)}))" if trie else ""

    def _write(self, node: dict) -> str:
        options = []
        for c in sorted(k for k in node if k):
            text, below = self._letter(c), node[c]
            while len(below) == 1 and "" not in below:  # a stretch without a fork
                ((k, below),) = below.items()
                text += self._letter(k)
            options.append(text + self._write(below))
        if "" in node:
            options.append(r"\b")
        return options[0] if len(options) == 1 else "(?:" + "|".join(options) + ")"

    def _letter(self, c: str) -> str:
        return self.space if c == " " else re.escape(c)

    def begun(self, phrase: str) -> list[str]:
        """The phrases that stand wherever ``phrase`` does, at its beginning."""
        return [p for p in self.phrases if phrase == p or phrase.startswith(p) and border(phrase, len(p))]

    def longest(self, text: Column) -> Column:
        """At each place of ``text`` (folded) where phrases begin, the longest, with single spaces."""
        if not self.pattern:
            return F.array().cast("array<string>")
        found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(1))
        return found if self.space == " " else F.transform(found, lambda m: F.regexp_replace(m, r"(?U)\s+", " "))

    def lookup(self, value) -> Column:
        """A map from each phrase to what ``value`` says of all that begin with it, as one constant."""
        kind, table = value
        return F.from_json(F.lit(json.dumps({p: table(self.begun(p)) for p in self.phrases})), f"map<string,{kind}>")


class Names:
    """Which names, of which categories, a text speaks of by their phrases."""

    def __init__(self, entries: Iterable[tuple[str, str, list[str]]]):
        self._owners: dict[str, set[tuple[str, str]]] = {}
        for name, category, phrases in entries:
            for p in phrases:
                self._owners.setdefault(p, set()).add((category, name))
        self._table = PhraseTable(self._owners)

    def pairs(self, text: Column) -> Column:
        """Distinct (category, name) structs, sorted."""

        def owners(phrases: list[str]) -> list[dict]:
            found = sorted({o for p in phrases for o in self._owners[p]})
            return [{"category": c, "name": n} for c, n in found]

        table = self._table.lookup(("array<struct<category:string,name:string>>", owners))
        found = F.array_distinct(self._table.longest(fold(text)))
        return F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda m: F.element_at(table, m)))))


def count_phrases(text: Column, fixed: list[str], own: list[str], carried: Column) -> Column:
    """Occurrences in ``text`` (lower case) of the ``fixed`` phrases, and of those of ``own`` that ``carried`` holds."""
    fixed, own = list(dict.fromkeys(fixed)), [k for k in dict.fromkeys(own) if k not in fixed]
    plain = lambda k: k.isascii() and k == " ".join(k.split()) and not overlaps_itself(k)
    table = PhraseTable([k for k in fixed + own if plain(k)], exact=True)
    counts = table.lookup(("struct<fixed:int,own:array<string>>", lambda ps: {"fixed": sum(p in fixed for p in ps), "own": [p for p in ps if p in own]}))

    def of(hit: Column) -> Column:
        return hit["fixed"] + F.size(F.filter(hit["own"], lambda k: F.array_contains(carried, k)))

    hits = F.transform(table.longest(F.translate(text, "ıſ", "is")), lambda m: of(F.element_at(counts, m)))
    total = F.aggregate(hits, F.lit(0), lambda n, x: n + x)
    for k in fixed + own:  # the few that one pass cannot count
        if not plain(k):
            n = F.regexp_count(text, F.lit(rx.java(rf"\b{re.escape(k)}\b", "i")))
            total += n if k in fixed else F.when(F.array_contains(carried, k), n).otherwise(0)
    return total

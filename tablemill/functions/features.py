"""Features read from text: education, research, skills, tools, language."""

from __future__ import annotations

import functools
import json
import re
import warnings
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.functions import batches, languages, phrases, rx, vocab


def _labels(text: Column, table: dict[str, list[str]]) -> Column:
    """Names of the entries that match, in the table's order."""
    return rx.bind(text, lambda row: F.array_compact(F.array(*(F.when(rx.found(row, p), F.lit(name)) for name, p in table.items()))))


def education_levels(description: Column, table: dict[str, list[str]] | None = None) -> Column:
    """All levels mentioned, highest first, joined by ', '; NA without text or mention."""
    found = F.array_join(_labels(description, table or vocab.EDUCATION_LEVELS), ", ")
    return F.when(rx.blank(description) | (found == ""), vocab.NA).otherwise(found)


def education_field(description: Column) -> Column:
    """Fields mentioned, industrial engineering first; NA without text, 'Other Fields' without mention."""
    found = F.array_join(_labels(description, vocab.EDUCATION_FIELDS), ", ")
    return F.when(rx.blank(description), vocab.NA).when(found == "", "Other Fields").otherwise(found)


def fill_education(level: Column, description: Column) -> Column:
    """A level that is there, else what the narrower table finds."""
    return F.when(rx.blank(level) | (level == vocab.NA), education_levels(description, vocab.EDUCATION_FILL)).otherwise(level)


def is_research(description: Column, company: Column) -> Column:
    """1 if the text speaks of research or academia or the company's name does; 0 without text."""
    named = rx.contains_any(F.lower(company), vocab.ACADEMIC_NAMES)
    return F.when(rx.blank(description), 0).when(rx.matches(description, vocab.RESEARCH_PATTERNS) | named, 1).otherwise(0)


class Vocabulary:
    """Named pattern lists in categories, compiled to one regular expression per name or category."""

    def __init__(self, entries: list[tuple[str, str, list[str]]], categories: list[str] | None = None, total: int | None = None):
        self.entries = entries
        self.categories = categories or list(dict.fromkeys(c for _, c, _ in entries))
        self.total = len(entries) if total is None else total

    @classmethod
    def from_tables(cls, tables: dict[str, dict[str, list[str]]]) -> Vocabulary:
        return cls([(name, category, patterns) for category, table in tables.items() for name, patterns in table.items()])

    @classmethod
    def from_phrases(cls, tables: dict[str, dict[str, list[str]]]) -> Vocabulary:
        """Phrases stand between word borders; any white space parts their words.  All are found in one pass."""
        return PhraseVocabulary([(name, category, list(own)) for category, table in tables.items() for name, own in table.items()])

    @classmethod
    def load(cls, path: str, kind: str, spark: SparkSession | None = None) -> Vocabulary:
        """From JSON {categories, total_<kind>, <kind>: [{name, category, patterns}]}; entries without
        name or patterns are left out, patterns that do not compile with a warning."""
        if spark is None:
            with open(path, encoding="utf-8") as f:
                data = json.load(f)
        else:
            data = json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
        entries = []
        for x in data.get(kind, []):
            good = []
            for p in x.get("patterns") or []:
                try:
                    re.compile(p, re.IGNORECASE)
                    good.append(p)
                except re.error as e:
                    warnings.warn(f"{x.get('name')}: the pattern {p!r} is left out: {e}", stacklevel=2)
            if x.get("name") and good:
                entries.append((x["name"], x.get("category", ""), good))
        return cls(entries, data.get("categories"), data.get(f"total_{kind}"))

    def names(self) -> list[str]:
        return [n for n, _, _ in self.entries]

    def category_of(self, name: str) -> str | None:
        return next((c for n, c, _ in self.entries if n == name), None)

    def _by_name(self) -> dict[str, list[str]]:
        table: dict[str, list[str]] = {}
        for name, _, patterns in sorted(self.entries):
            table.setdefault(name, []).extend(patterns)
        return table

    def _by_category(self) -> dict[str, list[str]]:
        table: dict[str, list[str]] = {}
        for _, category, patterns in sorted(self.entries, key=lambda e: e[1]):
            table.setdefault(category, []).extend(patterns)
        return table

    def found(self, text: Column) -> Column:
        """Sorted names."""
        return _labels(text, self._by_name())

    def found_string(self, text: Column) -> Column:
        return F.array_join(self.found(text), ", ")

    def found_categories(self, text: Column) -> Column:
        """Sorted distinct categories: one test per category, not per name."""
        return _labels(text, self._by_category())

    def found_with_category(self, text: Column) -> Column:
        """Sorted (name, category) structs."""
        own = dict((n, c) for n, c, _ in self.entries)
        pair = lambda n: F.struct(F.lit(n).alias("name"), F.lit(own[n]).alias("category"))
        return rx.bind(text, lambda row: F.array_compact(F.array(*(F.when(rx.found(row, p), pair(n)) for n, p in self._by_name().items()))))

    def found_by_category(self, text: Column) -> Column:
        """Map of category to sorted names, categories in order of name."""
        groups: dict[str, dict[str, list[str]]] = {}
        for n, c, p in sorted(self.entries, key=lambda e: (e[1], e[0])):
            groups.setdefault(c, {}).setdefault(n, []).extend(p)
        pairs = [F.struct(F.lit(c).alias("key"), _labels(text, t).alias("value")) for c, t in groups.items()]
        return F.map_from_entries(F.filter(F.array(*pairs), lambda x: F.size(x["value"]) > 0))


class PhraseVocabulary(Vocabulary):
    """A vocabulary of phrases instead of patterns; its ``entries`` have patterns, as any vocabulary's."""

    def __init__(self, entries: list[tuple[str, str, list[str]]], categories: list[str] | None = None, total: int | None = None):
        pattern = lambda phrase: r"\b" + r"\s+".join(map(re.escape, phrase.split())) + r"\b"
        super().__init__([(n, c, [pattern(p) for p in own]) for n, c, own in entries], categories, total)
        self._names = phrases.Names(entries)

    def _pairs(self, text: Column, body: Callable[[Column], Column]) -> Column:
        return rx.let(self._names.pairs(text), body)

    def found(self, text: Column) -> Column:
        return self._pairs(text, lambda found: F.array_sort(F.array_distinct(F.transform(found, lambda x: x["name"]))))

    def found_categories(self, text: Column) -> Column:
        return self._pairs(text, lambda found: F.array_distinct(F.transform(found, lambda x: x["category"])))

    def found_with_category(self, text: Column) -> Column:
        pair = lambda x: F.struct(x["name"].alias("name"), x["category"].alias("category"))
        return self._pairs(text, lambda found: F.array_sort(F.transform(found, pair)))

    def found_by_category(self, text: Column) -> Column:
        def grouped(found: Column) -> Column:
            of = lambda c: F.transform(F.filter(found, lambda x: x["category"] == c), lambda x: x["name"])
            return F.map_from_entries(F.transform(F.array_distinct(F.transform(found, lambda x: x["category"])), lambda c: F.struct(c.alias("key"), of(c).alias("value"))))

        return self._pairs(text, grouped)


#: Fixed value: how many skills the vocabulary says it has.
SKILLS_TOTAL = 119


@functools.cache
def tools() -> Vocabulary:
    return Vocabulary.from_tables(vocab.TOOLS)


@functools.cache
def skills() -> Vocabulary:
    made = Vocabulary.from_phrases(vocab.SKILLS)
    made.total = SKILLS_TOTAL
    return made


def substring_skills(text: Column, names: list[str]) -> Column:
    """The legacy extractor: names that are substrings, whatever their case, in vocabulary order."""
    return rx.found_keywords(text, names)


def split_tools(df: DataFrame, tool_names: list[str], id_col: str = "id", skills_col: str = "skills", tools_col: str = "tools") -> DataFrame:
    """id, skills, tools of the rows that change when tools named as skills move to the tools column.

    Skills keep order and repeats; tools are appended unless they are there already; nothing left is null.
    """
    parts = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), rx.strip), lambda x: x != "")
    known = F.array(*map(F.lit, sorted(set(tool_names))))
    items, have = parts(F.col(skills_col)), parts(F.col(tools_col))
    rows = df.select(F.col(id_col), F.coalesce(skills_col, F.lit("")).alias("_s"), F.coalesce(tools_col, F.lit("")).alias("_t"), items.alias("_items"), have.alias("_have"))
    rest = F.filter("_items", lambda x: ~F.array_contains(known, x))
    moved = F.filter("_items", lambda x: F.array_contains(known, x))
    merged = F.concat("_have", F.filter(moved, lambda x: ~F.array_contains(F.col("_have"), x)))
    joined = lambda a: F.nullif(F.array_join(a, ", "), F.lit(""))
    out = rows.select("*", joined(rest).alias(skills_col), joined(merged).alias(tools_col))
    changed = (F.coalesce(skills_col, F.lit("")) != F.col("_s")) | (F.coalesce(tools_col, F.lit("")) != F.col("_t"))
    some = (rx.strip(F.col("_s")) != "") | (rx.strip(F.col("_t")) != "")
    return out.filter(some & changed).select(id_col, skills_col, tools_col)


def language_name(code: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in vocab.LANGUAGE_NAMES.items() for x in pair))
    return F.coalesce(F.try_element_at(table, code), F.lit("Unknown"))


def function_word_language(text: Column) -> Column:
    """The built-in detector: the language whose function words are most frequent; NA for under 20
    characters or no such word.  Of equal languages the first in the table wins."""
    low = F.lower(rx.strip(F.coalesce(text, F.lit(""))))

    def decide(row: Column) -> Column:
        options = []
        for k, (code, words) in enumerate(vocab.FUNCTION_WORDS.items()):
            n = F.size(F.filter(row["words"], lambda w: w.isin(words)))  # noqa: B023 (called at once)
            options.append(F.struct(n.alias("n"), F.lit(-k).alias("order"), F.lit(code).alias("code")))
        return rx.let(F.array_max(F.array(*options)), lambda best: F.when(row["short"] | (best["n"] == 0), vocab.NA).otherwise(best["code"]))

    # Words are cut once; a pattern for each language would read the text again each time.
    return rx.let(F.struct(F.split(low, r"(?U)\W+").alias("words"), (F.char_length(low) < 20).alias("short")), decide)


def detect_language(
    df: DataFrame, text_col: str, language_col: str | None = "language", detector: Callable[[str], str] | languages.Profiles | None = None, into: str = "detected_language", source: DataFrame | None = None
) -> DataFrame:
    """A language column that holds any value is used as it is (blank: NA); else the text decides.

    Whether it holds any is asked of ``source``, a frame that is cheap to read, if one is given.
    ``detector`` is learnt n-gram profiles (``languages.learn``), or a function that maps a text to a code and runs in
    Arrow batches; without one function words decide, which know five languages and need no learning.
    """
    if language_col in df.columns and not (df if source is None else source).filter(F.col(language_col).isNotNull()).isEmpty():
        return df.withColumn(into, F.when(rx.blank(F.col(language_col)), vocab.NA).otherwise(F.col(language_col)))
    if detector is None:
        return df.withColumn(into, function_word_language(F.col(text_col)))
    if isinstance(detector, languages.Profiles):
        return df.withColumn(into, languages.detect(F.col(text_col), detector, df.sparkSession))

    batches.short_batches(df.sparkSession)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str:
            t = (t or "").strip()
            if len(t) < 20:
                return vocab.NA
            try:
                return detector(t)
            except Exception:  # a detector that gives up on a text must not end the job
                return vocab.NA

        return texts.map(one)

    return df.withColumn(into, run(F.col(text_col).cast("string")))

"""Personal data: base patterns, then bootstrapped contextual extraction.

Base matches seed the search.  Runs of up to ``NGRAM`` tokens that look like an identifier of some
kind and touch no base match are candidates.  Every seed and candidate has lexical patterns: the two
words before it, the words on either side, the two words after it, and its own form (digits as 9,
letters as a).  Patterns and distinct identifiers form a graph that is scored in rounds:

* a pattern is as good, for a kind, as the share of its identifiers known to be of that kind;
* a candidate is as likely of a kind as its good patterns make it; likely ones become known, and so
  seeds of the next round (of word patterns; forms count base matches only), until a round finds
  nothing new.

Every candidate that equals a known identifier, however it is written, is a span of that kind.
The share is smoothed, so a pattern needs several distinct identifiers before it can be good.

Everything is column expressions and joins: texts are scanned in place, only mentions (position,
hashes) travel, and scores are aggregated before each shuffle.  Work in a text grows with its length
and hardly more with the number of its matches: sums and maxima along them are taken in blocks.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.functions.rx import let
from tablemill.llm.arrays import running
from tablemill.llm.scratch import small_or_shuffled, store

KINDS = ("email", "ip", "card", "phone")

# Possessive and anchored forms of the plain patterns: the same matches, without rescanning a run of
# word characters from each of its characters.
_LOCAL = r"[A-Za-z0-9._%+-]"
_RX = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BLANK = r"\x09-\x0D\x20"
#: A token between white space that holds a digit or an at sign.
_TOKEN = rf"(?<![^{_BLANK}])[^{_BLANK}0-9@]*+[0-9@][^{_BLANK}]*+"
#: What a candidate of a kind must look like (after trimming quotes and stops).
_SHAPE = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^[0-9A-Fa-f]*(?::[0-9A-Fa-f]*){3,}$",
    "card": r"^[0-9](?:[^0-9A-Za-z]?[0-9]){11,18}$",
    "phone": r"^\+?\(?[0-9](?:[^0-9A-Za-z@:]{0,3}[0-9]){6,14}$",
}
NGRAM = 5
SMOOTHING = 2.0
PATTERN_SCORE = 0.7
INSTANCE_SCORE = 0.8
#: Fewer identifiers than this can never make a pattern's smoothed share reach PATTERN_SCORE.
_LEAST = ceil(SMOOTHING * PATTERN_SCORE / (1 - PATTERN_SCORE))
_NEAR = 64  # characters that are tried first for neighbouring words; the whole text beyond, if they hold too few


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(value: Column) -> Column:
    d = F.reverse(_digits(value))
    each = F.transform(
        F.sequence(F.lit(1), F.char_length(d)),
        lambda i: F.when(i % 2 == 1, F.substring(d, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substring(d, i, F.lit(1)).cast("int") + 1)
        ),
    )
    return F.aggregate(each, F.lit(0), _sum)


def _luhn(value: Column) -> Column:
    return F.when(F.char_length(_digits(value)).between(16, 19), _luhn_sum(value) % 10 == 0).otherwise(False)


def _small_parts(value: Column) -> Column:
    """All parts at most 255, whatever zeros they begin with."""
    return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")


_VALID = {
    "email": lambda v: F.lit(True),
    "ip": _small_parts,
    "card": _luhn,
    "phone": lambda v: F.char_length(_digits(v)).between(8, 15),
}


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _scan(text: Column, rx: str, guard: Column) -> Column:
    """parts, found and spots: what lies between the matches, the matches, and (i, s, e, value) of each, in
    code points.  Texts that fail ``guard`` are not searched."""
    none = F.array().cast("array<string>")
    hit = F.when(guard, text.rlike(rx)).otherwise(False)
    cut = F.struct(F.when(hit, F.split(text, rx, -1)).otherwise(none).alias("parts"), F.when(hit, F.regexp_extract_all(text, F.lit(rx), F.lit(0))).otherwise(none).alias("found"))

    def placed(r: Column) -> Column:
        gaps = F.transform(r["found"], lambda m, i: F.char_length(F.element_at(r["parts"], i + 1)))
        sizes = F.transform(r["found"], F.char_length)

        def spots(g: Column) -> Column:
            at = running(F.zip_with(g["gap"], g["size"], _sum), F.lit(0), _sum)
            begin = let(at, lambda x: F.zip_with(x, g["gap"], _sum))
            return let(begin, lambda x: F.transform(r["found"], lambda m, i: F.struct(
                i.alias("i"), F.element_at(x, i + 1).alias("s"), (F.element_at(x, i + 1) + F.element_at(g["size"], i + 1)).alias("e"), m.alias("value"))))

        return F.struct(r["parts"], r["found"], let(F.struct(gaps.alias("gap"), sizes.alias("size")), spots).alias("spots"))

    return let(cut, placed)


def _words(text: Column) -> Column:
    """Normal forms of the words of ``text``: lower case, numbers as 9, without what surrounds letters and digits."""
    bare = lambda w: F.regexp_replace(F.regexp_replace(F.lower(w), "[0-9]+", "9"), r"^[^\p{L}9]+|[^\p{L}9]+$", "")
    return F.filter(F.transform(F.split(text, rf"[{_BLANK}]+"), bare), lambda w: w != "")


def _near_words(text: Column, near: Column) -> Column:
    """The words of ``text``; only those of ``near``, its beginning or end, if two of them are whole."""
    return let(_words(near), lambda w: F.when((F.size(w) > 2) | (F.char_length(text) <= _NEAR), w).otherwise(_words(text)))


def _patterns(scan: Column, first: Column, last: Column, value: Column) -> Column:
    """Hashes of the lexical patterns of what reaches from the first to the last match of a scan; none
    where a neighbour is missing.  The neighbours of a match are words of the text, matches or not."""
    part = lambda i: F.coalesce(F.try_element_at(scan["parts"], i + 1), F.lit(""))
    match = lambda i: F.when(i >= 0, F.coalesce(F.try_element_at(scan["found"], F.greatest(i, F.lit(0)) + 1), F.lit(""))).otherwise("")
    earlier = F.when(first >= 1, F.concat(match(first - 2), part(F.greatest(first - 1, F.lit(0))), match(first - 1))).otherwise("")
    before, after = F.concat(earlier, part(first)), F.concat(part(last + 1), match(last + 1), part(last + 2), match(last + 2))
    left = let(before, lambda t: _near_words(t, F.right(t, F.lit(_NEAR))))
    right = let(after, lambda t: _near_words(t, F.left(t, F.lit(_NEAR))))
    form = F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), "[0-9]", "9")

    def hashes(w: Column) -> Column:
        l1, l2 = F.try_element_at(w["l"], F.lit(-1)), F.try_element_at(w["l"], F.lit(-2))
        r1, r2 = F.try_element_at(w["r"], F.lit(1)), F.try_element_at(w["r"], F.lit(2))
        pair = lambda name, a, b: F.when(a.isNotNull() & b.isNotNull(), F.shiftleft(F.xxhash64(F.lit(name), a, b), 1))
        own = F.shiftleft(F.xxhash64(F.lit("form"), form), 1) + 1  # odd: a form
        return F.array_compact(F.array(pair("before", l2, l1), pair("around", l1, r1), pair("after", r1, r2), own))

    return let(F.struct(left.alias("l"), right.alias("r")), hashes)


def _instance(value: Column) -> Column:
    """The identifier itself, however it is spaced: numbers without separators but dots and colons."""
    low = F.lower(value)
    return F.xxhash64(F.when(low.contains("@"), low).otherwise(F.regexp_replace(low, r"[^\p{L}0-9.:]", "")))


def _seeds(order: int, scan: Column, valid: Column) -> Column:
    """Graph mentions of the valid matches of a kind."""
    edge = lambda m: F.struct(
        F.lit(order).alias("o"), m["s"], m["e"], _instance(m["value"]).alias("instance"),
        _patterns(scan, m["i"], m["i"], m["value"]).alias("patterns"), F.array().cast("array<int>").alias("fits"),
    )
    return F.transform(valid, edge)


def _fits(value: Column) -> Column:
    """The kinds a candidate could be of; a card's digits must pass the check."""
    looks = {k: value.rlike(_SHAPE[k]) for k in KINDS}
    looks["card"] = F.when(looks["card"], _luhn_sum(value) % 10 == 0).otherwise(False)
    return F.array_compact(F.array(*(F.when(looks[k], F.lit(i)) for i, k in enumerate(KINDS))))


def _candidates(scan: Column, base: Column) -> Column:
    """Graph mentions of the token runs that fit a kind and touch no base match."""
    lead, trail = r"^[\"'(\[{<]+(?![0-9]+\))", r"[\"')\]}>.,;:!?]+$"

    def run(i: Column, n: int) -> Column:
        """Tokens i to i + n - 1, if single spaces part them, without surrounding quotes and stops."""
        raw = F.array_join(F.transform(F.slice(scan["spots"], i + 1, n), lambda t: t["value"]), " ")
        glued = F.forall(F.slice(scan["parts"], i + 2, max(n - 1, 1)), lambda p: p == " ") if n > 1 else F.lit(True)
        whole = i + n <= F.size(scan["spots"])

        def trimmed(raw: Column) -> Column:
            front = F.regexp_replace(raw, lead, "")
            value = F.regexp_replace(front, trail, "")
            start = F.element_at(scan["spots"], i + 1)["s"] + F.char_length(raw) - F.char_length(front)
            return F.struct(start.alias("s"), F.lit(1).alias("b"), (start + F.char_length(value)).alias("e"), value.alias("value"), i.alias("i"), (i + n - 1).alias("j"), _fits(value).alias("fits"))

        return F.when(whole & glued, let(raw, trimmed))

    runs = F.flatten(F.transform(scan["spots"], lambda t: F.array(*(run(t["i"], n) for n in range(1, NGRAM + 1)))))
    likely = F.filter(F.array_compact(runs), lambda c: (F.size(c["fits"]) > 0) & (c["s"] < c["e"]))
    kind = "struct<s:int,b:int,e:int,value:string,i:int,j:int,fits:array<int>>"
    taken = F.transform(base, lambda x: F.struct(x["s"].alias("s"), F.lit(0).alias("b"), x["e"].alias("e"), F.lit("").alias("value"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.array().cast("array<int>").alias("fits")))
    events = F.array_sort(F.concat(taken.cast(f"array<{kind}>"), likely.cast(f"array<{kind}>")))

    def free(v: Column) -> Column:
        far = F.lit((1 << 31) - 1)
        till = running(F.transform(v, lambda x: F.when(x["b"] == 0, x["e"]).otherwise(0)), F.lit(0), F.greatest)
        begin = F.reverse(running(F.reverse(F.transform(v, lambda x: F.when(x["b"] == 0, x["s"]).otherwise(far))), far, F.least))
        room = F.struct(till.alias("till"), begin.alias("begin"))
        return let(room, lambda r: F.filter(v, lambda x, k: (x["b"] == 1) & (F.element_at(r["till"], k + 1) <= x["s"]) & (F.element_at(r["begin"], k + 1) >= x["e"])))

    edge = lambda c: F.struct(
        F.lit(-1).alias("o"), c["s"], c["e"], _instance(c["value"]).alias("instance"),
        _patterns(scan, c["i"], c["j"], c["value"]).alias("patterns"), c["fits"],
    )
    return let(events, lambda v: F.transform(free(v), edge))


def _scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, row keys, base spans (order, start, end), and graph mentions of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", "text", F.xxhash64("id", "text").alias("k1"), F.crc32(F.col("text").cast("binary")).alias("k2"))
    rows = rows.withColumn("_at", F.col("text").contains("@")).withColumn("_digit", F.col("text").rlike("[0-9]"))
    guards = {"email": F.col("_at"), "ip": F.col("_digit"), "card": F.col("_digit"), "phone": F.col("_digit") & F.col("text").contains("+")}
    rows = rows.withColumns({k: _scan(F.col("text"), _RX[k], guards[k]) for k in KINDS} | {"token": _scan(F.col("text"), _TOKEN, F.col("_at") | F.col("_digit"))})

    def judged(k: int, name: str) -> Column:
        """The valid matches of a kind as spans and as mentions."""
        def both(scan: Column) -> Column:
            valid = F.filter(scan["spots"], lambda m: _VALID[name](m["value"]))
            spans = lambda v: F.transform(v, lambda m: F.struct(F.lit(k).alias("o"), m["s"], m["e"]))
            return let(valid, lambda v: F.struct(spans(v).alias("spans"), _seeds(k, scan, v).alias("seeds")))

        return let(F.col(name), both)

    rows = rows.withColumns({f"_{name}": judged(k, name) for k, name in enumerate(KINDS)})
    base = F.concat(*(F.col(f"_{name}")["spans"] for name in KINDS))
    seeds = F.concat(*(F.col(f"_{name}")["seeds"] for name in KINDS))
    # One name for all of it, so that no part is made anew for each use.
    both = let(F.struct(base.alias("base"), F.col("token").alias("token")), lambda r: F.struct(r["base"], _candidates(r["token"], r["base"]).alias("open")))
    rows = rows.select("id", "k1", "k2", seeds.alias("seeds"), both.alias("both"))
    return rows.select("id", "k1", "k2", F.col("both.base").alias("base"), F.concat("seeds", "both.open").alias("mentions"))


def _discover(scanned: DataFrame) -> DataFrame:
    """k1, k2, o, s, e: spans that the graph adds."""
    mentions = store(scanned.select("k1", "k2", F.explode("mentions").alias("m")).select("k1", "k2", "m.*"), "mentions")
    links = mentions.select("instance", F.explode("patterns").alias("pattern")).distinct()
    totals = store(links.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= _LEAST), "totals")
    links = store(links.join(small_or_shuffled(totals.select("pattern")), "pattern", "left_semi"), "links")
    unknown = store(mentions.filter("o < 0").select("instance", F.explode("fits").alias("kind")).distinct(), "open")
    known = fresh = store(mentions.filter("o >= 0").select("instance", F.col("o").alias("kind")).distinct(), "known")
    counts = None
    while True:
        # What was found tells of words around it, not of forms: else one form after the other would count as private.
        told = links if counts is None else links.filter(F.col("pattern").bitwiseAND(F.lit(1)) == 0)
        gained = told.join(fresh, "instance").groupBy("pattern", "kind").agg(F.count("*").alias("known"))
        counts = store(gained if counts is None else counts.unionByName(gained).groupBy("pattern", "kind").agg(F.sum("known").alias("known")), "counts")
        share = F.col("known") / (F.col("n") + SMOOTHING)
        good = store(counts.join(totals, "pattern").select("pattern", "kind", share.alias("p")).filter(F.col("p") >= PATTERN_SCORE), "good")
        doubt = F.exp(F.sum(F.log(1 - F.col("p"))))  # p is below 1, being smoothed
        scores = links.join(small_or_shuffled(good), "pattern").join(unknown, ["instance", "kind"]).groupBy("instance", "kind").agg((1 - doubt).alias("score"))
        likely = scores.filter(F.col("score") >= INSTANCE_SCORE).join(known.select("instance"), "instance", "left_anti")
        fresh = store(likely.groupBy("instance").agg(F.min(F.struct(-F.round("score", 9), F.col("kind"))).alias("best")).select("instance", "best.kind"), "fresh")
        if fresh.isEmpty():
            break
        known = store(known.unionByName(fresh), "known")
    spots = mentions.filter("o < 0").join(known, "instance").filter(F.array_contains("fits", F.col("kind")))
    return spots.groupBy("k1", "k2", "s", "e").agg(F.min("kind").alias("o"))


def _outermost(spans: Column) -> Column:
    """Spans that lie in no other of them."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["o"].alias("o"))))

    def kept(v: Column) -> Column:
        till = running(F.transform(v, lambda x: -x["e"]), F.lit(0), F.greatest)
        return let(till, lambda t: F.filter(v, lambda x, k: -x["e"] > F.element_at(t, k + 1)))

    return F.transform(let(ordered, kept), lambda x: F.struct(x["o"].alias("o"), x["s"].alias("s"), (-x["e"]).alias("e")))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, k1, k2, base and spans, arrays of (o, s, e) structs.

    o is the place of the kind in ``KINDS``; s and e are positions in code points, e exclusive.
    base holds the matches of the fixed patterns that pass their checks, spans these and what
    the graph added, both by kind and start; of added spans within each other the outermost.  Null and
    empty texts have none.  Rows that repeat id and text get the same spans.  A row's id may be null.
    An empty table gives no rows.  Other columns are ignored.
    """
    scanned = store(_scanned(docs, id_col, text_col), "scanned")
    added = _discover(scanned).groupBy("k1", "k2").agg(F.collect_set(F.struct("o", "s", "e")).alias("added"))
    added = added.select("k1", "k2", _outermost(F.col("added")).alias("added"))
    none = F.array().cast("array<struct<o:int,s:int,e:int>>")
    spans = F.array_sort(F.concat("base", F.coalesce("added", none)))
    return scanned.select("id", "k1", "k2", "base").join(added, ["k1", "k2"], "left").select(F.col("id").alias(id_col), "k1", "k2", "base", spans.alias("spans"))


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with each of the spans (sorted by start) as its kind in brackets; of overlapping ones the first is named.

    A place far into a text takes long to reach, so spans are taken in blocks of about the root of their
    number: the text is cut once for a block, and the piece once for each span."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def whole(r: Column) -> Column:
        def joined(v: Column) -> Column:
            # v: (s, e, o, at), at being where the spans before it end
            width = F.ceil(F.sqrt(F.size(v))).cast("int")

            def block(own: Column) -> Column:
                begin = F.element_at(own, 1)["at"]
                size = F.greatest(F.element_at(own, -1)["s"] - begin, F.lit(0))
                piece = F.substring(r["text"], begin + 1, size)
                named = lambda t: F.transform(own, lambda x: F.when(x["s"] >= x["at"], F.concat(F.substring(t, x["at"] - begin + 1, x["s"] - x["at"]), F.element_at(names, x["o"] + 1))).otherwise(""))
                return F.array_join(let(piece, named), "")

            blocks = F.transform(F.sequence(F.lit(0), F.size(v) - 1, width), lambda b: let(F.slice(v, b + 1, width), block))
            last = F.element_at(v, -1)
            rest = F.substring(r["text"], F.greatest(last["at"], last["e"]) + 1, F.char_length(r["text"]))
            return F.concat(F.array_join(blocks, ""), rest)

        at = running(F.transform(r["spans"], lambda x: x["e"]), F.lit(0), F.greatest)
        placed = F.zip_with(r["spans"], at, lambda x, a: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["o"].alias("o"), a.alias("at")))
        return let(placed, joined)

    return let(F.struct(text.alias("text"), spans.alias("spans")), whole)


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", small: int = 500_000) -> DataFrame:
    """``docs`` with every span's text replaced by its kind in brackets; overlapping spans become one.

    Rows are told by id and text, so null and repeated ids do not matter; texts without spans, null and
    empty ones stay as they are.  Columns keep names and order.  The texts' spans are broadcast if they
    hold at most ``small`` spans in all."""
    spans = F.array_sort(F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["o"].alias("o"))))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))  # so that no name of ours can clash
    marked = store(found.filter(F.size("spans") > 0).select("k1", "k2", spans.alias("spans")).dropDuplicates(["k1", "k2"]), "marked")
    if (marked.agg(F.sum(F.size("spans"))).first()[0] or 0) <= small:
        marked = F.broadcast(marked)
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    rows = rows.select("row", text.alias("text"), F.xxhash64(F.col("row")[id_col], text).alias("k1"), F.crc32(text.cast("binary")).alias("k2"))
    rows = rows.join(marked, ["k1", "k2"], "left")
    clean = F.when(F.col("spans").isNull(), F.col("row")[text_col]).otherwise(_masked(F.col("text"), F.col("spans")))
    return rows.select(*(clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))


def op8_pii_bootstrapped(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    kinds = F.array(*map(F.lit, KINDS))
    line = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", F.element_at(kinds, x["o"] + 1), x["s"], x["e"])), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["o"] == k)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(line("base").cast("binary"), 256).alias("base_sha256"), line("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )

"""Licence scan: stretches of a text against licence templates by the Dice coefficient of word bigrams.

All in column expressions.  A text is normalised (ASCII letters lower, everything but digits,
letters and characters beyond ASCII to one space), so line breaks do not matter.  With |A| and |B|
bigrams, Dice can reach t only if t / (2 - t) <= |A| / |B| <= (2 - t) / t, so a text needs a least
number of a template's bigrams.  Two tests follow that lose nothing: each template gets a few words without which
that number cannot be reached, for a byte search; then the bigrams that text and template share are counted.
For each template left the places where its bigrams stand are strung together while no more than a few
other bigrams lie between, and the stretches whose size allows the coefficient are compared.
So a notice within a line, a wrapped one and a whole licence in a longer file are found alike.
Templates are one constant table, so the plan does not grow with them.
Nothing is exploded or shuffled; a row is scanned where it is, in time that grows with its length.
"""

from __future__ import annotations

import json
from fractions import Fraction
from itertools import combinations
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.functions.rx import let
from tablemill.llm.arrays import running

DICE = 0.8

#: Notices by which texts declare a licence.
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

#: Licence texts and headers as they are published.
TEXTS: list[tuple[str, str]] = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright
holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior
written permission."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the
License."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely."""),
]

_GAP = r"[^0-9a-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal_words(text: str) -> list[str]:
    """A template's words as the scan makes them (templates are ASCII)."""
    low = text.translate(str.maketrans(_UPPER, _LOWER))
    return "".join(c if c.isalnum() else " " for c in low).split()


def bigrams(text: str) -> list[str]:
    w = normal_words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def bounds(size: int, dice: float) -> tuple[int, int]:
    """The fewest and most bigrams with which ``dice`` can be reached against ``size``."""
    t = Fraction(str(dice))
    return ceil(size * t / (2 - t)), floor(size * (2 - t) / t)


def slack(size: int) -> int:
    """Other bigrams that may lie between two of a template of ``size``: one changed word makes two."""
    return 0 if size < 10 else max(2, size // 20)


def known_templates(templates: list[tuple[str, str]] | None = None) -> list[tuple[str, list[str]]]:
    """(name, bigrams) of the templates of at least two words."""
    return [(name, grams) for name, text in (templates if templates is not None else NOTICES + TEXTS) if (grams := bigrams(text))]


def least_shared(size: int, dice: float) -> int:
    """The fewest bigrams of a template of ``size`` that a stretch reaching ``dice`` holds."""
    return ceil(Fraction(str(dice)) * (bounds(size, dice)[0] + size) / 2)


#: Words that most English texts hold, so that they sort out little.
_COMMON = frozenset("a an and any are as at be by for from in is it may no not of on or that the this to under was with you".split())


def marks(grams: list[str], dice: float) -> list[str]:
    """Words of which a text must hold one to reach ``dice``: too few of the ``grams`` are without them.
    Any such words are right; long and uncommon ones sort out more."""
    spare = least_shared(len(grams), dice) - 1  # so many bigrams may do without a mark
    cost = lambda w: 8.0 ** -len(w) * (100 if w in _COMMON else 1)
    left = lambda chosen: sum(not set(g.split()) & set(chosen) for g in grams)
    words = sorted({w for g in grams for w in g.split()}, key=lambda w: (cost(w), w))
    if len(words) <= 12:
        some = (c for n in range(1, len(words) + 1) for c in combinations(words, n) if left(c) <= spare)
        return sorted(min(some, key=lambda c: (sum(map(cost, c)), c)))
    chosen: list[str] = []
    weight = lambda w: 50 if w in _COMMON else 5 if len(w) < 5 else 1
    while (now := left(chosen)) > spare:
        chosen.append(max((w for w in words if w not in chosen), key=lambda w: ((now - left([*chosen, w])) / weight(w), w)))
    return sorted(chosen)


_TEMPLATE = "struct<license:string,own:array<string>,size:int,room:int,least:int,low:int,high:int,marks:array<string>>"


def template_table(known: list[tuple[str, list[str]]], dice: float) -> Column:
    """The templates as one constant array."""
    rows = []
    for name, own in known:
        low, high = bounds(len(own), dice)
        rows.append({"license": name, "own": own, "size": len(own), "room": slack(len(own)) + 1, "least": least_shared(len(own), dice), "low": low, "high": high, "marks": marks(own, dice)})
    return F.from_json(F.lit(json.dumps(rows)), f"array<{_TEMPLATE}>")


def _stretches(grams: Column, shared: Column, t: Column) -> Column:
    """(first, last) of the stretches of a template's bigrams that are not too short."""
    places = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(shared, g), i)), lambda i: i.isNotNull())

    def strung(p: Column) -> Column:
        starts = F.filter(p, lambda x, k: (k == 0) | (x - F.element_at(p, F.greatest(k, F.lit(1))) > t["room"]))
        ends = F.filter(p, lambda x, k: (k == F.size(p) - 1) | (F.coalesce(F.try_element_at(p, k + 2), x) - x > t["room"]))
        return F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), b.alias("last"))), lambda s: s["last"] - s["first"] + 1 >= t["low"])

    return let(places, strung)


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, dice: float = DICE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and matches, a sorted array of (word, license, dice) structs.

    word counts from 0 and tells where in the text the stretch begins; of stretches that begin at one
    word the closest counts, of equally close ones the first licence by name, and a stretch within an
    earlier one does not count.  Templates of fewer than two words never match.  Null and
    empty texts have no matches; whole texts are scanned, whatever
    their length; an empty table gives no rows.  Rows that repeat an id are rows of their own.  Other
    columns are ignored.
    """
    known = known_templates(templates)
    found_type = "array<struct<word:int,away:double,license:string,last:int>>"
    empty = F.array().cast("array<struct<word:int,license:string,dice:double>>")
    if not known:
        return docs.select(id_col, empty.alias("matches"))
    table = template_table(known, dice)
    words_asked = F.lit(sorted({m for _, own in known for m in marks(own, dice)}))
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _UPPER, _LOWER)

    def compared(grams: Column, t: Column) -> Column:
        def judge(s: Column) -> Column:
            def measured(part: Column) -> Column:
                shared = F.size(F.array_intersect(part, t["own"]))
                value = F.when(F.size(part).between(t["low"], t["high"]), (2.0 * shared) / (F.size(part) + t["size"])).otherwise(0.0)
                return F.struct(s["first"].alias("word"), (-value).alias("away"), t["license"].alias("license"), s["last"].alias("last"))

            return let(F.array_distinct(F.slice(grams, s["first"] + 1, s["last"] - s["first"] + 1)), measured)

        def enough(shared: Column) -> Column:
            near = F.filter(F.transform(_stretches(grams, shared, t), judge), lambda m: -m["away"] >= dice)
            return F.when(F.size(shared) >= t["least"], near).otherwise(F.array().cast(found_type))

        return let(F.array_intersect(t["own"], grams), enough)

    def searched(words: Column, there: Column) -> Column:
        pairs = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
        possible = F.filter(table, lambda t: F.arrays_overlap(t["marks"], there))
        return let(pairs, lambda grams: F.array_sort(F.flatten(F.transform(possible, lambda t: compared(grams, t)))))

    def best(found: Column) -> Column:
        # Sorted by word, falling dice and licence: the first of those that begin at one word, if it reaches beyond all earlier ones.
        one = F.filter(found, lambda m, k: (k == 0) | (F.element_at(found, F.greatest(k, F.lit(1)))["word"] != m["word"]))

        def outer(v: Column) -> Column:
            till = running(F.transform(v, lambda m: m["last"]), F.lit(-1), F.greatest)
            return let(till, lambda t: F.filter(v, lambda m, k: m["last"] > F.element_at(t, k + 1)))

        return F.transform(let(one, outer), lambda m: F.struct(m["word"], m["license"], (-m["away"]).alias("dice")))

    def marked(low: Column) -> Column:
        def split(there: Column) -> Column:
            words = F.filter(F.split(low, _GAP), lambda w: w != "")
            return F.when(F.size(there) > 0, let(words, lambda w: F.when(F.size(w) > 1, let(searched(w, there), best)).otherwise(empty))).otherwise(empty)

        return let(F.filter(words_asked, lambda m: F.contains(low, m)), split)

    return docs.select(F.col(id_col), let(text, marked).alias("matches"))


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"),
        F.array_join(F.array_distinct(F.transform("matches", lambda m: m["word"].cast("string"))), ",").alias("places"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["dice"])), F.lit(0.0)).alias("best_dice"),
    )

"""Spelling variants, repeated passages and the Merkle manifest against plain forms: nulls, empty and long texts, ties, repeated
rows, empty tables and columns with clashing names."""

import random

import brute
import pytest

from tablemill.llm import merkle, spelling, substring_dedup

SCHEMA = "doc_id long, text string, id string, tie int, word string, n int, row string, seed long, start int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "w", 2, "r", 3, 4) for i, t in rows], SCHEMA).repartition(3)


# 11 spelling variants


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(2)
    words = ["".join(rng.choice("aabé") for _ in range(rng.choice((5, 6, 7, 8, 9, 12)))) for _ in range(500)]
    rows = [(rng.choice([None, *range(50)]), " ".join(rng.choice(words).upper() if rng.random() < 0.3 else rng.choice(words) for _ in range(90))) for _ in range(70)]
    return rows + [(1, None), (2, ""), (3, "aaaaa " * 9 + "aaaaaa " * 40 + "ŠÀÉ½aaaaaaaa " * 5), (3, "aaaaa " * 9), (4, "z" * 30_000 + " " + "ab" * 9_000), (5, "éáíóú " * 3 + "éáíóÚ " * 4 + "eáíóú " * 7)]


def spellings(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(spelling.count_words(df)).collect()}


def test_spelling(spark, spelled):
    want = brute.variants(brute.planted_words(spelled))
    assert sum(x[1] for x in want.values()) > 500 and any(x[4] not in (x[2], w) for w, x in want.items())
    assert spellings(frame(spark, spelled)) == want


def test_spelling_small_cells(spark, spelled, monkeypatch):
    """Hot lists dealt to cells, and pairs compared in small blocks, change nothing."""
    monkeypatch.setattr(spelling, "CELL", 5)
    monkeypatch.setattr(spelling, "GROUP_ROWS", 100)
    assert spellings(frame(spark, spelled)) == brute.variants(brute.planted_words(spelled))


def test_spelling_of_given_words(spark):
    rng = random.Random(4)
    base = ["colour", "center", "analyse", "maximum", "aaaaaaa", "abababab"]
    letters = "abcelmnortuyz"
    made = set(base)
    for w in base:
        for _ in range(60):
            k = rng.randrange(len(w) + 1)
            made.add(rng.choice([w[:k] + rng.choice(letters) + w[k:], w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k + 1 :]]))
    words = {w: rng.choice((3, 3, 5, 8, 20)) for w in made if len(w) >= 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(df).collect()} == brute.variants(words)


def test_spelling_empty(spark):
    assert spellings(frame(spark, [])) == {}
    assert spellings(frame(spark, [(1, None), (None, "no word here")])) == {}
    assert spellings(frame(spark, [(8, "single " * 3)])) == {w: (n, 0, None, None, w) for w, n in brute.planted_words([(8, "single " * 3)]).items()}


# 12 repeated passages


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(6)
    letters = "a b c d e f ü 東 x y".split()
    parts = [[rng.choice(letters) for _ in range(rng.choice((5, 19, 20, 21, 40, 100)))] for _ in range(12)]
    rows = []
    for i in range(90):
        words = []
        for _ in range(rng.randrange(5)):
            words += rng.choice(parts) + [rng.choice(letters) for _ in range(rng.randrange(30))]
        rows.append((i * 3, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(1001, None), (1002, ""), (1003, "z " * 500), (1004, "z " * 30), (1005, "p q " * 400), (1006, "q p " * 300 + "z " * 25), (1007, " ".join(str(k % 700) for k in range(30_000)))]
    rng.shuffle(rows)
    return rows


def kept(df, **options):
    return {r.doc_id: (r.repeats.n_words, r.repeats.n_removed, r.text) for r in substring_dedup.drop_repeats(df, **options).collect()}


@pytest.mark.parametrize("window", [20, 9, 5])
def test_repeats(spark, passages, window):
    assert kept(frame(spark, passages), window=window) == brute.repeats(passages, window)


def test_repeats_digests(spark, passages):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.summary(frame(spark, passages)).collect()}
    assert got == {i: (n, gone, brute.sha(text)) for i, (n, gone, text) in brute.repeats(passages).items()}


def test_repeats_hot_seeds_small_blocks_full_bitmap(spark, passages, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 2)
    monkeypatch.setattr(substring_dedup, "BLOCK", 10)
    monkeypatch.setattr(substring_dedup, "MARK_BITS", 1 << 7)
    assert kept(frame(spark, passages), window=9) == brute.repeats(passages, 9)


def test_factors_copy_what_they_say(spark, passages):
    rows = dict(passages)
    found = substring_dedup.factors(frame(spark, passages)).collect()
    assert any(r.source_id is not None for r in found)
    for r in found:
        if r.source_id is not None:
            size = r.windows + substring_dedup.WINDOW - 1
            own, other = rows[r.id].split(), rows[r.source_id].split()
            assert own[r.start : r.start + size] == other[r.source_start : r.source_start + size]
            assert (r.source_id, r.source_start) < (r.id, r.start)


def test_repeats_odd_rows(spark):
    """Rows that repeat id and text are one document; rows without an id come last."""
    text = " ".join(f"w{k}" for k in range(25))
    df = frame(spark, [(None, text), (7, text), (7, text), (9, "new " + text)])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.repeats.n_removed) for r in substring_dedup.drop_repeats(df).collect())
    assert got == [(False, 7, 0), (False, 7, 0), (False, 9, 25), (True, 0, 25)]
    again = substring_dedup.drop_repeats(frame(spark, []))
    assert again.collect() == [] and again.columns[: len(df.columns)] == df.columns


# 13 Merkle manifest


def proofs(df):
    return sorted(map(tuple, merkle.document_proofs(df).collect()), key=repr)


def records(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, position int, hash string").repartition(4)


def test_manifest(spark):
    rng = random.Random(1)
    ids, groups = [None, *range(400)], [None, "", "a", "é", "zz", *["hot"] * 4]
    rows = [(rng.choice(ids), rng.choice(groups), rng.choice([None, "en"]), rng.choice([None, 5]), rng.choice([None, "", "x\ny", "\n", "ü" * 9])) for _ in range(1200)]
    got = proofs(records(spark, rows))
    assert got == sorted(brute.manifest(rows), key=repr) and {x[-1] for x in got} == {True, False}


def test_manifest_many_groups(spark):
    """More groups than a block holds, of one leaf each."""
    rows = [(k, f"s{k}", "en", 1, "a\nb") for k in range(300)] + [(k, "big", None, None, "t" * 100_000) for k in range(1000, 1030)]
    assert proofs(records(spark, rows)) == sorted(brute.manifest(rows), key=repr)


def test_manifest_small(spark):
    assert proofs(records(spark, [])) == []
    one = [(5, "s", None, None, None)]
    (got,) = proofs(records(spark, one))
    assert got == brute.manifest(one)[0] and got[1] == got[2] == got[3] == got[5]


def test_preimages_hash_to_their_parents(spark):
    rows = [(k, "ab"[k % 2], "en", 1, str(k)) for k in range(200)]
    made = merkle.Manifest(records(spark, rows), "doc_id", "source", merkle.FIELDS)
    table = {(r.group, r.level, r.place): (r.preimage, r.hash) for r in made.preimages().collect()}
    for (group, level, place), (_, h) in table.items():
        above = table.get((group, level + 1, place // 3))
        if above:
            assert above[0][64 * (place % 3) :][:64] == h
    assert {r.hash for r in made.root.collect()} == {table[None, 1, 0][1]}
    assert table["=a", 1, 0][0] == "".join(brute.leaf((k, "a", "en", 1, str(k))) for k in (0, 2, 4))

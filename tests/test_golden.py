"""Worked examples of the column functions and operators."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tablemill.functions import chunk, classify, features, normalize, rx, score, vocab
from tablemill.operators import dedup, filters, profile, retention


def column(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(list(enumerate(rows)) if not isinstance(rows[0], tuple) else [(i, *r) for i, r in enumerate(rows)], "i int, " + schema).select("i", expr.alias("x")).orderBy("i").select("x").collect()]


def test_relevance_score(spark):
    rows = [
        ("scheduling", "scheduling optimization", 22, 10), ("operations research", "operations research, integer programming", 19, 9), ("optim", "operations research, linear programming", 6, 7),
        ("analytics", "", 6, 5), ("", "supply chain optimization, demand planning", 2, 3), ("", "operations research", 1, 2), ("", "", 30, 0), (None, None, 3, 0),
    ]
    got = column(spark, [r[:3] for r in rows], "a string, b string, n int", score.relevance_score(F.col("a"), F.col("b"), F.col("n")))
    assert got == [r[3] for r in rows]


def test_frequency_counts_whole_words_once_per_keyword(spark):
    rows = [("optim", "", "Optimization lead", "optimization, MILP and milp; mip maß"), ("", "demand planning", None, "Demand planning demand planning"), ("", "", "x", "demand planning"), ("", "", None, None)]
    got = column(spark, rows, "a string, b string, t string, d string", score.keyword_frequency(F.col("a"), F.col("b"), F.col("t"), F.col("d")))
    assert got == [5, 2, 0, 0]


def test_two_tier_filter(spark):
    rows = [("Optimization Engineer", "uses Gurobi"), ("SEO Optimization Lead", "gurobi"), ("Planner", "MILP and demand planning"), ("Barista", "coffee"), ("", "gurobi"), (None, "gurobi")]
    d = filters.two_tier_detail(F.col("t"), F.col("d"))
    got = column(spark, rows, "t string, d string", d)
    assert [(r.accepted, r.rejected_negative, r.tier1_keywords, r.tier2_keywords) for r in got] == [
        (True, False, ["optim"], ["gurobi"]), (False, True, [], []), (True, False, [], ["milp", "demand planning"]), (False, False, [], []), (False, False, [], []), (False, False, [], []),
    ]
    assert column(spark, rows, "t string, d string", filters.two_tier(F.col("t"), F.col("d"))) == [True, False, True, False, False, False]


def test_levels(spark):
    assert column(spark, [("Director of Analytics", ""), (None, "x"), ("Data Analyst", None)], "t string, d string", classify.extract_level(F.col("t"), F.col("d"))) == ["Executive", "", "Mid-Level"]
    rows = [("", "Sales Director", "Director"), ("", "Project Coordinator", "Executive"), ("Mid-Senior level", "Data Analyst", "Mid-Level"), ("", "International Sales", "Internship"), ("Director", "Intern", "Director"), (None, None, "Mid-Level")]
    assert column(spark, [r[:2] for r in rows], "l string, t string", classify.refine_level(F.col("l"), F.col("t"))) == [r[2] for r in rows]
    values = {"associate": "Not Specified", "Mid-Senior level": "Senior", "NA": "Not Specified", "": "Not Specified", "gibberish": "Not Specified", "Senior Associate": "Associate", None: "Not Specified"}
    assert column(spark, [(v,) for v in values], "v string", classify.standard_level(F.col("v"))) == list(values.values())


def test_job_types(spark):
    rows = [("parttime, fulltime", "", "Full-time"), ("temporary", "", "Contract"), ("volunteer", "", "Full-time"), (None, "6 month contract", "Contract"), (None, "", "Full-time"), (" ", None, "Full-time")]
    assert column(spark, [r[:2] for r in rows], "v string, d string", classify.standard_job_type(F.col("v"), F.col("d"))) == [r[2] for r in rows]


def test_categories_prefer_the_first_of_equals(spark):
    assert column(spark, [("research, analyst", ""), ("", ""), (None, None), ("", "nursing")], "v string, d string", classify.standard_function(F.col("v"), F.col("d"))) == ["Data Science & Analytics", "Other", "Other", "Healthcare"]
    assert column(spark, [("banking", "", "")], "v string, c string, d string", classify.standard_industry(F.col("v"), F.col("c"), F.col("d"))) == ["Finance & Banking"]


def test_education(spark):
    texts = ["PhD or Master's required", "MS Office skills", None, "", "pottery", "A B.S. in biology"]
    assert column(spark, [(t,) for t in texts], "t string", features.education_levels(F.col("t"))) == ["PhD, Master", "NA", "NA", "NA", "NA", "Bachelor"]
    fields = column(spark, [("operations research and statistics",), ("pottery",), (None,)], "t string", features.education_field(F.col("t")))
    assert fields == ["Industrial Engineering, Mathematics and Statistics", "Other Fields", "NA"]


SAMPLES = [
    "PhD, M.Sc. or MBA; ms office", "m.a. position or B.A. degree", "4-year degree; 2 year college degree", "Dr. of Engineering", "high school GED", "maß ma", "visiting scholar, tenure-track", "post doc",
    "R, Python and C#", "scipy.optimize or Ant Colony", "statistical software such as R", "contractor temp", "Ünïcode phd student", "b.s. in business", "",
]


@pytest.mark.parametrize("patterns", [p for t in (vocab.EDUCATION_LEVELS, vocab.EDUCATION_FIELDS, vocab.EDUCATION_FILL) for p in t.values()] + [vocab.RESEARCH_PATTERNS])
def test_patterns_agree_with_python(spark, patterns):
    got = column(spark, [(t,) for t in SAMPLES], "t string", rx.matches(F.col("t"), patterns))
    assert got == [any(re.search(p, t, re.IGNORECASE) for p in patterns) for t in SAMPLES]


def test_tools_and_skills(spark):
    tools = features.tools()
    assert column(spark, [("Python, R and Gurobi",), (None,)], "t string", tools.found_string(F.col("t"))) == ["Gurobi, Python, R", ""]
    net = features.Vocabulary([("C#", "x", [r"\bC\#\b"]), (".NET", "x", [r"\b\.NET\b"])])
    assert column(spark, [("C# dev",), ("ASP.NET",), (".NET dev",)], "t string", net.found_string(F.col("t"))) == ["", ".NET", ""]
    assert tools.category_of("R") == "Programming Languages" and len(tools.names()) == 23


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{"total_skills": 5, "categories": ["A"], "skills": [{"name": "X", "category": "A", "patterns": ["\\\\bx\\\\b", "("]}, {"name": "", "patterns": ["y"]}, {"name": "Z", "category": "A", "patterns": []}]}')
    for v in (features.Vocabulary.load(str(path), "skills"), features.Vocabulary.load(str(path), "skills", spark)):
        assert v.entries == [("X", "A", [r"\bx\b"])] and v.total == 5 and v.categories == ["A"]


def test_normalize(spark):
    cases = {None: "", "&lt;b&gt;hi&lt;/b&gt;": "hi", "A<br>B": "a\nb", "# Title\n- item": "title\nitem", "Apply now please. Next": "next", "": "", "<script>x</script>Y ": "y", "**b** _i_ [t](u) `c`": "b i t c", "a\n\n\n\nb": "a\n\nb"}
    got = column(spark, [(t,) for t in cases], "t string", normalize.normalize_text(F.col("t")))
    assert got == list(cases.values())


def test_chunks(spark):
    of = lambda x: list(chunk.chunks_of(x))
    assert [len(of(x)) for x in (None, "", "a" * 199, "a" * 200, "a" * 3200, "a" * 3201, "a" * 4100)] == [0, 0, 0, 1, 1, 2, 2]
    assert [len(c) for c in of("a" * 3201)] == [2000, 1201] and [len(c) for c in of("a" * 4100)] == [2000, 2100]
    text = "a" * 1000 + ". " + "b" * 3000
    assert [len(c) for c in of(text)] == [1001, 3000]
    df = spark.createDataFrame([(1, text), (2, None), (3, "short")], "id int, t string")
    assert [(r.id, r.chunk_index, len(r.chunk_text)) for r in chunk.explode_chunks(df, "id", "t").orderBy("chunk_index").collect()] == [(1, 0, 1001), (1, 1, 3000)]


def test_chunks_of_a_long_text(spark):
    """The work grows with the length, not with its square: 20 MB are a matter of a second or two."""
    text = "word. and more " * 1_400_000
    began = time.time()
    made = list(chunk.chunks_of(text))
    assert time.time() - began < 10 and sum(map(len, made)) > 0.999 * len(text) - 2 * len(made)


def test_phrases_agree_with_patterns(spark):
    """One pass over a trie finds what a pattern for each phrase finds: overlaps, signs, case, odd letters and white space."""
    rng = random.Random(8)
    phrases = {"A": ["ai", "ai platform", "data"], "B": ["data science", "data science lead", "c++", "c#"], "C": [".net", "net", "science lead"], "D": ["c, c++", "or-tools", "tools", "kiss", "a/b testing"]}
    one = features.Vocabulary.from_phrases({"x": {k: phrases[k] for k in "AC"}, "y": {k: phrases[k] for k in "BD"}})
    plain = features.Vocabulary(one.entries)
    pieces = ["ai", "AI", "platform", "platforms", "data", "Data", "science", "lead", "c++", "C#", ".NET", "asp.net", "c,", "or-tools", "tools", "K\u0131\u017fs", "\u212aiss", "a/b", "testing", "x", "ünï", "c+", "\u0130"]
    gaps = [" ", "  ", "\n", "\u00a0", "", ",", "."]
    texts = [None, "", *("".join(rng.choice(pieces) + rng.choice(gaps) for _ in range(rng.randrange(1, 14))) for _ in range(600))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    forms = lambda v: [v.found(t), v.found_string(t), v.found_categories(t), v.found_with_category(t), v.found_by_category(t)]
    for a, b in zip(forms(one), forms(plain)):
        assert df.select(a.alias("v")).collect() == df.select(b.alias("v")).collect()
    assert features.Vocabulary.from_phrases({}).found(t) is not None and df.select(features.Vocabulary.from_phrases({}).found(t).alias("v")).first().v == []


def test_keyword_counts_agree_with_patterns(spark):
    rng = random.Random(9)
    fixed, known = ["scheduling", "scheduling solver", "mixed integer", "or-tools", "ab ab"], ["optim", "integer programming", "mip", "solver"]
    pieces = ["scheduling", "Solver", "mixed", "integer", "programming", "or-tools", "optim", "optimum", "mip", "ab"]
    rows = [(rng.choice(["", "optim, mip", "solver"]), rng.choice([None, "integer programming"]), rng.choice([None, "Solver mip"]), "".join(rng.choice(pieces) + rng.choice([" ", " ", "  ", "-"]) for _ in range(rng.randrange(25)))) for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b string, title string, d string")
    got = [r[0] for r in df.select(score.keyword_frequency(F.col("a"), F.col("b"), F.col("title"), F.col("d"), fixed, known)).collect()]

    def count(a, b, title, d):
        text = f"{title or ''} {d or ''}".lower()
        own = {x.strip() for x in f"{a or ''},{b or ''}".split(",")} & set(known)
        return sum(len(re.findall(rf"\b{re.escape(k)}\b", text)) for k in {*fixed, *own})

    assert got == [count(*r) for r in rows]


def test_plan_does_not_grow_with_the_vocabulary(spark):
    df = spark.createDataFrame([("we use skill7 and skill 3000",)], "t string")
    size = lambda n: len(df.select(features.Vocabulary.from_phrases({"c": {f"S{k}": [f"skill{k}", f"skill {k}"] for k in range(n)}}).found(F.col("t")))._jdf.queryExecution().analyzed().numberedTreeString().split("\n"))
    assert size(5) == size(2_000)
    many = features.Vocabulary.from_phrases({"c": {f"S{k}": [f"skill{k}", f"skill {k}"] for k in range(4_000)}})
    assert df.select(many.found(F.col("t")).alias("v")).first().v == ["S3000", "S7"]


def test_vocabulary_accessors(spark, tmp_path):
    known = features.skills()
    assert known is features.skills() and known.total == 119 and len(known.names()) == 99 and len(known.categories) == 22
    path = tmp_path / "v.json"
    path.write_text('{"skills": [{"name": "X", "category": "A", "patterns": ["x", "("]}]}')
    with pytest.warns(UserWarning, match="left out"):
        assert features.Vocabulary.load(str(path), "skills").names() == ["X"]


def test_url_flag(spark):
    df = spark.createDataFrame([(i, u, "") for i, u in enumerate(["http://x/", "HTTP://X", "http://y", "", ""])], "i int, url string, company_url string")
    assert [r[0] for r in dedup.flag_shared_urls(df).orderBy("i").select("has_url_duplicate").collect()] == [1, 1, 0, 0, 0]


def test_newest_n(spark):
    df = spark.createDataFrame(list(zip(range(1, 7), "abacbb")), "id int, k string")
    assert sorted(r[0] for r in dedup.newest_duplicates(df, ["k"], newest=6).collect()) == [3, 5, 6]
    assert sorted(r[0] for r in dedup.newest_duplicates(df, ["k"], newest=3).collect()) == [6]
    nulls = spark.createDataFrame([(1, None), (2, None)], "id int, k string")
    assert [r[0] for r in dedup.newest_duplicates(nulls, ["k"]).collect()] == [2]


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1)], "k string, v int, n int")
    assert sorted(map(tuple, dedup.upsert(old, new, "k", ["n"]).select("k", "v").collect())) == [("a", 1), ("b", 4), ("c", 5)]


def test_split_tools(spark):
    df = spark.createDataFrame([(1, "Python, Soft Skills, Gurobi", "Gurobi"), (2, "SQL", None), (3, None, None), (4, "Python", None)], "id int, skills string, tools string")
    got = sorted(map(tuple, features.split_tools(df, vocab.LEGACY_TOOLS).collect()))
    assert got == [(1, "Soft Skills", "Gurobi, Python"), (4, None, "Python")]


def test_retention(spark):
    day = retention.posted_day(F.col("p"))
    old = retention.is_old(day, F.lit("2026-03-01").cast("date"), 30)
    assert column(spark, [("2026-01-01T00:00:00",), ("unknown",), (None,), ("2026-01-30",), ("2026-01-29",), ("2026-99-99",)], "p string", old) == [True, False, False, False, True, False]
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, job_id string")
    jobs = spark.createDataFrame([("a",)], "job_id string")
    assert sorted(r.id for r in retention.orphans(rows, jobs, "job_id").collect()) == [2, 3]


def test_export(spark):
    df = spark.createDataFrame([("1", "", "", None, 7)], "job_id string, company_name string, location string, is_remote int, job_relevance_score int")
    assert filters.export_projection(df).first().asDict() == {"job_id": "1", "company_name": "Unknown", "location": None, "is_remote": False, "job_relevance_score": 7.0}


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert [tuple(r) for r in profile.fill_rate(df, ["a"]).collect()] == [("a", 0, None)]
    assert [tuple(r) for r in profile.distinct_counts(df, ["a", "b"]).orderBy("column").collect()] == [("a", 0), ("b", 0)]
    assert profile.value_distribution(df, "a", 3).collect() == []


@pytest.mark.parametrize("pattern,want", [
    (r"\bph\.?d\.?\b", ["ph"]), (r"\b(physics|chemistry|biology)\b", ["physics", "chemistry", "biology"]), (r"\bm\.?s\.?\b(?!\s*office)", []), (r"\ba|b\b", []),
    (r"\bengineer(ing)?\s+(field|major)\b", ["engineer"]), (r"x{2}yz", ["yz"]), (r"[ab]?cd", ["cd"]), (r"\bR,\s*Python\b", ["python"]),
])
def test_needed_literals(pattern, want):
    assert rx.needed_literals(pattern) == want


def test_every_skill_is_found_by_each_of_its_phrases(spark):
    found = features.skills()
    assert len(found.names()) == 99 and len(found.categories) == 22
    rows = [(n, c, f"we need {p.replace(' ', '  ')} here") for c, names in vocab.SKILLS.items() for n, phrases in names.items() for p in phrases if p[0].isalnum() and p[-1].isalnum()]
    rows += [("C#", "Programming Languages", "C#x"), (".NET", "Backend Development", "asp.net core")]
    df = spark.createDataFrame(rows, "name string, category string, t string")
    t = F.col("t")
    got = df.select("name", "category", "t", found.found(t).alias("n"), found.found_categories(t).alias("c"))
    assert got.filter(~F.array_contains("n", F.col("name")) | ~F.array_contains("c", F.col("category"))).count() == 0
    none = spark.createDataFrame([("we go there, see .net and C# or C",)], "t string")
    assert none.select(found.found(t)).first()[0] == []

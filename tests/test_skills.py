import random

import pytest
from pyspark.sql import functions as F

from jobloom.functions.text import whole_word
from jobloom.operators import skills
from jobloom.session import balance, settings
from jobloom.sources.raw import read_seed


def match(spark, texts, boundary="strict", arrays=None, method="compiled"):
    data = [(i, t, (arrays or {}).get(i)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "id long, t string, a array<string>")
    out = skills.match_terms(df, ["id"], ["t"], ["a"], read_seed(spark, "skill_terms"), boundary, method=method)
    found = {}
    for r in out.collect():
        found.setdefault(r.id, set()).add(r.skill_name)
    return [found.get(i, set()) for i in range(len(texts))]


TEXTS = [
    "JavaScript",
    "Google",
    "Senior C++ dev",
    "C# and .NET",
    "CI/CD",
    "Javañ",
    "python3, React.js; power bi",
    None,
    "_sql SQL_ sql",
    "ReactXjs",
    "K8s",
    "İsql x",
    "\u212a8s ſql",
]
STRICT = [
    {"JavaScript"},
    set(),
    set(),
    set(),
    {"CI/CD"},
    set(),
    {"Python", "React", "Power BI"},
    set(),
    {"SQL"},
    set(),
    set(),
    set(),
    set(),
]


@pytest.mark.parametrize("method", ["compiled", "joined"])
def test_strict(spark, method):
    got = match(spark, TEXTS, method=method)
    assert [g - {"JavaScript"} if i == 6 else g for i, g in enumerate(got)] == STRICT


@pytest.mark.parametrize("method", ["compiled", "joined"])
def test_loose_finds_signs(spark, method):
    got = match(spark, ["Senior C++ dev", "C# and .NET", "C++x"], "loose", method=method)
    assert got == [{"C++"}, {"C#"}, set()]


def test_array_elements_are_matched_one_by_one(spark):
    assert match(spark, [None, None], arrays={0: ["Power", "BI"], 1: ["Power BI", None]}) == [set(), {"Power BI"}]


def test_same_as_pattern_by_pattern(spark):
    """Every text against every pattern by plain regex, on a small fixture."""
    rng = random.Random(7)
    seed = read_seed(spark, "skill_terms").collect()
    words = ["Java", "script", "C++", "C#", "sql", "Server", "Spring", "boot", "ci/cd", "React", ".js", "x", "Go", "on", "Rails", "Ruby", "é", "3", "Python"]
    glue = [" ", "", "-", "/", "_", ", "]
    texts = ["".join(rng.choice(words) + rng.choice(glue) for _ in range(rng.randint(1, 9))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    for boundary in ("strict", "loose"):
        hits = F.array(*[F.when(F.col("t").rlike(whole_word(s.pattern, boundary)), F.lit(s.canonical_name)) for s in seed])
        expected = {r.id: {n for n in r.n if n} for r in df.select("id", hits.alias("n")).collect()}
        for method in ("compiled", "joined"):
            assert match(spark, texts, boundary, method=method) == [expected[i] for i in range(len(texts))]


def test_free_regex_without_anchor(spark):
    terms = spark.createDataFrame([(r"v\d+", "version", "x"), ("a.c", "abc", "y")], "pattern string, canonical_name string, category string")
    df = spark.createDataFrame([(1, "v12 abc"), (2, "v a c"), (3, "xv1")], "id long, t string")
    for method in ("compiled", "joined"):
        out = skills.match_terms(df, ["id"], ["t"], [], terms, method=method)
        assert sorted((r.id, r.skill_name) for r in out.collect()) == [(1, "abc"), (1, "version"), (2, "abc")]


def test_matching_stays_in_the_row(spark):
    df = spark.createDataFrame([(1, "Java")], "id long, t string")
    plan = skills.match_terms(df, ["id"], ["t"], [], read_seed(spark, "skill_terms"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("method", ["compiled", "joined"])
def test_null_and_repeated_ids_and_many_regexes(spark, monkeypatch, method):
    rows = [(None, "power bi and sql"), (1, "sql"), (1, "power bi"), (None, None)]
    terms = [("sql", "SQL", "x"), ("power bi", "Power BI", "x"), *((f"z+{i}x?", f"Z{i}", "x") for i in range(7)), ("bi+", "BI", "x")]
    monkeypatch.setattr(skills, "COMPILED_TERMS", 3)
    df = spark.createDataFrame(rows, "id long, t string")
    words = spark.createDataFrame(terms, "pattern string, canonical_name string, category string")
    out = skills.match_terms(df, ["id"], ["t"], [], words, unique_ids=False, method=method)
    assert sorted((r.id or 0, r.skill_name) for r in out.collect()) == [(0, "BI"), (0, "Power BI"), (0, "SQL"), (1, "BI"), (1, "Power BI"), (1, "SQL")]


def test_token_filter_keeps_every_token_and_few_others(spark):
    known = spark.range(3000).select(F.concat(F.lit("w"), "id").alias("t"))
    asked = spark.range(6000).select("id", F.array(F.concat(F.lit("w"), "id")).alias("ts"))
    kept = asked.where(F.size(F.filter("ts", skills.token_filter(known, "t"))) > 0)
    ids = [r.id for r in kept.select("id").collect()]
    assert set(range(3000)) <= set(ids) and len(ids) < 3000 * 1.3
    none = skills.token_filter(known.limit(0), "t")
    assert asked.where(F.size(F.filter("ts", none)) > 0).count() == 0


def test_large_dictionary_joined_equals_compiled(spark, rows):
    """Words and phrases of a few thousand entries; only anchors leave the rows, and the texts are taken apart once."""
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)] + ["é1", "ſx", "Kelvin"]
    terms = {(rng.choice(vocabulary), f"n{i % 90}", "c") for i in range(250)} | {(" ".join(rng.sample(vocabulary, 2)), f"p{i % 50}", None) for i in range(250)}
    dictionary = spark.createDataFrame(sorted(terms, key=repr), "pattern string, canonical_name string, category string")
    texts = spark.createDataFrame([(i, " ".join(rng.choice(vocabulary).title() if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(60))) for i in range(120)], "id long, t string")
    run = lambda method: skills.match_terms(texts, ["id"], ["t"], [], dictionary, method=method)
    assert rows(run("joined")) == rows(run("compiled")) != []


def test_phrases_are_sought_in_any_case_and_checked_as_words(spark):
    dictionary = spark.createDataFrame([("Google Cloud", "GC", "c"), (r"Node\.js", "Node", "c"), ("Go", "Go", "c"), (r"v\d+ beta", "Beta", "c")], "pattern string, canonical_name string, category string")
    texts = ["GOOGLE cloud", "a Google CloudX", "google\ncloud", "İ NODE.JS, go", "nodeXjs", "V12 BETA", "google Cloud2 Google Cloud", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    pairs = skills.match_terms(rows, ["id"], ["text"], [], dictionary, method="compiled")
    assert sorted((r.id, r.skill_name) for r in pairs.collect()) == [(0, "GC"), (3, "Go"), (3, "Node"), (5, "Beta"), (6, "GC")]
    assert "array_intersect" not in pairs._jdf.queryExecution().optimizedPlan().toString()  # it would build its set for each row


def test_balance_asks_for_several_tasks_a_core(spark):
    keys = ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum")
    with settings(spark, {keys[0]: "3"}):
        before = spark.conf.get(keys[1], None)
        balance(spark)
        assert spark.conf.get(keys[0]) == "3"
        assert int(spark.conf.get(keys[1])) == int(before or 4 * spark.sparkContext.defaultParallelism)

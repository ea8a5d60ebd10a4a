"""Dictionaries and vocabularies that are tables: the same results as the folded forms."""

import random

import pytest
from pyspark.sql import functions as F

from checks import inputs
from checks import queries as Q
from postloom.functions import places, skills
from postloom.functions import wordlists as W
from postloom.functions.regex import by_spelling
from postloom.operators import substring_index, term_trie
from postloom.plans.specs import SOURCES
from postloom.plans.standardize import standardize
from tests.conftest import tables


def chain(text, listed):
    """Value of the first key in order of priority that occurs."""
    return next((v for k, v, _ in sorted(listed, key=lambda e: (e[2], e[0])) if k and k in text), None)


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_hundred_thousand_keys_give_the_result_of_the_chain(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(substring_index, "BROADCAST_KEYS", -1)
    rng = random.Random(3)
    letters = "abcdefghiklmnoprstué٣ "
    key = lambda n: "".join(rng.choice(letters) for _ in range(n))
    listed = {key(rng.choice([3, 4, 5, 6, 9])): None for _ in range(100_000)}
    listed |= dict.fromkeys(["a", "é", "zz", "sto", "漢字", "a.b", "%_", "\\E"])
    listed = [(k, f"value {rng.randrange(50_000)}", rng.randrange(30_000)) for k in listed]
    texts = [key(rng.randint(0, 40)) for _ in range(150)] + [
        "", "z", "zz", "漢字", "x a.b", "xa.b", "100%_", "\\E", "st", "\n\n", None]
    texts += texts[:20]
    dictionary = spark.createDataFrame(
        [*listed, ("", "never", 0), (None, "never", 0)], "key string, value string, priority long")
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.v for r in substring_index.with_first_values(
        rows, dictionary, v=F.col("t")).collect()}
    by_order = sorted(listed, key=lambda e: (e[2], e[0]))
    assert got == {i: None if t is None else next((v for k, v, _ in by_order if k in t), None)
                   for i, t in enumerate(texts)}
    assert sum(v is not None for v in got.values()) > 100


def test_a_key_that_is_listed_twice_counts_where_it_comes_first(spark):
    dictionary = spark.createDataFrame(
        [("riy", "late", 9), ("riy", "first", 2), ("yad", "between", 5), ("adh", "tie b", 2)],
        "key string, value string, priority long")
    rows = spark.createDataFrame([(1, "riyadh"), (2, "yad")], "i int, t string")
    got = substring_index.with_first_values(rows, dictionary, v=F.col("t")).orderBy("i").collect()
    assert [r.v for r in got] == ["tie b", "between"]  # equal priority: the smaller key
    none = substring_index.with_first_values(rows, dictionary.limit(0), v=F.col("t"))
    assert [r.v for r in none.collect()] == [None, None]
    assert substring_index.with_first_values(rows.limit(0), dictionary, v=F.col("t")).count() == 0


def test_the_built_in_spellings_as_a_table_equal_the_chain(spark):
    rng = random.Random(5)
    parts = [*by_spelling(W.CITY_SPELLINGS), *W.JOB_PLATFORMS, "x", " • ", "SA", ", "]
    texts = ["".join(rng.choice(parts).title() for _ in range(rng.randint(0, 4))) for _ in range(400)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    cities = places.city_dictionary(spark)
    both = places.with_city(rows, "found", cities, F.col("t")).withColumn(
        "chain", places.clean_city(F.col("t")))
    assert both.where("not (found <=> chain)").count() == 0
    assert both.where("found is not null").count() > 50


def noisy_texts(seed, n=400):
    rng = random.Random(seed)
    words = ["sql", "server", "SQL", "asp", ".net", "net", "core", "c#", "c++", "python", "react",
             "big", "data", "lake", "machine", "learning", "zero", "trust", "architecture", "ci/cd",
             "node.js", "docker-compose", "x", "go", "t-sql", "ui", "golang", "ك", "top", "10", "é"]
    joins = [" ", "  ", "-", ".", "/", "+", "#", ", ", "", "\n", "("]
    return ["".join(rng.choice(words) + rng.choice(joins) for _ in range(25)) for _ in range(n)]


@pytest.mark.parametrize("versions", [False, True])
@pytest.mark.parametrize("broadcast", [True, False])
def test_a_vocabulary_table_finds_what_the_pattern_finds(spark, monkeypatch, versions, broadcast):
    if not broadcast:
        monkeypatch.setattr(term_trie, "BROADCAST_NODES", -1)
    extra = ["c#", ".net", "c++", "big data lake", "top 10", "core", "é", "ui/x", "-x", "x-", "lake.",
             "big data/", "big data lake#", "machine learning/", ".net core", "++#", "/x/", "c#/"]
    folded = skills.SkillVocabulary((*skills.STARTER.terms, *extra))
    listed = spark.createDataFrame([(f" {t.upper()}",) for t in folded.terms] + [("",), (None,)],
                                   "term string")
    as_table = skills.SkillTable(listed)
    if versions:
        folded, as_table = folded.versioned(), as_table.versioned()
    rows = spark.createDataFrame(
        list(enumerate([*noisy_texts(9), "", None, "spring boot 2.7 python3"])), "i int, v string")
    both = skills.with_skills(rows, F.col("v"), as_table, "joined")
    both = skills.with_skills(both, F.col("v"), folded, "folded")
    assert both.where("not (joined <=> folded)").collect() == []
    assert both.count() == 403 and both.where("size(joined) > 2").count() > 300


def test_no_terms_and_many_terms(spark):
    rows = spark.createDataFrame([(1, "uses amazon web services"), (2, None)], "i int, v string")
    none = skills.SkillTable(spark.createDataFrame([], "term string"))
    assert [list(r.skills) for r in skills.with_skills(rows, F.col("v"), none).orderBy("i").collect()
            ] == [[], []]
    many = spark.range(60_000).select(F.concat(F.lit("tool"), F.col("id")).alias("term"))
    with pytest.raises(ValueError):
        skills.SkillVocabulary.from_table(many)
    text = spark.createDataFrame([(1, "tool59999, tool60000 and tool7-tool8")], "i int, v string")
    found = skills.with_skills(text, F.col("v"), skills.SkillTable(many)).first()
    assert found.skills == ["tool59999", "tool7", "tool8"]


@pytest.mark.parametrize("source", ["tapneo", "freehire", "tanqeeb", "jsearch"])
def test_sources_are_standardised_the_same_way_with_tables(spark, source):
    raw = Q.raw_records(spark, tables(), source)
    terms = spark.createDataFrame([(t,) for t in skills.STARTER.terms], "term string")
    folded = standardize(raw, SOURCES[source], Q.AS_OF)
    joined = standardize(raw, SOURCES[source], Q.AS_OF, skills.SkillTable(terms),
                         cities=places.city_dictionary(spark))
    assert joined.columns == folded.columns
    assert sorted(map(str, joined.collect())) == sorted(map(str, folded.collect()))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    # terms that neither the fixed lists nor the postings of the checks name
    fixed = str([v for n, v in vars(W).items() if n.isupper() and n != "STARTER_SKILLS"])
    fixed += inputs.POSTINGS.lower() + "scikit-learn"
    own = [t for t in skills.STARTER.terms if len(t) > 7 and t not in fixed]
    assert own and not any(t in plan for t in own)


def test_contexts_equal_a_search_in_the_text(spark):
    import re

    texts = noisy_texts(2, 150) + ["python " * 700, "", None, "go go go", "ağ C# c#x"]
    terms = ["sql", "c#", ".net", "big data", "go", "ci/cd", "go go", "é", "x", "c", "t-sql"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    got = {r.i: r.c or {} for r in rows.select("i", skills.skill_contexts(
        F.col("v"), F.array(*map(F.lit, terms)), 7).alias("c")).collect()}
    for i, text in enumerate(texts):
        expected, low = {}, (text or "").lower()
        for term in terms:
            found = [text[max(0, m.start() - 7):m.end() + 7].strip()
                     for m in re.finditer(rf"\b{re.escape(term)}\b", low)]
            if found:
                expected[term] = found
        assert got[i] == expected, text


def test_the_index_has_one_row_a_key_however_many_words_hold_it(spark, monkeypatch):
    kept = []

    def counting(df, cut=substring_index.cut_lineage):
        kept.append((done := cut(df)).count())
        return done

    monkeypatch.setattr(substring_index, "cut_lineage", counting)
    texts = [f"w{i}a b{i} c" for i in range(300)] + ["a  b", "b a", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    hashed = substring_index.hashed_texts(rows, F.col("t"))
    keys = spark.createDataFrame([("a b",), ("a  b",)], "key string")
    found = substring_index.substring_keys(hashed, keys).groupBy("key").count().collect()
    assert {r["key"]: r["count"] for r in found} == {"a b": 300, "a  b": 1}
    assert max(kept) <= 2

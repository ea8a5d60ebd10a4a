import random
import re

from pyspark.sql import functions as F

from postloom.functions import skills as S
from postloom.operators.vocabulary import match_terms


def test_examples(evaluate):
    values = [
        "sql server", "asp.net core", "c# dev", "golang", "full-stack full stack",
        "business intelligence", "php و", "phpو", "c#x", "x.net", "", None, "²sql sql2 sql"]
    assert evaluate(values, S.extract_skills) == [
        ["sql", "sql server"], ["aspnet", "aspnet core", "net"], [], ["go", "golang"],
        ["full stack"], ["bi", "business intelligence"], ["php"], [], ["c#"], ["net"], [], [],
        ["sql"]]


def test_starter_vocabulary_is_whole(evaluate):
    values = [
        "cassandra, jenkins", "data quality in snowflake", "tcp/ip and siem", "xml json ruby",
        "large language model", "tableau", "elixir linux"]
    assert evaluate(values, S.extract_skills) == [
        ["cassandra", "jenkins"], ["data quality", "snowflake"], ["siem", "tcp/ip"],
        ["json", "ruby", "xml"], ["large language model"], ["tableau"], ["elixir", "linux"]]
    assert len(S.STARTER.terms) == 150


def test_normalize(evaluate):
    assert evaluate(["Node.js", "scikit-learn", "(AWS)", " A  b.", None], S.normalize_skill) == [
        "node.js", "scikit learn", "aws", "a b", ""]
    assert evaluate(["scikit-learn"], lambda c: S.normalize_skill(c, True)) == ["scikit-learn"]


def test_versioned(evaluate):
    vocabulary = S.STARTER.versioned()
    values = ["python3.11", "data lake", "spring boot 2", "asp.net core 6", "docker-compose"]
    assert evaluate(values, lambda c: S.extract_skills(c, vocabulary)) == [
        ["python"], ["data lake"], ["spring", "spring boot"], ["aspnet", "aspnet core", "net"],
        ["docker", "docker-compose"]]
    assert evaluate(["python3.11"], S.extract_skills) == [[]]


def test_union(evaluate):
    union = lambda c: S.union_skills(
        F.array(F.lit("Node.js"), F.lit("SQL"), c), F.array(F.lit("sql"), F.lit("aws")))
    assert evaluate(["(x)", "", None], union) == [
        ["aws", "node.js", "sql", "x"]] + [["aws", "node.js", "sql"]] * 2
    nothing = lambda c: S.union_skills(F.lit(None).cast("array<string>"), F.array(c))
    assert evaluate(["sql"], nothing) == [["sql"]]


def test_contexts_overlap_and_clip(evaluate):
    text = "I like Python and python is what I know; mypython no"
    context = lambda c: S.skill_contexts(c, F.array(F.lit("python"), F.lit("aspnet")), 10)
    assert evaluate([text], context) == [
        {"python": ["I like Python and pytho", "ython and python is what I"]}]


def per_term(text, terms):
    """Brute force: one search per term."""
    text = re.sub(r"\s+", " ", re.sub(r"[^\w\s\-\.\/\+#]", " ", text.lower()))
    return {t for t in terms if re.search(r"\b" + re.escape(t) + r"\b", text)}, text


def test_scan_equals_search_per_term(spark):
    rng = random.Random(7)
    words = ["sql", "server", "asp.net", ".net", "core", "c#", "c++", "microsoft", "zero",
             "trust", "architecture", "ci/cd", "node.js", "docker-compose", "مهندس", "x", "go",
             "t-sql", "pl/sql", "ui", "owasp", "top", "10", "é", "framework"]
    joins = [" ", "  ", "-", ".", "/", "+", "#", ", ", "", "\n", "ّ", "²", "("]
    texts = ["".join(rng.choice(words) + rng.choice(joins) for _ in range(30)) for _ in range(600)]
    # only the vocabulary scan is compared: take out aliases, compounds and tidying
    from postloom.functions.regex import let, whole_word_scans

    terms = S.STARTER.terms
    scans = whole_word_scans(terms, " " + S._SEPARATORS)
    implied = {}
    for term in terms:
        inside = sorted(o for o in terms if S._starts_with_word(term, o))
        if inside != [term]:
            implied[term] = inside
    found = let(S.skill_text(F.col("v")), lambda t: S._expand(F.array_distinct(F.concat(
        *[F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in scans])), implied))
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    for row in rows.select("v", found.alias("found")).collect():
        expected, _ = per_term(row["v"], terms)
        assert set(row["found"]) == expected, row["v"]


def test_vocabulary_join_equals_search_per_term(spark):
    rng = random.Random(11)
    terms = ["sql server", "sql", ".net", "c#", "c++", "asp.net", "ci/cd", "big data lake", "é"]
    parts = ["sql", "server", ".net", "c#", "c++", "asp", "ci/cd", "big", "data", "lake", "é", "x"]
    joins = [" ", "", "-", ", ", ".", "#"]
    texts = ["".join(rng.choice(parts) + rng.choice(joins) for _ in range(15)) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    vocabulary = spark.createDataFrame([(t,) for t in terms], "term string")
    found = match_terms(rows, "i", "v", vocabulary).collect()
    expected = {(i, t) for i, text in enumerate(texts) for t in per_term(text, terms)[0]}
    assert {(r["i"], r["term"]) for r in found} == expected
    assert len(found) == len(expected)


def test_vocabulary_is_a_parameter(spark, evaluate):
    table = spark.createDataFrame([(" Cobol ",), ("RPG IV",), ("",), (None,)], "term string")
    vocabulary = S.SkillVocabulary.from_table(table)
    assert vocabulary.terms == ("cobol", "rpg iv")
    assert evaluate(["COBOL and rpg iv; sql"], lambda c: S.extract_skills(c, vocabulary)) == [
        ["cobol", "rpg iv"]]


def test_stop_words_and_numbers_are_no_skills(evaluate):
    vocabulary = S.SkillVocabulary(("team", "365", "r", "office 365"))
    assert evaluate(["team 365 r office 365"], lambda c: S.extract_skills(c, vocabulary)) == [
        ["office 365"]]


def test_vocabulary_of_many_terms(spark, evaluate):
    """No cap: 25,000 terms through the scan find what a search per term finds."""
    terms = [f"{a}{n} {b}" if n % 5 == 0 else f"{a}{n}" for n in range(12_500)
             for a, b in (("tool", "pro"), ("lib", "lite"))]
    vocabulary = S.SkillVocabulary.from_table(
        spark.createDataFrame([(t,) for t in terms], "term string"))
    assert len(vocabulary.terms) == 25_000
    body = "tool5 pro lib7 tool12499 lib10 tool12500 xlib8 lib12495 lite."
    known = {t for t in terms if re.search(rf"(?<!\w){re.escape(t)}(?!\w)", body)}
    assert evaluate([body], lambda c: S.extract_skills(c, vocabulary)) == [sorted(known)]


def test_vocabulary_join_finds_terms_of_any_number_of_words(spark):
    rows = spark.createDataFrame([(1, "uses amazon web services daily")], "i int, v string")
    terms = spark.createDataFrame([("amazon web services",), ("uses",)], "term string")
    assert sorted(r.term for r in match_terms(rows, "i", "v", terms).collect()) == [
        "amazon web services", "uses"]
    none = spark.createDataFrame([], "term string")
    assert match_terms(rows, "i", "v", none).count() == 0


def test_terms_of_any_length_cost_no_further_scans(spark):
    texts = spark.createDataFrame([(1, "one two, three four"), (2, "one two three"), (3, None)], "i int, t string")
    terms = spark.createDataFrame([("one two three",), ("four",), ("two ",), ("#",)], "term string")

    def scans(listed):
        plan = match_terms(texts, "i", "t", listed)._jdf.queryExecution().analyzed().toString()
        return plan.count("regexp_extract_all")

    assert {(r.i, r.term) for r in match_terms(texts, "i", "t", terms).collect()} == {
        (1, "one two three"), (1, "four"), (2, "one two three")}
    long = spark.createDataFrame([(" ".join(["one"] * 9),)], "term string")
    assert scans(long) <= scans(terms) <= 4

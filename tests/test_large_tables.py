"""Dictionaries and vocabularies beyond the size of a broadcast: the whole result, few rows shuffled."""

import random
import re

import pytest
from pyspark.sql import functions as F

from checks import queries as Q
from postloom.functions import places, skills
from postloom.operators import hash_bits, substring_index, term_trie
from postloom.operators.vocabulary import match_terms
from postloom.plans.specs import SOURCES
from postloom.plans.standardize import standardize


@pytest.mark.parametrize("max_bits", [hash_bits.MAX_BITS, 64])
def test_bits_drop_no_key(spark, monkeypatch, max_bits):
    monkeypatch.setattr(hash_bits, "MIN_BITS", 64)
    monkeypatch.setattr(hash_bits, "MAX_BITS", max_bits)
    numbers = spark.range(40_000).select(F.concat(F.lit("key "), "id").alias("key"))
    keys = numbers.where("key like '%7'")
    bits = hash_bits.HashBits(keys, "key", 4_000)
    passed = numbers.where(bits.may_hold(F.col("key")))
    assert passed.where("key like '%7'").count() == 4_000
    assert passed.count() < 5_000 or max_bits == 64
    assert hash_bits.meet(numbers, keys, "key", 4_000, -1).count() == 4_000
    none = hash_bits.HashBits(keys.limit(0), "key", 0)
    assert numbers.where(none.may_hold(F.col("key"))).count() == 0


def test_places_of_texts_meet_a_large_tree_in_one_join(spark, monkeypatch):
    monkeypatch.setattr(term_trie, "BROADCAST_NODES", -1)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 80))) for _ in range(120)]
    pieces = [t.split(" ") for t in texts if t]
    terms = {" ".join(p[i:i + n]) for p in pieces for n in (1, 2, 3, 4, 6)
             for i in (rng.randrange(len(p)),)} | {"never seen", "w1 w2 never seen"}
    rows = spark.createDataFrame(list(enumerate([*texts, texts[0], None])), "i int, t string")
    table = spark.createDataFrame([(t,) for t in sorted(terms)], "term string")
    got = match_terms(rows, "i", "t", table)
    expected = {(i, term) for i, t in enumerate([*texts, texts[0]]) for term in terms
                if re.search(rf"(?<!\w){term}(?!\w)", t)}
    listed = [tuple(r) for r in got.collect()]
    assert len(listed) == len(set(listed)) and set(listed) == expected
    # one join with the terms, whatever the number of words, and one with the rows
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2


def chain(text, listed):
    """Value of the first key in order of priority that occurs."""
    return next((v for k, v, _ in sorted(listed, key=lambda e: (e[2], e[0])) if k in text), None)


@pytest.mark.parametrize("broadcast", [-1, 40, 1_000_000])
@pytest.mark.parametrize("head", [1, 30])
def test_kinds_of_keys_in_turn_give_the_first_key(spark, monkeypatch, broadcast, head):
    monkeypatch.setattr(substring_index, "BROADCAST_KEYS", broadcast)
    monkeypatch.setattr(substring_index, "HEAD", head)
    rng = random.Random(11)
    syllables = ["an", "on", "the", "re", "é", "漢", "st", "qu", "x9"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    gap = lambda: rng.choice([" ", " ", " ", "  ", "\n", "　"])

    def text(n):
        return "".join(word() + gap() for _ in range(n))[:-1]

    texts = [text(rng.randint(0, 12)) for _ in range(250)] + [" ", "", "the", "an  on", None]
    whole = " ".join(t for t in texts if t)
    cuts = [whole[at:at + rng.randint(5, 30)] for at in range(0, len(whole) - 40, 29)]
    keys = {*cuts, *(text(n) for n in (1, 1, 2, 2, 3, 3) for _ in range(80)), "　", " an", "on "} - {""}
    # rare kinds first or last, equal priorities, and a value that several keys have
    listed = [(k, f"value {i % 300}", rng.choice([5, 900, rng.randrange(1000)])) for i, k in enumerate(sorted(keys))]
    dictionary = spark.createDataFrame(listed, "key string, value string, priority long")
    rows = spark.createDataFrame(list(enumerate([*texts, *texts[:9]])), "i int, t string")
    got = {r.i: r.v for r in substring_index.with_first_values(rows, dictionary, v=F.col("t")).collect()}
    assert got == {i: None if t is None else chain(t, listed) for i, t in enumerate([*texts, *texts[:9]])}
    assert sum(v is not None for v in got.values()) > 150


def test_a_word_counts_with_its_first_key_only(spark, monkeypatch):
    kept = []

    def counting(df, cut=substring_index.cut_lineage):
        kept.append((done := cut(df)).count())
        return done

    monkeypatch.setattr(substring_index, "cut_lineage", counting)
    monkeypatch.setattr(substring_index, "HEAD", 1, raising=False)
    letters = "abcdefghijklmnopqrst"
    listed = [(letters[:n], f"value {n}", 100 - n) for n in range(1, 20)] + [("never", "never", 0)]
    dictionary = spark.createDataFrame(listed, "key string, value string, priority long")
    rows = spark.createDataFrame([(i, f"w{i}{letters}{i}") for i in range(200)], "i int, t string")
    got = substring_index.with_first_values(rows, dictionary, v=F.col("t")).collect()
    assert {r.v for r in got} == {"value 19"} and len(got) == 200
    # no table has a row for each pair of a word and a key, of which there are 3,800
    assert max(kept) <= 200


def test_texts_stay_out_of_the_joins_with_what_was_found_in_them(spark):
    rows = spark.createDataFrame(
        [(1, "Riyadh", "x"), (2, "LinkedIn Riyadh", "near JEDDAH"), (3, None, "LinkedIn Tabuk")],
        "i int, place string, body string")
    found = places.with_city(rows, "city", places.city_dictionary(spark), F.col("place"), F.col("body"))
    assert sorted(tuple(r) for r in found.select("i", "city").collect()) == [
        (1, "Riyadh"), (2, "Jeddah"), (3, None)]
    above = found.select("i", "city")._jdf.queryExecution().optimizedPlan().toString().split("Join ")[0]
    assert "linkedin" not in above and "body" not in above


def test_rows_are_kept_once_before_their_skills_are_looked_up(spark):
    raw = spark.createDataFrame(
        [(1, "Data Engineer", "ACME", "Riyadh", "We use python and spark in a team that builds data platforms for all."),
         (2, "Data Engineer", "ACME", "Riyadh", "We use python and spark in a team that builds data platforms for all.")],
        "record_no int, job_title string, company_name string, location string, job_description string")
    raw = raw.withColumn("source_url", F.lit("https://x.example.com/1"))
    terms = skills.SkillTable(spark.createDataFrame([("python",), ("spark",)], "term string"))
    staged = standardize(raw, SOURCES["freehire"], Q.AS_OF, terms, cities=places.city_dictionary(spark))
    assert [(r.city, list(r.skills)) for r in staged.collect()] == [("Riyadh", ["python", "spark"])]
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "__raw_description" not in plan


def test_a_gram_that_all_pieces_share_does_not_hide_their_own(spark, monkeypatch):
    monkeypatch.setattr(substring_index, "COMMON", 3, raising=False)
    monkeypatch.setattr(substring_index, "HEAD", 1, raising=False)
    listed = [(f"customer#{i:06}", f"c{i}", i) for i in range(300)] + [("customer#000", "any", 900)]
    dictionary = spark.createDataFrame(listed, "key string, value string, priority long")
    texts = [f"by customer#{i:06}. and customer#000298" for i in (0, 7, 299)] + ["customer#0009", "customer#"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = substring_index.with_first_values(rows, dictionary, v=F.col("t")).orderBy("i").collect()
    assert [r.v for r in got] == ["c0", "c7", "c298", "any", None]

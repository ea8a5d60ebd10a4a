"""Skill extraction with a vocabulary.

The vocabulary is a parameter: any table with one term per row.  Its terms are
folded into one zero-width pattern (:func:`whole_word_scans`), so a text is read
once whatever the number of terms.  Terms that grow with the data are matched by
a join instead, see :mod:`postloom.operators.vocabulary`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import wordlists as W
from postloom.functions.arrays import running_starts
from postloom.functions.regex import (
    SPACE, WORD, is_word_char, let, listed_words, strip, whole_word_scans, word_array, word_map,
)
from postloom.operators.substring_index import HASH, hashed_texts, text_hash
from postloom.operators.term_trie import build_trie, tokens, trie_reports

_FIRST_TOKEN = rf"(?s)\A(?:[{WORD}]+|[^{WORD}])"
_SEPARATORS = r"\-./+#"


@dataclass(frozen=True)
class SkillVocabulary:
    """Terms to look for, and the options of the versioned extractor."""

    terms: tuple[str, ...]
    keep_dash: bool = False
    versions: bool = False

    @classmethod
    def from_table(
        cls, table: DataFrame, column: str = "term", max_terms: int = 50_000, **options,
    ) -> SkillVocabulary:
        """Vocabulary from a table of at most ``max_terms`` terms, which become part of the plan.

        A larger table is an error: it stays a table, see :class:`SkillTable`.
        """
        rows = tidy_terms(table, column).limit(max_terms + 1).collect()
        if len(rows) > max_terms:
            raise ValueError(f"more than {max_terms} terms: use SkillTable")
        return cls(tuple(sorted(r.term for r in rows)), **options)

    def versioned(self) -> SkillVocabulary:
        """The variant that keeps dashes and knows names with version numbers."""
        terms = tuple(dict.fromkeys((*self.terms, *W.VERSIONED_EXTRA_SKILLS)))
        return replace(self, terms=terms, keep_dash=True, versions=True)


@dataclass(frozen=True)
class SkillTable:
    """A vocabulary that stays a table (column ``term``) of any size.

    Texts meet it by joins, see :func:`with_skills`; results are those of a
    :class:`SkillVocabulary` of the same terms and options.
    """

    table: DataFrame
    keep_dash: bool = False
    versions: bool = False

    def versioned(self) -> SkillTable:
        return replace(self, keep_dash=True, versions=True)

    def spellings(self) -> DataFrame:
        """(term, report): every spelling to look for, and the skill it stands for."""
        terms = tidy_terms(self.table)
        if self.versions:
            terms = terms.unionByName(_listed(terms, "term", W.VERSIONED_EXTRA_SKILLS)).distinct()
        own = terms.select("term", F.col("term").alias("report"))
        known = word_map(W.SKILL_ALIASES)
        aliases = _listed(terms, "term", W.SKILL_ALIASES)
        return own.unionByName(aliases.select("term", F.try_element_at(known, "term").alias("report")))


def tidy_terms(table: DataFrame, column: str = "term") -> DataFrame:
    return table.select(F.lower(strip(F.col(column))).alias("term")).where("term <> ''").distinct()


def _listed(like: DataFrame, name: str, words) -> DataFrame:
    return like.sparkSession.range(1).select(F.explode(word_array(words)).alias(name))


STARTER = SkillVocabulary(tuple(W.STARTER_SKILLS))


def normalize_skill(skill: Column, keep_dash: bool = False) -> Column:
    """One spelling per skill: lower case, no brackets or dots, fixed corrections."""
    text = F.translate(strip(F.lower(skill)), "()[]{}<>.", "")
    text = strip(F.regexp_replace(text, f"[{SPACE}]+", " "))
    if not keep_dash:
        text = F.translate(text, "-", " ")
    for wrong, right in W.SKILL_CORRECTIONS:
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return F.coalesce(text, F.lit(""))


def skill_text(text: Column) -> Column:
    """Lower-case text in which only word characters and ``- . / + #`` remain."""
    kept = rf"{WORD}{_SEPARATORS}"
    # runs that are one blank already stay as they are
    return F.regexp_replace(F.lower(text), f"[^{kept} ][^{kept}]*+| [^{kept}]++", " ")


def _starts_with_word(longer: str, word: str) -> bool:
    """``word`` opens ``longer`` and ends there at a word boundary."""
    if not longer.startswith(word):
        return False
    return len(longer) == len(word) or (
        is_word_char(word[-1]) != is_word_char(longer[len(word)]))


def implied_skills(terms: tuple[str, ...]) -> dict[str, list[str]]:
    """Scanned spelling -> what it reports, where that is not just the spelling.

    The scan yields the longest spelling at each position; shorter spellings that
    open it ("sql" in "sql server") are reported as well, and aliases report the
    skill they stand for.
    """
    own = {t: [t] for t in terms}
    for spelling, skill in W.SKILL_ALIASES.items():
        own.setdefault(spelling, []).append(skill)
    result = {}
    for spelling in own:
        openings = [spelling[:n] for n in range(1, len(spelling) + 1)]
        reported = [
            skill for other in openings
            if other in own and _starts_with_word(spelling, other) for skill in own[other]
        ]
        if reported != [spelling]:
            result[spelling] = sorted(set(reported))
    return result


def _expand(found: Column, table: dict[str, list[str]]) -> Column:
    known = word_map({spelling: "\x03".join(names) for spelling, names in table.items()})
    return F.flatten(F.transform(
        found, lambda s: F.coalesce(F.split(F.try_element_at(known, s), "\x03"), F.array(s))))


def tidy_skills(skills: Column, keep_dash: bool = False) -> Column:
    """Normalised, distinct, sorted skills without stop words and bare numbers."""
    normal = F.array_distinct(
        F.transform(F.array_distinct(skills), lambda s: normalize_skill(s, keep_dash)))
    useful = F.filter(normal, lambda s: (F.length(s) > 1) & ~s.rlike(r"\A\p{Nd}+\z"))
    return F.array_sort(F.array_except(useful, word_array(W.SKILL_STOP_WORDS)))


def extract_skills(text: Column, vocabulary: SkillVocabulary = STARTER) -> Column:
    """Sorted distinct skills named in the text."""
    spellings = tuple(dict.fromkeys((*vocabulary.terms, *W.SKILL_ALIASES)))
    scans = whole_word_scans(spellings, " " + _SEPARATORS)
    implied = implied_skills(vocabulary.terms)

    def scan(t: Column) -> Column:
        words = F.concat(*[F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in scans])
        return F.concat(
            _expand(F.array_distinct(words), implied), _compounds(t, vocabulary.versions))

    skills = tidy_skills(let(skill_text(text), scan), vocabulary.keep_dash)
    return F.coalesce(skills, F.array().cast("array<string>"))


def _compounds(t: Column, versions: bool) -> Column:
    """Fixed phrases and, if asked for, names with version numbers in a skill text."""
    parts = [
        listed_words(t, W.COMPOUND_PHRASES),
        F.array(*[_first_spelling(t, v) for v in W.COMPOUND_VARIANTS]),
    ]
    if versions:
        parts += [_with_version(t, p) for p in W.VERSION_PATTERNS]
    return F.concat(*parts)


def _first_spelling(t: Column, pattern: str) -> Column:
    """The first match of a pattern that opens with a plain word, or ''; other texts are not scanned."""
    opening = pattern[:pattern.index("[")]
    return F.when(t.contains(opening), F.regexp_extract(t, pattern, 0)).otherwise("")


def _with_version(t: Column, pattern: str) -> Column:
    """All that a version pattern finds; texts without any of its names are not scanned."""
    names = pattern[pattern.index("(") + 1:pattern.index(")")].split("|")
    named = reduce(or_, [t.contains(n.lstrip(".")) for n in names])
    return F.when(named, F.regexp_extract_all(t, F.lit(pattern), F.lit(1))).otherwise(
        F.array().cast("array<string>"))


def with_skills(
    df: DataFrame, text: Column, vocabulary: SkillVocabulary | SkillTable, name: str = "skills",
) -> DataFrame:
    """``df`` with the sorted distinct skills named in a text, for either kind of vocabulary.

    With a :class:`SkillTable`, the texts meet the terms in a prefix tree
    (:mod:`postloom.operators.term_trie`), and what they report meets the rows by hash.
    """
    if isinstance(vocabulary, SkillVocabulary):
        return df.withColumn(name, extract_skills(text, vocabulary))
    plain = skill_text(text)
    found = trie_reports(hashed_texts(df, plain), build_trie(vocabulary.spellings()))
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    none = F.array().cast("array<string>")
    # all that the text is needed for comes before the join, so only its hash is shuffled
    hashed = df.select(*kept, plain.alias("__plain")).select(
        *kept, *text_hash(F.col("__plain")),
        _compounds(F.col("__plain"), vocabulary.versions).alias("__compounds"))
    skills = tidy_skills(F.concat(
        F.coalesce("reports", none), F.coalesce("__compounds", none)), vocabulary.keep_dash)
    return hashed.join(found, HASH, "left").withColumn(name, F.coalesce(skills, none)).drop(
        "__compounds", "reports", *HASH)


def union_skills(given: Column, extracted: Column) -> Column:
    """Skills given by the source and extracted ones, in one spelling."""
    both = F.array_union(F.coalesce(given, F.array().cast("array<string>")), extracted)
    both = F.filter(both, lambda s: s.isNotNull() & (s != ""))
    normal = F.array_distinct(F.transform(both, lambda s: normalize_skill(s)))
    return F.array_sort(F.filter(normal, lambda s: s != ""))


def skill_contexts(text: Column, skills: Column, window: int = 50) -> Column:
    """Map skill -> the text around each of its occurrences.

    One constant pattern cuts the text into tokens with their offsets; a skill is looked for
    where its first token stands, as a literal between word boundaries. Occurrences of a
    skill do not overlap, their windows may. A skill whose normalised spelling does not occur
    in the text has no entry.
    """
    is_word = rf"\A[{WORD}]"

    def around(skill: Column, original: Column, lowered: Column, places: Column) -> Column:
        width, first = F.length(skill), F.regexp_extract(skill, _FIRST_TOKEN, 0)
        # an end that is a mark needs a word character beyond it, a word end must have none
        starts_bare, ends_bare = ~skill.rlike(is_word), ~skill.rlike(rf"[{WORD}]\z")

        def is_whole(p: Column) -> Column:
            before = F.when(p["at"] > 0, F.substring(lowered, p["at"], F.lit(1))).otherwise("")
            after = F.substring(lowered, p["at"] + width + 1, F.lit(1))
            return ((F.substring(lowered, p["at"] + 1, width) == skill)
                    & (before.rlike(is_word) == starts_bare) & (after.rlike(is_word) == ends_bare))

        def add(state: Column, p: Column) -> Column:
            left = F.greatest(p["at"] - window, F.lit(0))
            # substring stops at the end of the text by itself
            snippet = strip(F.substring(original, left + 1, p["at"] + width + window - left))
            taken = F.struct((p["at"] + width).alias("end"),
                             F.array_append(state["contexts"], snippet).alias("contexts"))
            return F.when(p["at"] >= state["end"], taken).otherwise(state)

        empty = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("contexts"))
        whole = F.filter(F.filter(places, lambda p: p["token"] == first), is_whole)
        return F.aggregate(whole, empty, add, lambda s: s["contexts"])

    def entries(original: Column, lowered: Column) -> Column:
        named = F.filter(skills, lambda s: lowered.contains(s))
        listed = let(tokens(lowered), lambda ts: F.arrays_zip(
            ts.alias("token"), running_starts(F.transform(ts, lambda t: F.length(t))).alias("at")))
        firsts = F.transform(named, lambda s: F.regexp_extract(s, _FIRST_TOKEN, 0))
        opening = let(firsts, lambda fs: F.filter(listed, lambda p: F.array_contains(fs, p["token"])))
        return F.when(F.size(named) > 0, let(opening, lambda places: F.transform(
            named, lambda s: F.struct(
                s.alias("key"), around(s, original, lowered, places).alias("value")))))

    found = let(text, lambda original: let(
        F.lower(original), lambda lowered: entries(original, lowered)))
    found = F.when(text.isNotNull() & skills.isNotNull(), F.coalesce(
        found, F.array().cast("array<struct<key:string,value:array<string>>>")))
    return F.map_from_entries(F.filter(found, lambda e: F.size(e["value"]) > 0))

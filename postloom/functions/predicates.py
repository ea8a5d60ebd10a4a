"""Predicates that decide which postings stay."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import wordlists as W
from postloom.functions.regex import contains_any, let, strip


def _false_if_null(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def is_tech_title(title: Column) -> Column:
    """A technical word in the title and none of the exclusions."""
    text = F.lower(title)
    return _false_if_null(
        ~contains_any(text, W.TECH_TITLE_EXCLUSIONS) & contains_any(text, W.TECH_TITLE_WORDS))


def is_foreign_posting(description: Column, location: Column) -> Column:
    """Raw description or location says the job is in the United States."""
    return (
        _false_if_null(contains_any(F.lower(description), W.US_TEXT_MARKS))
        | _false_if_null(contains_any(F.lower(location), W.US_PLACE_MARKS))
    )


def is_short(description: Column, minimum: int = W.MIN_DESCRIPTION_CHARS) -> Column:
    return F.coalesce(F.length(description), F.lit(0)) < minimum


def is_bad_url(url: Column) -> Column:
    return ~_false_if_null(F.lower(strip(url)).startswith("http"))


def is_valid_title(title: Column) -> Column:
    """A title without a non-technical trade: the part of :func:`is_valid_posting` on titles."""
    return _false_if_null((title != "") & ~contains_any(F.lower(title), W.NON_TECH_TITLE_WORDS))


def is_valid_posting(title: Column, description: Column) -> Column:
    """Readable title and description, and no non-technical trade in the title."""
    marks = F.length(description) - F.length(F.replace(description, F.lit("?"), F.lit("")))
    return is_valid_title(title) & _false_if_null(
        (description != "")
        & ~description.contains("???") & (marks <= W.MAX_QUESTION_MARKS))


def has_forbidden_title(title: Column) -> Column:
    return _false_if_null(contains_any(F.lower(title), W.FORBIDDEN_TITLE_WORDS))


def is_tech_by_words(title: Column, description: Column) -> Column:
    """Ordered test: infrastructure words win over blocked words, those over degrees.

    NULL where no such word occurs."""
    def decide(t: Column, d: Column) -> Column:
        def either(words: list[str]) -> Column:
            return _false_if_null(contains_any(t, words)) | _false_if_null(contains_any(d, words))

        return (
            F.when(either(W.INFRA_WORDS), F.lit(True))
            .when(either(W.BLOCK_WORDS), F.lit(False))
            .when(_false_if_null(contains_any(d, W.DEGREE_PHRASES)), F.lit(True))
        )

    return let(F.lower(title), lambda t: let(F.lower(description), lambda d: decide(t, d)))


def is_tech_posting(title: Column, description: Column, skills: Column) -> Column:
    """Words decide as in :func:`is_tech_by_words`, and skills decide the rest."""
    return F.coalesce(
        is_tech_by_words(title, description), F.coalesce(F.size(skills), F.lit(0)) > 0)

"""Posting dates: a grammar for absolute dates, and "3 days ago"."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions.regex import collapse, is_blank, let

_ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"
_MONTHS = ("jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
           "|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?")
_SHORT_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
_WEEKDAY = r"\b(?:mon|tue(?:s)?|wed(?:nes)?|thu(?:r|rs)?|fri|sat(?:ur)?|sun)(?:day)?\b\.?"
# a zone only stands behind a time; a month there is none
_ZONE = (rf"(?: ?(?:z|(?!(?:{_MONTHS})\b)[a-z]{{3,5}}(?:[+-]\d{{1,2}}(?::?\d{{2}})?)?"
         r"|[+-]\d{2}(?::?\d{2})?)(?![a-z\d]))?")
_CLOCK = (r"(?:\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?: ?[ap]\.?m\b\.?)?|\d{1,2} ?[ap]\.?m\b\.?)")
# a time may follow a date with a T, or stand on its own before or behind it
_TIME = rf"(?:(?<=\d)t(?:\d{{4}}(?:\d{{2}})?|{_CLOCK})|(?<!\d){_CLOCK}){_ZONE}"
_ORDINAL = r"\b(\d{1,2})(?:st|nd|rd|th)\b"
_FILLER = r"\b(?:of|at|on|the|and)\b"
_TOKEN = r"([a-z]+|\d+)"
_BETWEEN = r"[ ,./\-]+"


def _tokens(value: Column) -> Column:
    """Numbers and month names of a date, in order; NULL if the text has anything else."""
    text = F.lower(collapse(value))
    for pattern in (_WEEKDAY, _TIME):
        text = F.regexp_replace(text, pattern, " ")
    text = F.regexp_replace(F.regexp_replace(text, _ORDINAL, "$1 "), _FILLER, " ")

    def listed(rest: Column) -> Column:
        found = F.regexp_extract_all(rest, F.lit(_TOKEN), F.lit(1))
        known = F.forall(found, lambda t: t.rlike(rf"\A(?:\d{{1,14}}|{_MONTHS})\z"))
        clean = F.regexp_replace(rest, rf"{_TOKEN}|{_BETWEEN}", "") == ""
        return F.when(clean & known & F.size(found).between(1, 3), found)

    return let(text, listed)


def _fold(tokens: Column) -> Column:
    """``year-month-day`` from one to three tokens.

    * a month in letters is the month; of two numbers beside it, the one of four digits or
      over 31 is the year, else the second one;
    * of three numbers the first is the year if it has four digits or is over 31, and month
      and day follow; else month, day, year. A month over 12 changes places with the day;
    * year and month without a day are the first of the month, a year alone is the first of
      January, and one number of 6, 8, 12 or 14 digits is a date with or without a time.
    """
    first, second, third = (F.get(tokens, F.lit(i)) for i in range(3))
    kinds = F.array_join(F.transform(
        tokens, lambda t: F.when(t.rlike(r"\A\d"), "n").otherwise("m")), "")
    number = lambda t: t.try_cast("int")
    is_year = lambda t: (F.length(t) >= 4) | (number(t) > 31)
    long_year = lambda t: F.length(t) == 4

    def month(t: Column) -> Column:
        named = F.position(F.substring(t, 1, 3), F.lit(_SHORT_MONTHS))
        return F.when(t.rlike(r"\A\d"), number(t)).otherwise(((named + 3) / 4).cast("int"))

    def date(y: Column, m: Column, d: Column) -> Column:
        year = F.when(F.length(y) <= 2, number(y) + 2000).when(F.length(y) == 4, number(y))
        swapped = m.rlike(r"\A\d") & (number(m) > 12)
        return F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"),
                           F.when(swapped, number(d)).otherwise(month(m)),
                           F.when(swapped, number(m)).otherwise(number(d)))

    one = F.lit("1")
    digits = F.length(first)
    part = lambda at, n: F.substring(first, at, n)
    named = lambda m, a, b: F.when(
        is_year(a), date(a, m, b)).otherwise(date(b, m, a))
    return (
        F.when(kinds == "mnn", named(first, second, third))
        .when(kinds == "nmn", named(second, first, third))
        .when(kinds == "nnm", named(third, first, second))
        .when((kinds == "nnn") & is_year(first), date(first, second, third))
        .when(kinds == "nnn", date(third, first, second))
        .when((kinds == "mn") & long_year(second), date(second, first, one))
        .when((kinds == "nm") & long_year(first), date(first, second, one))
        .when((kinds == "nn") & long_year(first), date(first, second, one))
        .when((kinds == "nn") & long_year(second), date(second, first, one))
        .when((kinds == "n") & digits.isin(8, 12, 14), date(part(1, 4), part(5, 2), part(7, 2)))
        .when((kinds == "n") & (digits == 6), date(part(1, 2), part(3, 2), part(5, 2)))
        .when((kinds == "n") & (digits == 4), date(first, one, one)))


def parse_date(value: Column) -> Column:
    """DATE in the text, or NULL.  A zoned time keeps its own local date.

    Weekdays, times (in front or behind), ordinal endings and filler words are taken out; what
    is left must be numbers and a month, see :func:`_fold`.
    """
    folded = let(_tokens(value), _fold)
    return F.try_to_timestamp(folded, F.lit("yyyy-M-d")).cast("date")


def format_date(value: Column) -> Column:
    """:func:`parse_date` as ``yyyy-MM-dd`` text."""
    return F.date_format(parse_date(value), "yyyy-MM-dd")


def days_ago(value: Column) -> Column:
    """First whole number in the text, in Latin or Arabic digits."""
    digits = F.translate(value, _ARABIC_DIGITS, "0123456789" * 2)
    return F.regexp_extract(digits, r"\d+", 0).try_cast("int")


def relative_date(value: Column, as_of: dt.date, absolute_first: bool = False) -> Column:
    """Date of "N days ago", counted from ``as_of``; no number means ``as_of``.

    The number counts as days whatever unit follows.  ``absolute_first`` reads a
    full date as that date instead of taking its year for a number of days.
    """
    today = F.lit(as_of)
    approximate = F.date_sub(today, days_ago(value))
    no_number = is_blank(value) | ~value.rlike(r"\p{Nd}")
    result = F.when(no_number, today).otherwise(approximate)
    if absolute_first:
        result = F.coalesce(parse_date(value), result)
    return F.date_format(result, "yyyy-MM-dd")


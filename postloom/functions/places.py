"""Cities and countries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import wordlists as W
from postloom.functions.regex import (
    SPACE, by_spelling, contains_any, first_listed, let, strip,
)
from postloom.operators.substring_index import with_first_values


def clean_city(location: Column) -> Column:
    """City named in a location text; NULL for job platforms and unknown places."""
    def lookup(text: Column) -> Column:
        city = first_listed(text, by_spelling(W.CITY_SPELLINGS))
        return F.when(~contains_any(text, W.JOB_PLATFORMS), city)

    return let(F.lower(location), lookup)


def unbulleted(location: Column) -> Column:
    """A location written as "City • Region", with a dash for the bullet."""
    dashed = F.translate(location, "•", "-")
    return strip(F.regexp_replace(dashed, rf"[{SPACE}]{{2,}}", " "))


def clean_bulleted_city(location: Column) -> Column:
    """:func:`clean_city` for locations written as "City • Region"."""
    return clean_city(unbulleted(location))


def city_dictionary(spark: SparkSession) -> DataFrame:
    """The built-in spellings as a table that :func:`with_city` takes."""
    listed = [(spelling, city, i) for i, (spelling, city) in enumerate(
        by_spelling(W.CITY_SPELLINGS).items())]
    return spark.createDataFrame(listed, "key string, value string, priority long")


def with_city(df: DataFrame, name: str, cities: DataFrame, *texts: Column) -> DataFrame:
    """``df`` with the city named in the first of the texts that names one.

    The rules of :func:`clean_city` for a dictionary of any size: a table of ``key`` (a
    spelling in lower case), ``value`` and ``priority``; nothing of it is brought to the driver.
    """
    def named(text: Column) -> Column:
        """The text in lower case, NULL for one that names a job platform."""
        return let(F.lower(text), lambda t: F.when(~contains_any(t, W.JOB_PLATFORMS), t))

    columns = {f"__{name}_{i}": named(text) for i, text in enumerate(texts)}
    found = with_first_values(df, cities, **columns)
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    return found.select(*kept, F.coalesce(*columns).alias(name))


def is_domestic_location(location: Column) -> Column:
    """False only for locations with a mark of another country."""
    foreign = contains_any(F.lower(location), W.US_LOCATION_MARKS)
    return ~F.coalesce(foreign, F.lit(False))


def is_country_match(country: Column, *places: Column) -> Column:
    """Country code matches, or a place text names the country or a city in it."""
    text = F.lower(F.concat_ws(" ", *places))
    same_code = F.upper(strip(country)) == W.SAUDI_COUNTRY_CODE
    return F.coalesce(same_code, F.lit(False)) | contains_any(text, W.SAUDI_WORDS)

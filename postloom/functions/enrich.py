"""Employment type and education level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import wordlists as W
from postloom.functions.regex import by_spelling, first_listed


def employment_type(declared: Column, description: Column) -> Column:
    """First of part-time, contract, full-time named in either text."""
    text = F.lower(F.concat_ws(" ", declared, description))
    found = first_listed(text, by_spelling(W.EMPLOYMENT_SPELLINGS))
    return F.coalesce(found, F.lit(W.DEFAULT_EMPLOYMENT))


def education(description: Column) -> Column:
    """Lowest degree named in the description, or NULL."""
    return first_listed(F.lower(description), by_spelling(W.EDUCATION_SPELLINGS))

"""One null model: missing values are NULL, whatever the source wrote for them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.regex import SPACE_CHARACTERS
from postloom.functions.wordlists import NULL_WORDS


def null_words_to_null(value: Column) -> Column:
    """``NaN``, ``NaT`` and ``None`` written as text are missing values.

    ``from_json`` reads a bare NaN token into a text column with quotes around it.
    """
    # the length test keeps long texts from being lower-cased
    trimmed = F.btrim(value, F.lit(SPACE_CHARACTERS + '"'))
    is_word = (F.length(trimmed) <= max(map(len, NULL_WORDS))) & F.lower(trimmed).isin(NULL_WORDS)
    return F.when(~is_word, value)


def normalize_nulls(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    chosen = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    return df.select(*[
        null_words_to_null(quoted(c)).alias(c) if c in chosen else quoted(c) for c in df.columns
    ])


def quoted(name: str) -> Column:
    """A column by its whole name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def field(df: DataFrame, names: Sequence[str]) -> Column:
    """First filled column of ``names``; a column the frame lacks counts as NULL.

    The last name is the fallback and may be empty text.
    """
    values = [F.col(n).cast("string") if n in df.columns else F.lit(None).cast("string")
              for n in names]
    if not values:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values[:-1]], values[-1])

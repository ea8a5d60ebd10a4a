"""Keep expensive expressions from being evaluated more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` whose expressions are not copied into later filters.

    Predicate pushdown rewrites a filter on a projected column into a filter on
    its expression, so a cleaned text that is filtered twice and then selected is
    cleaned three times.  A one-row ``inline`` produces the same columns and stays
    where it is.  Existing columns of the same name are replaced.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))

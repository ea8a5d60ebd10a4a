"""Keep one row per key.

Hot keys: ``row_number() = 1`` keeps at most one row per key and task *before*
the shuffle (Spark plans a partial window group limit), and the aggregates
combine before the shuffle, so no task ever receives a whole group.  Nulls are
equal to each other, as in a window partition.

Keys may be whole texts.  A hash stands in front of them: rows are dealt and mostly
sorted by it, and the texts only decide between equal hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK, _HASH = "__rank", "__keyhash"


def _keep_one(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], hashed: bool = False,
) -> DataFrame:
    """``hashed``: the keys already begin with a hash; the result keeps their partitioning."""
    if not hashed:
        df, keys = df.withColumn(_HASH, F.xxhash64(*keys)), [_HASH, *keys]
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK, _HASH)


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hashed: bool = False,
) -> DataFrame:
    """First row of every key in the order of the given columns."""
    return _keep_one(df, keys, [F.col(c).asc_nulls_last() for c in order], hashed)


def keep_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hashed: bool = False,
) -> DataFrame:
    """Last row of every key in the order of the given columns."""
    return _keep_one(df, keys, [F.col(c).desc_nulls_last() for c in order], hashed)


def repost_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per content key; NULL where a key column is missing."""
    any_null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else (
        F.col(keys[0]).isNull())
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("repost_count"))
    return counted.withColumn("repost_count", F.when(~any_null, F.col("repost_count")))


def with_repost_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row with the number of rows that share its key.

    Counts are combined before the shuffle and joined back; a hot key is one row
    on the counted side, and the adaptive skew join splits it on the other.
    """
    return _with_counts(df, df, keys)


def _with_counts(rows: DataFrame, counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the number of rows of ``counted`` that share their key.

    Rows without a part of the key have no count, so keys meet by two hashes of 64 bits,
    and the texts themselves stay out of the aggregate and the join.
    """
    whole = F.lit(True)
    for key in keys:
        whole &= F.col(key).isNotNull()
    hashes = {"__count1": F.xxhash64(*keys), "__count2": F.xxhash64(F.lit("second"), *keys)}
    counts = counted.where(whole).select(*[h.alias(n) for n, h in hashes.items()]).groupBy(
        *hashes).agg(F.count(F.lit(1)).alias("repost_count"))
    marked = rows.withColumns({n: F.when(whole, h) for n, h in hashes.items()})
    return marked.join(counts, list(hashes), "left").drop(*hashes)


def deduplicate_by_content(
    df: DataFrame, keys: Sequence[str], date: str, order: Sequence[str], nulls: str = "win",
) -> DataFrame:
    """Latest row of every key, with the number of rows of that key.

    A missing date counts as the latest (``nulls="win"``) or as the earliest
    (``nulls="lose"``); rows of equal date are ranked by ``order``.
    """
    by_date = F.col(date).desc_nulls_first() if nulls == "win" else F.col(date).desc_nulls_last()
    latest = _keep_one(df, keys, [by_date, *[F.col(c).desc_nulls_last() for c in order]])
    # one row per key on both sides
    return _with_counts(latest, df, keys)

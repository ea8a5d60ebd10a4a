"""Keyed upsert that remembers when a record was first and last seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.operators.dedup import keep_last

FIRST, LAST, CHANGE = "first_seen", "last_seen", "change"
ADDED, UPDATED, KEPT = "added", "updated", "kept"
_HASH, _KEY = "__hash", "__key"


def record_key(*columns: str) -> Column:
    """Key of a record as one text, for export; joins use the columns themselves."""
    return F.concat_ws(
        "||", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns])


def _payload(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in (*keys, FIRST, LAST)]


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys as one struct behind a hash of them.

    A struct equals another also where fields are null, so a plain equi-join is
    null-safe and meets the partitioning that ``keep_last`` leaves; sorting is mostly
    decided by the hash, not by long texts.
    """
    return df.select(
        F.xxhash64(*keys).alias(_HASH), F.struct(*keys).alias(_KEY),
        *[c for c in df.columns if c not in keys])


def merge_seen(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], now: Column,
    order: Sequence[str], drop_empty_keys: bool = False,
) -> DataFrame:
    """State after a batch, with a ``change`` column: added, updated or kept.

    * a record of the batch replaces the stored record of its key, keeps its
      ``first_seen`` and gets ``last_seen = now``;
    * a new key gets both times = ``now``;
    * a stored record without a match stays as it is;
    * the last record of a key in the batch (by ``order``) counts;
    * keys compare null-safe.  ``drop_empty_keys`` leaves out batch records whose
      key is missing or empty.

    Both sides hold one row per key when they meet, so one full outer equi-join
    does it and no key can be hot.  Every row is shuffled once: the batch by
    ``keep_last``, whose partitioning the join takes over, and the state by the join.  ``order`` columns that the state does not have
    are used for ranking only.
    """
    if drop_empty_keys:
        for key in keys:
            batch = batch.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    payload = _payload(existing, keys)
    ranked_by = [c for c in order if c not in (*keys, *payload)]
    batch = batch.select(*keys, *payload, *ranked_by)
    in_key = [f"{_KEY}.{c}" if c in keys else c for c in order]
    batch = keep_last(_keyed(batch, keys), [_HASH, _KEY], in_key, hashed=True)
    old = _keyed(existing.select(*keys, *payload, FIRST, LAST), keys).withColumn(
        "__old", F.lit(True)).alias("o")
    new = batch.select(_HASH, _KEY, *payload).withColumn("__new", F.lit(True)).alias("n")
    is_new, is_old = F.col("n.__new").isNotNull(), F.col("o.__old").isNotNull()

    def pick(column: str) -> Column:
        return F.when(is_new, F.col(f"n.{column}")).otherwise(F.col(f"o.{column}")).alias(column)

    return old.join(new, [_HASH, _KEY], "full_outer").select(
        *[F.col(_KEY)[k].alias(k) for k in keys],
        *[pick(c) for c in payload],
        F.when(is_old, F.coalesce(F.col(f"o.{FIRST}"), now)).otherwise(now).alias(FIRST),
        F.when(is_new, now).otherwise(F.col(f"o.{LAST}")).alias(LAST),
        F.when(is_new & is_old, F.lit(UPDATED)).when(is_new, F.lit(ADDED))
        .otherwise(F.lit(KEPT)).alias(CHANGE),
    )


def fresh_seen(
    batch: DataFrame, keys: Sequence[str], now: Column, order: Sequence[str],
) -> DataFrame:
    """State that starts again from a batch: both times are ``now``."""
    kept = keep_last(batch, keys, order)
    return kept.select(
        *keys, *_payload(kept, keys), now.alias(FIRST), now.alias(LAST),
        F.lit(ADDED).alias(CHANGE))


def processed(merged: DataFrame) -> DataFrame:
    """The records of this batch, as merged: what a run lands."""
    return merged.where(F.col(CHANGE) != KEPT).drop(CHANGE)


def merge_counts(merged: DataFrame) -> DataFrame:
    """How many keys a batch added and updated."""
    return merged.agg(
        F.count_if(F.col(CHANGE) == ADDED).alias("added"),
        F.count_if(F.col(CHANGE) == UPDATED).alias("updated"))

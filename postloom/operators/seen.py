"""Links that were seen before, and links that are new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.nulls import field
from postloom.operators.dedup import keep_first


def seen_urls(cache: DataFrame | None, raw: DataFrame, url_fields: Sequence[str]) -> DataFrame:
    """Known links: those of the cache and those of landed records."""
    urls = raw.select(field(raw, url_fields).alias("url"))
    if cache is not None:
        urls = cache.select("url").unionByName(urls)
    return with_url(urls, "url").distinct()


def with_url(df: DataFrame, url: str) -> DataFrame:
    """Rows that have a link."""
    return df.where(F.nullif(F.col(url), F.lit("")).isNotNull())


def unseen(df: DataFrame, seen: DataFrame, url: str, order: Sequence[str]) -> DataFrame:
    """Rows with a link that is neither seen before nor repeated in this run.

    Repeats go first, so each side of the anti-join has one row per link and a
    link shared by many rows cannot overload a task.
    """
    first = keep_first(with_url(df, url), [url], order)
    known = seen.select(F.col("url").alias("__seen"))
    return first.join(known, F.col(url) == F.col("__seen"), "left_anti")


def sample_links(links: DataFrame, n: int, seed: str, url: str = "url") -> DataFrame:
    """``n`` links in a random but repeatable order (a top-n, not a full sort)."""
    return links.orderBy(F.md5(F.concat(F.col(url), F.lit(seed))), F.col(url)).limit(n)


def first_accepted(df: DataFrame, accepted: Column, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows that pass a test: the stop rule of a run."""
    return df.where(accepted).orderBy(*order).limit(n)

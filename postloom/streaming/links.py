"""Streams of links: each link once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.operators.seen import with_url


def unseen_stream(
    stream: DataFrame, seen: DataFrame, url: str = "url", within: tuple[str, str] | None = None,
) -> DataFrame:
    """Links of a stream that are neither in ``seen`` nor repeated in the stream.

    Exact with unbounded state by default (use the RocksDB state store, which
    keeps it on disk per partition).  ``within=(time column, delay)`` bounds the
    state: repeats that arrive later than the delay are not recognised.
    """
    known = seen.select(F.col("url").alias("__seen")).distinct()
    fresh = with_url(stream, url).join(known, F.col(url) == F.col("__seen"), "left_anti")
    if within is None:
        return fresh.dropDuplicates([url])
    column, delay = within
    return fresh.withWatermark(column, delay).dropDuplicatesWithinWatermark([url])

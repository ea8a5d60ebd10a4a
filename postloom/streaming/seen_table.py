"""Streams of links against a table of seen links that they extend.

Each micro-batch is matched against the links of all earlier batches and of the start, and what
is new is added under the batch's own folder before the batch counts as done. A batch that is
replayed after a failure overwrites that folder with the same rows, so a link is given out once
over restarts and over several queries that run one after the other on the same table.

    <root>/links/query=<name>/batch_id=<n>/...
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postloom.operators.seen import with_url
from postloom.sources.readers import read_parquet

SCHEMA = "url string, query string, batch_id long"


def seen_links(spark: SparkSession, root: str) -> DataFrame:
    """(url, query, batch_id) of every link that was given out."""
    return read_parquet(spark, f"{root}/links", SCHEMA)


def add_unseen(
    root: str, query: str, start: DataFrame | None = None, url: str = "url",
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that adds the links of a batch that were not seen before.

    ``start``: links (``url``) that count as seen from the beginning.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = with_url(batch, url).select(F.col(url).alias("url")).distinct()
        # what this batch itself wrote before a failure does not count
        own = (F.col("query") == query) & (F.col("batch_id") >= batch_id)
        known = seen_links(spark, root).where(~own).select("url")
        if start is not None:
            known = known.unionByName(start.select("url"))
        # one row per link on both sides of the anti-join
        fresh = fresh.join(known.distinct(), "url", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{root}/links/query={query}/batch_id={batch_id}")

    return write


def start_unseen(
    stream: DataFrame, root: str, query: str, checkpoint: str, start: DataFrame | None = None,
    url: str = "url", once: bool = True,
) -> StreamingQuery:
    """Start a query that extends the table; ``once`` drains what is there and stops."""
    writer = stream.writeStream.foreachBatch(add_unseen(root, query, start, url)).option(
        "checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()

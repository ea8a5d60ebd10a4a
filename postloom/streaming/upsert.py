"""Streams of landed records -> keyed state with first and last seen times.

Rewriting the whole state for every micro-batch would cost the size of the state
each time.  A batch is folded to one row per key and written to its own folder of
a log instead; the state is the fold of the log.  Folding is associative (earliest,
latest, last record), so the result does not depend on how the stream was cut
into batches, and a replayed batch overwrites its own folder: exactly once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postloom.sources.readers import read_state

FIRST, LAST, BATCH = "first_seen", "last_seen", "batch_id"
VERSION = T.StructType([
    T.StructField("through", T.LongType()), T.StructField("path", T.StringType())])


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: earliest and latest seen time, columns of the last record.

    A combinable aggregate: every task reduces its rows before the shuffle, so a
    key that holds most of the rows costs no more than any other.
    """
    payload = [c for c in df.columns if c not in (*keys, FIRST, LAST)]
    rank = F.struct(*[F.col(c) for c in order])
    folded = df.groupBy(*keys).agg(
        F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST),
        F.max_by(F.struct(*payload), rank).alias("__last"))
    return folded.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in payload], FIRST, LAST)


def upsert_batch(
    keys: Sequence[str], order: Sequence[str], seen_at: Column, log: str,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that adds a batch to the log."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # records without a key are not stored
        present = batch.dropna(how="all", subset=list(keys))
        stamped = present.withColumns({FIRST: seen_at, LAST: seen_at})
        fold(stamped, keys, order).write.mode("overwrite").parquet(f"{log}/{BATCH}={batch_id}")

    return write


def start_upserts(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], seen_at: Column,
    log: str, checkpoint: str, once: bool = True,
) -> StreamingQuery:
    """Start the upsert stream; ``once`` drains what is there and stops."""
    writer = stream.writeStream.foreachBatch(upsert_batch(keys, order, seen_at, log)).option(
        "checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()


def _bases(log: str) -> str:
    return f"{log}.bases"


def _stored(spark: SparkSession, log: str) -> tuple[DataFrame, int]:
    """Rows that the state folds, and the last batch of the base among them (-1: none).

    The newest base stands for the batches up to its own; of the log only the folders of
    later batches are read.
    """
    versions = read_state(spark, f"{_bases(log)}/versions", VERSION)
    newest = versions.orderBy(F.desc("through"), F.desc("path")).first()
    batches = spark.read.parquet(log)
    if newest is None:
        return batches, -1
    later = batches.where(F.col(BATCH) > newest["through"])
    return spark.read.parquet(newest["path"]).unionByName(later), newest["through"]


def current_state(
    spark: SparkSession, log: str, keys: Sequence[str], order: Sequence[str],
) -> DataFrame:
    """State = fold of base and log; among equal ``order`` values the later batch wins."""
    return fold(_stored(spark, log)[0], keys, [*order, BATCH]).drop(BATCH)


def compact(spark: SparkSession, log: str, keys: Sequence[str], order: Sequence[str]) -> int:
    """Fold all batches but the last into a new base; returns the last batch it holds.

    The last batch may still be written, so it stays in the log.  A base is a folder of its
    own, and readers turn to it only once its row is added to the list of versions: a run
    that dies before that changes nothing, and readers of the base before go on.
    """
    rows, through = _stored(spark, log)
    # from the names of the folders, not from their rows
    last = spark.read.parquet(log).agg(F.max(BATCH)).first()[0]
    if last is None or last - 1 <= through:
        return through
    path = f"{_bases(log)}/{uuid.uuid4().hex}"
    done = rows.where(F.col(BATCH) < last)
    fold(done, keys, [*order, BATCH]).write.parquet(path)
    version = spark.createDataFrame([(last - 1, path)], VERSION)
    version.coalesce(1).write.mode("append").json(f"{_bases(log)}/versions")
    return last - 1

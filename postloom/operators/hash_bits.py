"""The keys of a large table as bits of their hashes, tested in the row before anything is shuffled.

A join whose smaller side is too large for a broadcast shuffles every candidate of the other side,
though most of them meet nothing. The bits have a fixed share of the keys' number (``PER_KEY`` bits
each, ``MAX_BITS`` in all) and are a scalar subquery: an array of runs of 64-bit words that a filter
reads in place. Bits only drop what no key equals; what stays meets the keys themselves by an exact
join. Beyond ``MAX_BITS`` / ``PER_KEY`` keys fewer candidates are dropped, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.session import cut_lineage

PER_KEY = 16
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
_RUN = 1 << 10  # words in a run


class HashBits:
    """Bits of the hashes of the texts in a column; ``rows``: about how many there are."""

    def __init__(self, keys: DataFrame, column: str, rows: int):
        self.size = MIN_BITS
        while self.size < min(rows * PER_KEY, MAX_BITS):
            self.size *= 2
        places = keys.select(F.explode(F.array(*self._places(F.col(column)))).alias("at"))
        one = F.lit(1).cast("long")
        words = places.groupBy(F.shiftright("at", 6).alias("no")).agg(
            F.bit_or(F.call_function("shiftleft", one, (F.col("at") % 64).cast("int"))).alias("word"))
        # every run is whole, also where no key has a bit
        whole = keys.sparkSession.range(self.size // 64).withColumnRenamed("id", "no").join(
            words, "no", "left").select("no", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
        runs = whole.groupBy((F.col("no") / _RUN).cast("long").alias("run")).agg(
            F.array_sort(F.collect_list(F.struct("no", "word"))).alias("words"))
        runs = runs.select("run", F.col("words.word").alias("words"))
        self.bits = cut_lineage(runs.agg(F.array_sort(F.collect_list(
            F.struct("run", "words"))).alias("runs")).select(F.col("runs.words").alias("bits"))).scalar()

    def _places(self, text: Column) -> list[Column]:
        """Two places of a text, from either half of its hash."""
        at = F.xxhash64(text)
        return [at.bitwiseAND(F.lit(self.size - 1).cast("long")),
                F.shiftrightunsigned(at, 32).bitwiseAND(F.lit(self.size - 1).cast("long"))]

    def _is_set(self, at: Column) -> Column:
        run = F.get(self.bits, F.shiftright(at, 16).cast("int"))
        word = F.get(run, F.shiftright(at, 6).bitwiseAND(F.lit(_RUN - 1).cast("long")).cast("int"))
        return F.getbit(word, (at % 64).cast("int")) == 1

    def may_hold(self, text: Column) -> Column:
        """False only for a text that is none of the keys; a test for filters, not for lambdas."""
        first, second = self._places(text)
        return self._is_set(first) & self._is_set(second)


def meet(df: DataFrame, keys: DataFrame, key: str, rows: int, broadcast_rows: int) -> DataFrame:
    """``df`` joined with ``keys``, which has ``rows`` rows, on ``key``.

    Up to ``broadcast_rows`` they are broadcast; beyond, what no key equals is dropped before the shuffle.
    """
    if rows <= broadcast_rows:
        return df.join(F.broadcast(keys), key)
    return df.where(HashBits(keys, key, rows).may_hold(F.col(key))).join(keys, key)

"""Target-distribution importance resampling over hashed word features.

A-Z become lower case; words are runs of digits, letters and characters beyond ASCII. Features
are all runs of 1 to ``max_n`` words, joined by one space, repeats counted; a feature's bucket is
the CRC-32 of its bytes modulo ``BUCKETS``. Documents hold S features, s in the bucket; the target
holds T and t. A bucket's gain is ``floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))``, a document's
weight the sum of gains over its features. A Gumbel number from a hash of the doc_id is added,
and the ``percent`` of the documents with the highest scores are drawn, without replacement.

Head and tail: words and pairs that are frequent in the corpus are found over all documents by
Misra-Gries summaries (``SUMMARY`` counters a task, merged by sums), so each word that makes up
more than one in ``SUMMARY`` + 1 of a task's words is among them. The ``HEAD`` most frequent ones
are broadcast: words with the state of their CRC, pairs with their bucket. A feature of the head
is a lookup; a pair of a known word goes on from the word's state; the rest, the tail, takes the
CRC of its bytes. Both give the same numbers, so totals and weights are exact whatever is in the
head, which only saves work.

Ranks: scores of documents with ``MIN_WORDS`` words are sorted in ranges; a row's rank is its place
in its range and the number of rows in the ranges before it.

Defined cases: null and empty texts have no features and weight 0; rows that share an id are
documents of their own; a null id is hashed as the empty string and ranked after all others of
its score; ties that agree in score and id are ordered by weight and n_features, and then alike;
with an empty target T and t are 0; an empty table gives an empty result; extra columns are not
read.

Scale: three scans of the corpus, in Arrow batches. Shuffled are the summaries, at most ``BUCKETS``
sums a task, and (id, score) rows for the ranks; texts never. Collected are ``HEAD`` words, as many
pairs, ``BUCKETS`` gains and one number for each range.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm.common import arrow_rows, ascii_words, slices, small_batches, utf8, written

BUCKETS = 10_000
MAX_N = 1
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
HEAD, SUMMARY = 32_768, 65_536


class Head(dict):
    """CRC states of frequent words; a word of the tail gets its own."""

    def __missing__(self, word: bytes) -> int:
        return crc32(word)


class Pairs(dict):
    """Buckets of frequent pairs; a pair of the tail goes on from its first word's state."""

    def __init__(self, known: dict, head: Head, buckets: int) -> None:
        super().__init__(known)
        self.head, self.buckets = head, buckets

    def __missing__(self, pair: tuple[bytes, bytes]) -> int:
        return crc32(b" " + pair[1], self.head[pair[0]]) % self.buckets


def feature_buckets(words: list[bytes], head: Head, pairs: Pairs, max_n: int,
                    buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every feature of a text: runs of one word first, then of two, and so on."""
    states = list(map(head.__getitem__, words))
    found = [np.array(states, dtype=np.int64) % buckets]
    if max_n >= 2:
        found.append(np.array(
            list(map(pairs.__getitem__, zip(words, words[1:], strict=False))), dtype=np.int64))
    if max_n >= 3:
        states = [crc32(b" " + w, s) for s, w in zip(states, words[1:], strict=False)]
    for n in range(3, max_n + 1):
        states = [crc32(b" " + w, s) for s, w in zip(states, words[n - 1:], strict=False)]
        found.append(np.array(states, dtype=np.int64) % buckets)
    return np.concatenate(found)


def _trimmed(counts: Counter, size: int) -> Counter:
    """A Misra-Gries summary: the largest counts, less the first that has no place."""
    if len(counts) <= size:
        return counts
    least = sorted(counts.values(), reverse=True)[size]
    return Counter({k: c - least for k, c in counts.items() if c > least})


def head_of(docs: DataFrame, text: str, max_n: int) -> tuple[dict, dict]:
    """CRC states of the most frequent words, and buckets of the most frequent pairs."""
    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [Counter() for _ in range(min(max_n, 2))]
        for part in (p for whole in batches for p in slices(whole)):
            texts = [ascii_words(t) for t in part.column(0).to_pylist()]
            kinds[0].update(chain.from_iterable(texts))
            if max_n >= 2:
                kinds[1].update(chain.from_iterable(
                    map(b" ".join, zip(w, w[1:], strict=False)) for w in texts))
            kinds = [c if len(c) < 2 * SUMMARY else _trimmed(c, SUMMARY) for c in kinds]
        for n, counts in enumerate(kinds, 1):
            top = _trimmed(counts, SUMMARY).most_common(HEAD)
            yield pa.RecordBatch.from_arrays([
                pa.array([n] * len(top), pa.int32()), pa.array([w for w, _ in top], pa.binary()),
                pa.array([c for _, c in top], pa.int64())], names=["n", "feature", "c"])

    counted = docs.select(utf8(text).alias("data")).mapInArrow(
        summary, "n int, feature binary, c long").groupBy("n", "feature").agg(
        F.sum("c").alias("c"))
    found = {}
    for n in (1, 2):
        best = counted.where(F.col("n") == n).orderBy(F.desc("c"), "feature").limit(HEAD)
        found[n] = [bytes(r.feature) for r in best.collect()] if n <= max_n else []
    return ({w: crc32(w) for w in found[1]},
            {tuple(p.split(b" ")): crc32(p) % BUCKETS for p in found[2]})


def _features(spark: SparkSession, head: tuple[dict, dict], max_n: int):
    """A function that tasks call: texts -> buckets of the features of each."""
    shared = spark.sparkContext.broadcast(head)
    state: dict = {}

    def of(texts: list) -> list[tuple[int, np.ndarray]]:
        if not state:
            known = Head(shared.value[0])
            state["head"], state["pairs"] = known, Pairs(shared.value[1], known, BUCKETS)
        words = [ascii_words(t) for t in texts]
        return [(len(w), feature_buckets(w, state["head"], state["pairs"], max_n)) for w in words]

    return of


def bucket_totals(texts: DataFrame, text: str, features) -> np.ndarray:
    """Number of features in each bucket, over all rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, dtype=np.int64)
        for part in (p for whole in batches for p in slices(whole)):
            for _, found in features(part.column(0).to_pylist()):
                sums += np.bincount(found, minlength=BUCKETS)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(sums[some], pa.int64())], names=["bucket", "n"])

    counted = texts.select(utf8(text).alias("data")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(BUCKETS, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """Gain of each bucket, from the features of corpus and target in it."""
    size = len(corpus)
    all_s, all_t = float(corpus.sum() + size), float(target.sum() + size)
    return [math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]


def gumbel(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel number that depends on seed and id alone."""
    named = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(named.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(docs: DataFrame, gains: list[int], features, doc_id: str, text: str,
            seed: int) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score."""
    shared = docs.sparkSession.sparkContext.broadcast(np.array(gains, dtype=np.int64))

    def make(ids: list, texts: list):
        found = features(texts)
        total = [int(shared.value[b].sum()) for _, b in found]
        yield {"doc_id": ids, "n_words": [n for n, _ in found],
               "n_features": [len(b) for _, b in found], "weight": total,
               "score": [w + gumbel(i, seed) for i, w in zip(ids, total, strict=True)]}

    return arrow_rows(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("data")), make,
        "doc_id long, n_words long, n_features long, weight long, score long")


def drawn(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the drawn documents, null for the others."""
    spark = scored.sparkSession
    able = scored.where(F.col("n_words") >= min_words)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    parts = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = scored.columns
    schema = ", ".join(f"{n} long" for n in [*names, "part", "place"])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = np.arange(start, start + batch.num_rows)
            start += batch.num_rows
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(np.full(batch.num_rows, part), pa.int64()),
                pa.array(places, pa.int64())], names=[*names, "part", "place"])

    ranges = written(spark, able.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                     .mapInArrow(numbered, schema), "ranges")
    sizes = {r.part: r["count"] for r in ranges.groupBy("part").count().collect()}
    before, total = [], 0
    for part in sorted(sizes):  # one row for each range, as many as shuffle partitions
        before.append((part, total))
        total += sizes[part]
    offsets = spark.createDataFrame(before, "part long, before long")
    rank = F.col("before") + F.col("place") + 1
    ranked = ranges.join(F.broadcast(offsets), "part").select(
        *names, F.when(rank <= total * percent // 100, rank).alias("rank"))
    rest = scored.where(F.col("n_words") < min_words)
    return ranked.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
    target_text: str = "text", max_n: int = MAX_N, percent: int = PERCENT,
    min_words: int = MIN_WORDS, seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank."""
    spark = docs.sparkSession
    small_batches(spark)
    features = _features(spark, head_of(docs, text, max_n), max_n)
    gains = bucket_gains(bucket_totals(docs, text, features),
                         bucket_totals(target, target_text, features))
    scored = written(spark, weights(docs, gains, features, doc_id, text, seed), "scored")
    return drawn(scored, percent, min_words)

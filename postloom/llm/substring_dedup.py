"""Substring dedup: repeated runs of sentences go, but for the first place of each run.

A text is cut into sentences (at . ! ? before white space, and at line ends; a sentence of
more than ``MAX_WORDS`` words is cut every so many words, so that a long sentence also has
runs). From every sentence on a run of ``SPAN`` consecutive sentences is hashed (white space
folded); one of fewer than ``MIN_WORDS`` words grows over the sentences behind it until it has
them, or the text ends. Runs of all documents meet in one hash aggregate; a run that
two documents hold is kept in the document with the smallest id and removed in the others,
and inside one document only its first place stays. A sentence goes if any run over it goes.

Word windows find what sentences miss: passages of very short sentences, and those that start
or end inside a sentence. Of every ``SPREAD`` consecutive hashes of ``GRAM`` words the smallest
is kept, so every passage of ``GRAM + SPREAD - 1`` = 35 words that two documents hold, at any
offset and whatever its sentences look like, has a kept hash in both. All words of a repeated
window go, and a sentence is cut where the repeat begins and ends; fewer than ``SPREAD`` words
of a passage may stay at either end of it. Inside one document every window counts.

Defined cases: null text stays null; an empty text or one of fewer than ``SPAN`` sentences
has no run; every row is a document, ordered by id (null first), then by a hash of the text, so of
rows that share an id, or are equal, the first keeps what they share; an empty table gives an
empty result; extra columns pass unchanged, whatever their names (own ``n_sentences`` and
``n_removed`` are replaced).

Owners of runs are the ids where each row has one of its own, which is counted first. Else the rows
are sorted in ranges and written with a number that follows the order.

Scale: the corpus is read twice and its text is shuffled once at most. What is grouped are
(hash, id) pairs, one per run or kept window and document, combined before the shuffle, so a passage that a
third of all documents share costs one row per task there. No group is ever collected but the
removed hashes of one document. The pairs are written once.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import (
    arrow_rows, every_column, row_key, unused, utf8, with_columns_mapped, written,
)

SPAN = 3
MAX_WORDS = 20
MIN_WORDS = 10
GRAM, SPREAD = 20, 16

_END = re.compile(rb"[.!?]+\s+|\n\s*")
_WORD = re.compile(rb"\s*\S+\s*")
_FACTOR = 0x9E3779B97F4A7C15


def sentences(data: bytes) -> list[bytes]:
    """Sentences with the white space behind them; joined, they are the text again."""
    cuts = [m.end() for m in _END.finditer(data)]
    if not cuts or cuts[-1] < len(data):
        cuts.append(len(data))
    out: list[bytes] = []
    start = 0
    for end in cuts:
        piece = data[start:end]
        start = end
        if len(piece.split()) > MAX_WORDS:
            words = _WORD.findall(piece)
            out += [b"".join(words[i:i + MAX_WORDS]) for i in range(0, len(words), MAX_WORDS)]
        elif out and not piece.strip():
            out[-1] += piece
        elif piece:
            out.append(piece)
    return out


def run_hashes(parts: list[bytes]) -> list[tuple[int, int]]:
    """Signed 64-bit hash and end of the run that starts at each sentence."""
    words = [p.split() for p in parts]
    folded = [b" ".join(w) for w in words]
    sizes = [len(w) for w in words]
    out: list[tuple[int, int]] = []
    end, n = 0, 0
    for i in range(len(parts) - SPAN + 1):
        while end < len(parts) and (end < i + SPAN or n < MIN_WORDS):
            n += sizes[end]
            end += 1
        value = xxhash.xxh64_intdigest(b"\n".join(folded[i:end]))
        out.append((value - 2**64 if value >= 2**63 else value, end))
        n -= sizes[i]
    return out


def gram_hashes(words: list[bytes]) -> np.ndarray:
    """Signed 64-bit hash of the ``GRAM`` words that start at each word."""
    n = len(words) - GRAM + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    one = np.array([digest(w, 1) for w in words], dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(GRAM):
        out = out * np.uint64(_FACTOR) + one[i:i + n]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out.view(np.int64)


def kept_grams(hashes: np.ndarray) -> np.ndarray:
    """The smallest of every ``SPREAD`` neighbours, each value once."""
    if len(hashes) <= SPREAD:
        return np.unique(hashes.min(keepdims=True)) if len(hashes) else hashes
    return np.unique(np.lib.stride_tricks.sliding_window_view(hashes, SPREAD).min(axis=1))


def _covered(n: int, words: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``words``."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, words, 1)
    np.add.at(step, words + GRAM, -1)
    return np.cumsum(step[:-1]) > 0


def repeated_words(hashes: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Words of windows in ``gone``, or of windows that stand further in front in the text."""
    n = len(hashes) + GRAM - 1
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    again = np.arange(len(hashes)) - first[which] >= GRAM
    return _covered(n, np.flatnonzero(again | np.isin(hashes, gone)))


def _scan(ids: list, texts: list):
    runs, owners = [], []
    for doc_id, data in zip(ids, texts, strict=True):
        found = {h for h, _ in run_hashes(sentences(data))}
        found.update(kept_grams(gram_hashes(data.split())).tolist())
        runs.extend(found)
        owners.append(np.full(len(found), doc_id, dtype=np.int64))
    if runs:
        yield {"run": np.array(runs, dtype=np.int64), "owner": np.concatenate(owners)}


def _cut_at_words(
    parts: list[bytes], drop: list[bool], words: np.ndarray
) -> tuple[list[bytes], list[bool]]:
    """Sentences cut where a stretch of repeated words begins or ends inside them."""
    out: list[bytes] = []
    flags: list[bool] = []
    at = 0
    for part, dropped in zip(parts, drop, strict=True):
        n = len(part.split())
        own = words[at:at + n]
        at += n
        if dropped or not n or own.all() or not own.any():
            out.append(part)
            flags.append(dropped or (n > 0 and bool(own.all())))
            continue
        pieces = _WORD.findall(part)
        edges = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), n]
        for a, b in zip(edges, edges[1:], strict=False):
            out.append(b"".join(pieces[a:b]))
            flags.append(bool(own[a]))
    return out, flags


def cut_runs(data: bytes, gone: set[int]) -> tuple[bytes, int, int]:
    """Text without the repeated sentences, number of sentences, number removed."""
    parts = sentences(data)
    drop = [False] * len(parts)
    seen: set[int] = set()
    for i, (h, end) in enumerate(run_hashes(parts)):
        if h in gone or h in seen:
            drop[i:end] = [True] * (end - i)
        seen.add(h)
    hashes = gram_hashes(data.split())
    if len(hashes):
        words = repeated_words(hashes, np.fromiter(gone, np.int64, len(gone)))
        if words.any():
            parts, drop = _cut_at_words(parts, drop, words)
    removed = sum(drop)
    if not removed:
        return data, len(parts), 0
    return b"".join(p for p, d in zip(parts, drop, strict=True) if not d), len(parts), removed


def numbered(docs: DataFrame, name: str, doc_id: str, text: str) -> DataFrame:
    """``docs`` as a written table with a number for each row that follows the order of ids.

    Rows are sorted in ranges of (id, hash of the text), so an id that many rows share is
    spread; the number of a row is that of its range and its place there.
    """
    k1, k2 = unused(docs, "_k1", "_k2")
    key = [c.alias(n) for c, n in zip(row_key(doc_id, text), (k1, k2), strict=True)]
    order = [F.asc_nulls_first(doc_id), F.col(k1), F.col(k2)]
    parts = max(docs.sparkSession.sparkContext.defaultParallelism,
                int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = docs.select("*", *key).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(docs.sparkSession, ranges.withColumn(
        name, F.monotonically_increasing_id()).drop(k1, k2), "numbered")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated sentences cut from ``text``; adds n_sentences and n_removed."""
    spark = docs.sparkSession
    docs = docs.select(*[c for c, n in zip(every_column(docs), docs.columns, strict=True)
                         if n.lower() not in ("n_sentences", "n_removed")])
    own, gone_runs = unused(docs, "_owner", "_gone")
    shared = docs.groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.count("*").alias("n"))
    if shared.where("n > 1 or id is null").isEmpty():
        owner = F.col(doc_id).cast("long")
    else:
        docs, owner = numbered(docs, own, doc_id, text), F.col(own)
    runs = written(spark, arrow_rows(
        docs.select(owner.alias("id"), utf8(text).alias("data")), _scan,
        "run long, owner long"), "runs")
    first = runs.groupBy("run").agg(
        F.min("owner").alias("first"), F.max("owner").alias("last")
    ).where(F.col("first") < F.col("last")).drop("last")
    gone = written(spark, runs.join(first, "run").where(F.col("owner") > F.col("first"))
                   .groupBy("owner").agg(F.collect_set("run").alias(gone_runs)), "repeats")
    joined = docs.withColumn(own, owner).join(gone.withColumnRenamed("owner", own), own, "left")

    def cut(texts: list, gone: list) -> dict[str, list]:
        done = [(None, 0, 0) if t is None else cut_runs(t.encode(), set(g or ()))
                for t, g in zip(texts, gone, strict=True)]
        return {text: [None if d is None else d.decode() for d, _, _ in done],
                "n_sentences": [n for _, n, _ in done], "n_removed": [r for _, _, r in done]}

    return with_columns_mapped(joined, cut, [text, gone_runs], "n_sentences int, n_removed int",
                               dropped=(own, gone_runs))

"""Exact top-k inner products: buckets by length, pruned by local cosine thresholds.

Components become ``floor(256 * x)``. Vectors are grouped by dimension and length (buckets of a
factor ``RATIO`` in length), large buckets are dealt into blocks of about ``BLOCK`` vectors by a
hash of their id, and each block is packed into one row, sorted by length. Queries are packed into
blocks as well.

First every query meets the block of the greatest lengths of its dimension, which gives a lower bound
of its k-th score. With the bound t, the query's length and a block's greatest length, the local
cosine threshold is t / (|q| * longest). Above 1 the block has nothing for the query: queries of
about the same t / |q| are packed together, and a cell (block, pack of queries) of which no query
passes is dropped from the lists of both before any data is moved. In the cells that are left,
from ``STEEP`` on, candidates are first filtered by their normalised component in the
query's largest coordinate (coordinate pruning), below by their length alone (length pruning).
The inner products of the rest are computed exactly, and what is not below t competes.

Defined cases: vectors that are null or hold null or non-finite components take no part; other
dimensions than the query's are no candidates; all rows with the query's id are the query's own;
a query id that occurs several times asks once, with its smallest vector; a null id is never a
query and comes last among equal scores; equal scores go to the smaller id; scores outside of
64 bits are cut to its ends; an empty table gives an empty result.

Scale: the stated query set meets all rows in blocks; vectors are shuffled to make blocks, each block
moves once more, and packs of queries are sent to the blocks that may hold something for them,
by a join of the two lists (one row a block and a pack). A length that all vectors share only makes more blocks.
Per query and block at most k rows go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.common import written

RATIO = 1.1
BLOCK = 4096
QUERIES = 512
STEEP = 0.5
SLACK = 1e-6  # bounds are computed in floating point
_EXACT = 2.0**53
_ENDS = (-(2**63), 2**63 - 1)


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector) -> (id, dim, length, bucket, data); data: components as doubles."""
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("vec_id", "dim", "length", "bucket", "data")}
        for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if vector is None or any(x is None for x in vector):
                continue
            x = np.floor(256.0 * np.array(vector, dtype=np.float64))
            if not np.isfinite(x).all():
                continue
            top = float(np.abs(x).max(initial=0.0))
            length = top * float(np.sqrt(((x / top) ** 2).sum())) if top else 0.0
            bucket = int(np.floor(np.log(length) / np.log(RATIO))) if length else -1
            for name, value in zip(out, (key, len(x), length, bucket, x.tobytes()), strict=True):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays([
            pa.array(out["vec_id"], pa.int64()), pa.array(out["dim"], pa.int32()),
            pa.array(out["length"], pa.float64()), pa.array(out["bucket"], pa.int32()),
            pa.array(out["data"], pa.binary())], names=list(out))


def _pack(rows: pa.Table) -> pa.Table:
    """All rows of a block as one row, longest vector first."""
    order = np.lexsort([rows.column("vec_id").fill_null(_ENDS[1]).to_numpy(),
                        -rows.column("length").to_numpy()])
    rows = rows.take(pa.array(order))
    ids = rows.column("vec_id").to_pylist()
    return pa.table({
        "dim": pa.array([rows.column("dim")[0].as_py()], pa.int32()),
        "block": pa.array([rows.column("block")[0].as_py()], pa.string()),
        "ids": pa.array([np.array([_ENDS[1] if i is None else i for i in ids], "<i8").tobytes()],
                        pa.binary()),
        "nulls": pa.array([bytes(i is None for i in ids)], pa.binary()),
        "lengths": pa.array([rows.column("length").to_numpy().astype("<f8").tobytes()], pa.binary()),
        "data": pa.array([b"".join(rows.column("data").to_pylist())], pa.binary()),
        "longest": pa.array([rows.column("length")[0].as_py()], pa.float64())})


_BLOCK_SCHEMA = ("dim int, block string, ids binary, nulls binary, lengths binary, data binary, "
                 "longest double")


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued doubles, as 64-bit numbers."""
    top = float(np.abs(x).max(initial=0.0)) * float(np.abs(q).max(initial=0.0)) * max(1, len(q))
    if top < _EXACT:
        return (x @ q).astype(np.int64)
    whole = [int(v) for v in q]
    return np.array([min(max(sum(a * int(b) for a, b in zip(whole, row, strict=True)), _ENDS[0]),
                         _ENDS[1]) for row in x], dtype=np.int64)


def _best(scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray, bound: int | None,
          k: int) -> list[tuple[int, int, int]]:
    """(score, null, id) of the k best that reach the bound: a selection, no full sort."""
    places = np.arange(len(scores)) if bound is None else np.flatnonzero(scores >= bound)
    if len(places) > k:
        last = np.partition(scores[places], len(places) - k)[len(places) - k]
        places = places[scores[places] >= last]  # all that tie with the last one
    order = np.lexsort([ids[places], nulls[places], ~scores[places]])  # ~s falls as s grows
    return [(int(scores[p]), int(nulls[p]), int(ids[p])) for p in places[order[:k]]]


def _candidates(q: np.ndarray, q_length: float, bound: float | None, lengths: np.ndarray,
                x: np.ndarray, longest: float) -> np.ndarray:
    """Places of a block that may score ``bound`` or more."""
    n = len(lengths)
    if bound is None or bound <= 0 or not q_length or not longest:
        return np.arange(n)
    local = bound / (q_length * longest) * (1 - SLACK)
    if local > 1:
        return np.arange(0)
    # length pruning: lengths are sorted, the longest first
    n = int(np.searchsorted(-lengths, -(bound / q_length) * (1 - SLACK), side="right"))
    if local < STEEP:
        return np.arange(n)
    # coordinate pruning: a cosine of at least local bounds each normalised component
    focus = int(np.argmax(np.abs(q)))
    mine = q[focus] / q_length
    spread = np.sqrt(max(0.0, 1 - mine * mine) * max(0.0, 1 - local * local))
    theirs = x[:n, focus] / np.where(lengths[:n] > 0, lengths[:n], 1)
    low = mine * local - spread if mine * local - spread > -1 else -1.0
    high = mine * local + spread
    if mine >= local:
        high = 1.0  # the largest component lies inside the cap
    if mine <= -local:
        low = -1.0
    return np.flatnonzero((theirs >= low - SLACK) & (theirs <= high + SLACK))


def _search(k: int):
    """Cells (block of vectors, block of queries) -> at most k rows per query."""
    names = ["query_id", "vec_id", "score"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for cell in batch.to_pylist():
                dim = cell["dim"]
                ids, lengths = np.frombuffer(cell["ids"], "<i8"), np.frombuffer(cell["lengths"], "<f8")
                nulls = np.frombuffer(cell["nulls"], np.uint8)
                x = np.frombuffer(cell["data"], "<f8").reshape(len(ids), dim)
                for key, data, length, bound in zip(
                        cell["q_ids"], cell["q_data"], cell["q_lengths"], cell["q_bounds"],
                        strict=True):
                    q = np.frombuffer(data, "<f8")
                    places = _candidates(q, length, bound, lengths, x, float(lengths[0]))
                    places = places[(ids[places] != key) | (nulls[places] == 1)]
                    out += [(key, None if null else i, s) for s, null, i in _best(
                        products(q, x[places]), nulls[places], ids[places], bound, k)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in out], pa.int64()) for j in range(3)], names=names)

    return task


def top_k(vectors: DataFrame, every: int, k: int = 5, vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row whose id
    divides by ``every``."""
    spark = vectors.sparkSession
    rows = written(spark, vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding)).mapInArrow(
        _quantised, "vec_id long, dim int, length double, bucket int, data binary"), "vectors")
    sizes = rows.groupBy("dim", "bucket").agg(F.count("*").alias("n"))
    dealt = rows.join(F.broadcast(sizes) if sizes.count() <= 100_000 else sizes, ["dim", "bucket"])
    part = F.pmod(F.xxhash64("vec_id", "data"), F.ceil(F.col("n") / BLOCK))
    dealt = dealt.withColumn("block", F.concat_ws("/", "dim", "bucket", part))
    blocks = written(spark, dealt.select("vec_id", "dim", "length", "data", "block").groupBy(
        "block").applyInArrow(_pack, _BLOCK_SCHEMA), "blocks")
    longest = blocks.select("dim", "block").withColumn(
        "bucket", F.split("block", "/")[1].cast("int")).groupBy("dim").agg(
        F.max(F.struct("bucket", "block"))["block"].alias("block"))

    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(
        F.min(F.struct("data", "dim", "length")).alias("q")).select("vec_id", "q.*")
    asked = asked.withColumn("part", F.pmod(
        F.xxhash64("vec_id"), F.lit(max(1, -(-asked.count() // QUERIES)))).cast("string"))

    def packed(queries: DataFrame, bound) -> DataFrame:
        return queries.groupBy("dim", "part").agg(F.collect_list(F.struct(
            "vec_id", "data", "length", bound.alias("bound"))).alias("q")).select(
            "dim", "part", F.col("q.vec_id").alias("q_ids"), F.col("q.data").alias("q_data"),
            F.col("q.length").alias("q_lengths"), F.col("q.bound").alias("q_bounds"))

    out = "query_id long, vec_id long, score long"
    sighted = packed(asked, F.lit(None).cast("long")).join(longest, "dim").join(
        blocks.drop("dim"), "block")
    seen = sighted.mapInArrow(_search(k), out)
    bounds = seen.groupBy("query_id").agg(
        F.count("*").alias("n"), F.min("score").alias("least")).select(
        F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("least")).alias("bound"))
    # the length that a vector must have for the query, and packs of queries with about the same
    needed = F.when((F.col("bound") > 0) & (F.col("length") > 0), F.col("bound") / F.col("length"))
    asked = written(spark, asked.drop("part").join(bounds, "vec_id", "left").withColumn(
        "needed", F.coalesce(needed, F.lit(0.0))), "queries")
    steps = F.when(F.col("needed") > 0, F.floor(F.log(F.col("needed")) / np.log(RATIO))).otherwise(
        F.lit(None)).cast("string")
    asked = asked.withColumn("step", F.coalesce(steps, F.lit("none")))
    alike = asked.groupBy("dim", "step").agg(F.count("*").alias("alike"))
    asked = asked.join(alike, ["dim", "step"]).withColumn("part", F.concat_ws(
        "/", "step", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("alike") / QUERIES))))
    packs = written(spark, packed(asked, F.col("bound")), "packs")
    least = asked.groupBy("dim", "part").agg(F.min("needed").alias("needed"))
    lists = blocks.select("dim", "block", "longest").join(least, "dim").where(
        F.col("longest") >= F.col("needed") * (1 - SLACK)).select("dim", "block", "part")
    # queries move to blocks; a block moves once, to the one task that holds all its cells
    spread = max(spark.sparkContext.defaultParallelism,
                 int(spark.conf.get("spark.sql.shuffle.partitions")))
    cells = lists.join(packs, ["dim", "part"]).repartition(spread, "block").join(
        blocks.drop("dim").repartition(spread, "block"), "block")
    found = cells.drop("longest").mapInArrow(_search(k), out)
    order = Window.partitionBy("query_id").orderBy(
        F.desc("score"), F.col("vec_id").isNull(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

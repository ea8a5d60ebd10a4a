"""SimHash near-duplicates: pigeonhole blocks, Hamming check, connected components.

Fingerprint: A-Z become lower case, words are runs without white space (ASCII), shingles are
three words joined by spaces, repeats included (fewer words: the whole sequence; none:
fingerprint zero). Bit b is set if it is set in over half of the shingles' XXH64 (seed 42).

Links: two fingerprints with at most two differing bits agree in at least two of four
16-bit blocks. Distinct fingerprints are joined on every pair of blocks (six keys of 32 bits)
and the Hamming distance is verified. A key that more than ``BUCKET`` distinct fingerprints
share would emit the square of its size; its members emit, within the key, their variants
with at most one of the other 32 bits flipped. Two of them meet in a variant exactly if they
differ in at most two bits, and at most 33 fingerprints have one variant, so this stays
linear and exact.

Components: large-star and small-star steps over the verified links, until they rest.

Defined cases: null and empty texts have fingerprint zero and link like any other; rows that
share an id each have their row; a null id gets a row, but only names a component if no row of
it has an id (then the name is null); an empty table gives an empty result.

Scale: only (id, fingerprint) pairs and distinct fingerprints are shuffled. A group of exact
copies is one fingerprint; its ids meet in combinable aggregates and in one equi-join that
adaptive execution splits. Nothing is collected.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import arrow_rows, packed, row_key, unpacked, utf8, written

SHINGLE = 3
SEED = 42
DISTANCE = 2
BLOCK_BITS = 16
BUCKET = 64
_AT_ONCE = 1 << 15


def fingerprint(data: bytes | None) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    words = (data or b"").lower().split()  # bytes.lower folds A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1:], strict=False)],
        dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _AT_ONCE):
        part = hashes[i:i + _AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return int(value)


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (the fingerprint as a signed long)."""
    return arrow_rows(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("data")),
        lambda ids, texts: [{"doc_id": ids, "fp": [_signed(fingerprint(t)) for t in texts]}],
        "doc_id long, fp long")


def _masks() -> list[int]:
    """Bits of every pair of blocks."""
    block = [((1 << BLOCK_BITS) - 1) << (BLOCK_BITS * b) for b in range(64 // BLOCK_BITS)]
    return [block[a] | block[b] for a in range(4) for b in range(a + 1, 4)]


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b), a > b, whose components are those of all pairs of ``fp`` within
    ``DISTANCE``; every row is a verified pair. ``fps``: distinct fingerprints."""
    spark = fps.sparkSession
    masks = _masks()
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pair"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
        for i, m in enumerate(masks)])).alias("k")).select("k.pair", "k.bits", "fp")
    sizes = keyed.groupBy("pair", "bits").agg(F.count("*").alias("n")).where("n > 1")
    sizes = written(spark, sizes, "buckets")
    few = keyed.join(sizes.where(F.col("n") <= BUCKET).drop("n"), ["pair", "bits"], "left_semi")
    left, right = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    near = left.join(right, ["pair", "bits"]).where(
        (F.col("a") > F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)).select("a", "b")
    crowded = keyed.join(sizes.where(F.col("n") > BUCKET).drop("n"), ["pair", "bits"], "left_semi")
    flips = [[_signed(1 << b) for b in range(64) if not m >> b & 1] for m in masks]
    table = F.array(*[F.array(*[F.lit(v) for v in [0, *row]]) for row in flips])
    variants = crowded.select("pair", "fp", F.explode(
        F.transform(table[F.col("pair")], lambda v: F.col("fp").bitwiseXOR(v))).alias("variant"))
    met = variants.groupBy("pair", "variant").agg(F.collect_set("fp").alias("fps"))
    stars = met.where(F.size("fps") > 1).select(
        F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where(
        (F.col("a") > F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))
    return near.unionByName(stars).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node are tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    below = edges.join(least, "a").where("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return below.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(a, b): each linked node but the smallest of its component, and that smallest node."""
    spark = edges.sparkSession
    edges = written(spark, edges, "links")
    state = None
    for _ in range(max_rounds):
        sums = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == state:
            return edges
        state = tuple(sums)
        if not sums[0]:
            return edges
        edges = written(spark, _small_star(_large_star(edges)), "links")
    raise RuntimeError(f"components still change after {max_rounds} rounds")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id."""
    spark = docs.sparkSession
    rows = written(spark, fingerprints(docs, doc_id, text), "fingerprints")
    fps = written(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    roots = components(links(fps.select("fp")))
    of = fps.join(roots.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
    of = of.withColumn("root", F.coalesce("root", "fp"))
    named = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(of.select("fp", "root").join(named, "root").drop("root"), "fp", "left").select(
        "doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, marked: DataFrame, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Of each component the row with the smallest id (null last), then the smallest text.

    ``marked``: for each row of ``docs`` its ``row_key``, doc_id and component (root).
    """
    spark = docs.sparkSession
    key = F.struct("_k1", "_k2")
    by_id = marked.groupBy("root", "doc_id").agg(F.min(key).alias("k"), F.count("*").alias("n"))
    best = by_id.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "k", "n")).alias("b"))
    best = written(spark, best.select("root", "b.*"), "best")
    rows = packed(docs, *row_key(doc_id, text))
    single = rows.join(
        best.where("n = 1").select("k.*"), ["_k1", "_k2"], "left_semi").select("row")
    tied = best.where("n > 1").select("root", F.col("doc_id").alias("_id"))
    if tied.isEmpty():
        return unpacked(single)
    tied = marked.join(tied, "root").where(F.col("doc_id").eqNullSafe(F.col("_id")))
    tied = tied.select("_k1", "_k2", "root").distinct()
    several = rows.join(tied, ["_k1", "_k2"]).select(
        "row", "root", F.coalesce(F.col("row").getField(text), F.lit("")).alias("t"))
    least = several.groupBy("root").agg(F.min("t").alias("t"))
    first = several.join(least, ["root", "t"], "left_semi").dropDuplicates(["root"])
    return unpacked(single.unionByName(first.select("row")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without near-duplicates: of each component the row with the smallest id.

    Rows are told apart by id and text, so rows that share an id, or have none, only go if
    another row of their own component stays.
    """
    spark = docs.sparkSession
    rows = arrow_rows(
        docs.select(*row_key(doc_id, text), F.col(doc_id).cast("long").alias("doc_id"),
                    utf8(text).alias("data")),
        lambda k1, k2, ids, texts: [{"_k1": k1, "_k2": k2, "doc_id": ids, "fp": [
            _signed(fingerprint(t)) for t in texts]}],
        "_k1 long, _k2 long, doc_id long, fp long")
    rows = written(spark, rows, "fingerprints")
    fps = written(spark, rows.select("fp").distinct(), "fps")
    roots = components(links(fps)).select(F.col("a").alias("fp"), F.col("b").alias("_b"))
    marked = rows.join(roots, "fp", "left").withColumn("root", F.coalesce("_b", "fp"))
    return keep_first(docs, written(
        spark, marked.select("_k1", "_k2", "doc_id", "root"), "marked"), doc_id, text)


def hex16(fp: str) -> Column:
    """A signed 64-bit fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

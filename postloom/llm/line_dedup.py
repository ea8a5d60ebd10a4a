"""Line dedup: two Bloom filters find suspected repeats, an exact count confirms them.

A text is split at line feeds. A line's key is the line without ASCII white space at its ends,
A-Z in lower case. A key of at least ``MIN_LENGTH`` code points that stands in at least
``MIN_DOCS`` documents loses all its lines, but for those of the largest doc_id that holds it.

Filters: every task sets ``HASHES`` bits of each key of a document in a filter of keys seen once;
a key whose bits were all set goes into a filter of keys seen twice. Filters of two tasks merge
to ``once1 | once2`` and ``twice1 | twice2 | (once1 & once2)``: a key that two documents hold is
always in the second filter, wherever they are. Segments of the filters, packed, meet in tasks
that hold a share of them; the filter of keys seen twice is broadcast. Keys outside of it end
there. Only suspected ones are shuffled, as 128-bit hashes with their document's number, and
counted exactly; a false suspect is dropped by its count.

Size: ``BITS_PER_LINE`` bits for each line that can be long enough, which are counted first, and
``max_bits`` at most (64 MB by default), which is the proven bound of the broadcast. Beyond that
bound a growing share of the lines are suspects, and results stay the same. A cluster whose
tasks can hold more raises ``max_bits``.

Defined cases: null and empty texts are one empty line, and stay as they are; every row is a
document, also where rows share an id or are equal; all rows that have the largest id of a key
keep its lines; a null id is smaller than all others, and a key that only rows without id hold
stays; an empty table gives an empty result; extra columns pass unchanged, whatever their
names (own ``n_lines`` and ``n_dropped`` are replaced).

Scale: three scans of the corpus. Shuffled are packed filters, suspects, and the texts once,
where they meet the keys they lose; with few such documents Spark broadcasts those instead. A
line that a third of all documents hold is one row in each of them, counted by a combinable
aggregate. Nothing but the filter reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm.common import (
    arrow_rows, every_column, row_key, slices, small_batches, unused, utf8, with_columns_mapped,
    written,
)

MIN_LENGTH = 40
MIN_DOCS = 5
HASHES = 2
BITS_PER_LINE = 4
MIN_BITS, MAX_BITS = 1 << 16, 1 << 29
SEGMENT = 1 << 16  # bytes of a filter that are merged together


def line_key(line: bytes, min_length: int = MIN_LENGTH) -> bytes | None:
    """Key of a line, None if it is too short. Bytes without ASCII upper case keep code points."""
    if len(line) < min_length:
        return None
    key = line.strip().lower()
    if len(key) < min_length or not (key.isascii() or len(key.decode()) >= min_length):
        return None
    return key


def line_hashes(data: bytes, min_length: int = MIN_LENGTH) -> list[bytes | None]:
    """128-bit hash of each line's key."""
    digest = xxhash.xxh3_128_digest
    return [k if k is None else digest(k)
            for k in (line_key(line, min_length) for line in data.split(b"\n"))]


def _distinct(data: bytes, min_length: int) -> set[bytes]:
    return {h for h in line_hashes(data, min_length) if h is not None}


class Filters:
    """A pair of Bloom filters: keys seen once, keys seen twice."""

    def __init__(self, bits: int) -> None:
        self.mask = np.uint64(bits - 1)
        self.once = np.zeros(bits // 8, dtype=np.uint8)
        self.twice = np.zeros(bits // 8, dtype=np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """``hashes``: two numbers of 64 bits a row, one row for each document of a key."""
        _, first, times = np.unique(hashes[:, 0], return_index=True, return_counts=True)
        places = positions(hashes[first], self.mask)
        again = (times > 1) | held(self.once, places)
        put(self.twice, places[again])
        put(self.once, places)


def positions(hashes: np.ndarray, mask: np.uint64) -> np.ndarray:
    steps = np.arange(HASHES, dtype=np.uint64)
    return (hashes[:, :1] + steps * (hashes[:, 1:] | np.uint64(1))) & mask


def held(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which rows of ``places`` have all their bits set."""
    return (bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)


def put(bits: np.ndarray, places: np.ndarray) -> None:
    flat = places.ravel()
    np.bitwise_or.at(bits, flat >> np.uint64(3),
                     np.left_shift(1, flat & np.uint64(7), dtype=np.uint64).astype(np.uint8))


def as_numbers(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), dtype="<u8").reshape(-1, 2)


_PARTS = "segment int, once binary, twice binary"


def _batches(segments: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Packed segments, a few at a time; empty ones are left out."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for i in range(0, len(segments), 16):
        some = segments[i:i + 16]
        yield pa.RecordBatch.from_arrays([
            pa.array([s for s, _, _ in some], pa.int32()),
            pa.array([pack(o.tobytes()) for _, o, _ in some], pa.binary()),
            pa.array([pack(t.tobytes()) for _, _, t in some], pa.binary()),
        ], names=["segment", "once", "twice"])


def seen_twice(docs: DataFrame, bits: int, text: str, min_length: int) -> np.ndarray:
    """The filter of keys that at least two rows of ``docs`` hold."""
    size = min(SEGMENT, bits // 8)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(bits)
        for part in (p for whole in batches for p in slices(whole)):
            found = [h for data in part.column(0).to_pylist() for h in _distinct(data, min_length)]
            if found:
                filters.add(as_numbers(found))
        cut = ((i // size, filters.once[i:i + size], filters.twice[i:i + size])
               for i in range(0, bits // 8, size))
        yield from _batches([s for s in cut if s[1].any()])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for segment, *pair in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                once, twice = (np.frombuffer(unpack(p), dtype=np.uint8) for p in pair)
                if segment not in known:
                    known[segment] = once.copy(), twice.copy()
                    continue
                all_once, all_twice = known[segment]
                all_twice |= twice | (all_once & once)
                all_once |= once
        nothing = np.zeros(0, dtype=np.uint8)
        yield from _batches([(s, nothing, t) for s, (_, t) in known.items() if t.any()])

    small_batches(docs.sparkSession)
    tasks = min(max(1, bits // 8 // size), docs.sparkSession.sparkContext.defaultParallelism)
    merged = docs.select(utf8(text).alias("data")).mapInArrow(fill, _PARTS).repartition(
        tasks, "segment").mapInArrow(merge, _PARTS)
    out = np.zeros(bits // 8, dtype=np.uint8)
    unpack = zstandard.ZstdDecompressor().decompress
    for row in merged.select("segment", "twice").collect():  # max_bits / 8 bytes at most
        out[row.segment * size:(row.segment + 1) * size] = np.frombuffer(
            unpack(bytes(row.twice)), dtype=np.uint8)
    return out


def filter_bits(docs: DataFrame, text: str, min_length: int, max_bits: int) -> int:
    """Bits for all lines that can be long enough: a power of two, ``max_bits`` at most."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.length(whole) - F.length(F.replace(whole, F.lit("\n"))) + 1
    most = F.least(lines, F.floor(F.length(whole) / min_length))
    n = docs.agg(F.sum(most)).first()[0] or 0
    return min(max_bits, max(MIN_BITS, 1 << (int(n) * BITS_PER_LINE).bit_length()))


def suspects(docs: DataFrame, bits: int, twice: np.ndarray, doc_id: str, text: str,
             min_length: int) -> DataFrame:
    """A row (_k1, _k2, doc_id, h1, h2) for each suspected key of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(twice.tobytes())
    mask = np.uint64(bits - 1)

    def make(k1: list, k2: list, ids: list, texts: list):
        known = np.frombuffer(shared.value, dtype=np.uint8)
        sets = [_distinct(t, min_length) for t in texts]
        hashes = as_numbers([h for s in sets for h in s])
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        kept = held(known, positions(hashes, mask)) if len(hashes) else np.zeros(0, dtype=bool)
        rows = owner[kept].tolist()
        h = hashes[kept].view(np.int64)
        yield {"_k1": [k1[i] for i in rows], "_k2": [k2[i] for i in rows],
               "doc_id": [ids[i] for i in rows], "h1": h[:, 0], "h2": h[:, 1]}

    return arrow_rows(
        docs.select(*row_key(doc_id, text), F.col(doc_id).cast("long").alias("doc_id"),
                    utf8(text).alias("data")),
        make, "_k1 long, _k2 long, doc_id long, h1 long, h2 long")


def drop_lines(data: str, gone: set[bytes], min_length: int = MIN_LENGTH) -> tuple[str, int]:
    """Text without the lines whose hash is in ``gone``, and the number of dropped lines."""
    raw = data.encode()
    lines, hashes = raw.split(b"\n"), line_hashes(raw, min_length)
    kept = [line for line, h in zip(lines, hashes, strict=True) if h is None or h not in gone]
    return b"\n".join(kept).decode(), len(lines) - len(kept)


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
    min_docs: int = MIN_DOCS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` without the lines that repeat across documents; adds n_lines and n_dropped."""
    spark: SparkSession = docs.sparkSession
    bits = filter_bits(docs, text, min_length, max_bits)
    twice = seen_twice(docs, bits, text, min_length)
    found = written(spark, suspects(docs, bits, twice, doc_id, text, min_length), "suspects")
    repeated = found.groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs)
    # as a table of its own, so that adaptive execution can split a common line's rows
    repeated = written(spark, repeated.drop("n"), "repeated")
    losing = found.join(repeated, ["h1", "h2"]).where(
        ~F.col("doc_id").eqNullSafe(F.col("keeper")))
    kept = docs.select(*[c for c, n in zip(every_column(docs), docs.columns, strict=True)
                         if n.lower() not in ("n_lines", "n_dropped")])
    k1, k2, gone = unused(kept, "_k1", "_k2", "_gone")
    per_row = written(spark, losing.groupBy(F.col("_k1").alias(k1), F.col("_k2").alias(k2)).agg(
        F.collect_set(F.struct("h1", "h2")).alias("gone")).select(
        k1, k2, F.transform("gone", lambda g: g["h1"]).alias("g1"),
        F.transform("gone", lambda g: g["h2"]).alias("g2")), "losing")
    key = [c.alias(n) for c, n in zip(row_key(doc_id, text), (k1, k2), strict=True)]
    joined = kept.select("*", *key).join(
        per_row.select(k1, k2, F.struct("g1", "g2").alias(gone)), [k1, k2], "left")

    def cut(texts: list, gone: list) -> dict[str, list]:
        done = []
        for t, g in zip(texts, gone, strict=True):
            if g is None:
                done.append((t, (t or "").count("\n") + 1, 0))
                continue
            pairs = np.array([g["g1"], g["g2"]], dtype="<i8").T.tobytes()
            cut_text, n = drop_lines(
                t, {pairs[i:i + 16] for i in range(0, len(pairs), 16)}, min_length)
            done.append((cut_text, t.count("\n") + 1, n))
        return {text: [d[0] for d in done], "n_lines": [d[1] for d in done],
                "n_dropped": [d[2] for d in done]}

    return with_columns_mapped(joined, cut, [text, gone], "n_lines long, n_dropped long",
                               dropped=(k1, k2, gone))

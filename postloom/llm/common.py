"""Helpers shared by the operators: Arrow tasks, words, intermediate tables, label samples."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.session import shared_dir

# A byte that is no word byte becomes a space, A-Z become a-z. In UTF-8 every byte of a
# character beyond ASCII is at least 0x80, so this is the class
# [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z only.
_WORD_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z"
    else b + 32 if "A" <= chr(b) <= "Z" else 32
    for b in range(256))


def ascii_words(data: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, letters and characters beyond ASCII."""
    return data.translate(_WORD_BYTES).split() if data else []


ROWS_AT_ONCE, BYTES_AT_ONCE = 1000, 4 << 20
_BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20,
}


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches: both ends of each task's pipe hold one.

    Settings that are smaller already stay.
    """
    for name, most in _BATCH_SETTINGS.items():
        now = spark.conf.get(name, None)
        known = int(now) if now and now.lstrip("-").isdigit() else 0
        if not 0 < known <= most:
            spark.conf.set(name, str(most))


def given_back() -> None:
    """Return freed memory of a worker that goes on to other tasks to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch that bound what a task holds as Python objects."""
    rows = max(1, min(ROWS_AT_ONCE, batch.num_rows * BYTES_AT_ONCE // max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def arrow_rows(
    df: DataFrame, make: Callable[..., Iterable[dict[str, list]]], schema: str
) -> DataFrame:
    """Run ``make(columns as lists) -> dicts of columns`` on small parts of ``df``.

    ``make`` sees bounded parts only and keeps nothing between them.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    target = to_arrow_schema(parsed)
    names = df.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            for out in make(*[batch.column(n).to_pylist() for n in names]):
                arrays = [pa.array(out[f.name], type=f.type) for f in target]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
        given_back()

    small_batches(df.sparkSession)
    return df.mapInArrow(task, parsed)


def utf8(column: str | Column) -> Column:
    """The UTF-8 bytes of a text; a null text is an empty one."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the cluster's shared folder and read it back.

    Cuts the lineage so that a lost executor never repeats the work in front, and gives
    the optimizer the true size of the table.
    """
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def every_column(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """All columns as one column ``row``, so that no name of theirs meets one of ``more``."""
    return df.select(F.struct(*every_column(df)).alias("row"), *more)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def row_key(doc_id: str, text: str) -> list[Column]:
    """Columns _k1, _k2: 128 bits that only rows with the same id and text share."""
    parts = [F.col(doc_id).isNull(), F.col(doc_id), F.coalesce(F.col(text), F.lit(""))]
    return [F.xxhash64(*parts).alias("_k1"), F.xxhash64(F.lit("second"), *parts).alias("_k2")]


def with_row_key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select("*", *row_key(doc_id, text))


def bucket_of(doc_id: str, modulus: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column,
    per_class: int, max_bytes: int, doc_id: str = "doc_id", text: str = "text",
) -> list[tuple[bytes, int]]:
    """A bounded sample of labelled whole texts for training, brought to the driver.

    Bound: ``per_class`` rows of each label, each of at most ``max_bytes`` bytes. Rows are
    taken in the order of a hash of their id, so the sample does not depend on partitions.
    Rows without label or text are left out; if an id has several labels, the largest holds.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & usable)
        .groupBy(doc_id).agg(F.max(label).alias("_label")))
    ids = known.withColumn("_rank", F.xxhash64(doc_id))
    picked = None
    for value in (0, 1):
        part = ids.where(F.col("_label") == value).orderBy("_rank", doc_id).limit(2 * per_class)
        picked = part if picked is None else picked.unionByName(part)
    rows = picked.select(F.col(doc_id).alias("_id"), "_label", "_rank").collect()
    spark = docs.sparkSession
    chosen = spark.createDataFrame(
        [(r["_id"], r["_label"], r["_rank"]) for r in rows], "_id long, _label int, _rank long")
    texts = docs.select(F.col(doc_id).alias("_id"), utf8(text).alias("_text")).where(
        (F.octet_length("_text") > 0) & (F.octet_length("_text") <= max_bytes))
    found = texts.join(F.broadcast(chosen), "_id")
    result = []
    for value in (0, 1):
        part = found.where(F.col("_label") == value).orderBy("_rank", "_text").limit(per_class)
        result += [(bytes(r["_text"]), value) for r in part.select("_text").collect()]
    return result


def with_columns_mapped(
    df: DataFrame, make: Callable[..., dict[str, list]], inputs: list[str], added: str,
    replaced: tuple[str, ...] = (), dropped: tuple[str, ...] = (),
) -> DataFrame:
    """Add or replace columns from batches of ``inputs``; all other columns pass unchanged."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    extra = _parse_datatype_string(added) if added else StructType()
    kept = StructType([f for f in df.schema if f.name not in dropped])
    schema = StructType([*kept, *[f for f in extra if f.name not in replaced]])
    target = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            out = make(*[batch.column(n).to_pylist() for n in inputs])
            arrays = [
                pa.array(out[f.name], type=f.type) if f.name in out else batch.column(f.name)
                for f in target]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)
        given_back()

    small_batches(df.sparkSession)
    return df.mapInArrow(task, schema)

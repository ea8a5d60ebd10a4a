"""Readers.  A missing or unreadable source is an empty frame, not an error."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.nulls import normalize_nulls
from postloom.operators.spread import spread
from postloom.sources.json_array import array_records

# Analysis errors that mean "there is nothing to read there".
_ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"}


def _or_empty(spark: SparkSession, schema: T.StructType, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        condition = (error.getCondition() or "").split(".")[0]
        if condition not in _ABSENT:
            raise
        return spark.createDataFrame([], schema)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold one JSON array each, with ``record_no`` = order of file and position.

    A file is read in parts by many tasks (see :mod:`postloom.sources.json_array`); a
    broken file has no rows.
    """
    numbered = _numbered(schema)

    def read() -> DataFrame:
        records = array_records(spark, path)
        # one row per file: its number, in the order of names
        named = spark.read.option("lineSep", "}").text(path).select(
            F.col("_metadata.file_path").alias("file")).distinct()
        ranked = named.select("file", (F.row_number().over(Window.orderBy("file")) - 1).alias("__no"))
        place = F.col("__no") * F.lit(1 << 40).cast("long") + F.col("pos")
        return records.join(ranked, "file").select(
            place.alias("record_no"), F.from_json("json", schema).alias("r")).select(
            "record_no", "r.*")

    return normalize_nulls(_or_empty(spark, numbered, read))


def _numbered(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("record_no", T.LongType())] + schema.fields)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines, in splits of any size."""
    return normalize_nulls(
        _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; quotes are doubled and text may span lines."""
    def read() -> DataFrame:
        return spark.read.options(header=True, escape='"', multiLine=True).schema(schema).csv(path)

    return normalize_nulls(_or_empty(spark, schema, read))


def read_landed(spark: SparkSession, root: str, source: str, schema: T.StructType) -> DataFrame:
    """Landed days of a source; a filter on ``ingest_date`` prunes folders."""
    with_day = T.StructType(schema.fields + [T.StructField("ingest_date", T.DateType())])
    return _or_empty(
        spark, with_day,
        lambda: spark.read.schema(with_day).json(f"{root}/source={source}"))


def stream_landed(spark: SparkSession, root: str, source: str, schema: T.StructType) -> DataFrame:
    """Landed days of a source as a stream: every new file is read once."""
    with_day = T.StructType(schema.fields + [T.StructField("ingest_date", T.DateType())])
    return spark.readStream.schema(with_day).json(f"{root}/source={source}")


_TYPE_WORD = re.compile(r"`(?:[^`]|``)*`|\b(OBJECT(?=<)|VARIANT|VOID|DECIMAL\(\d+,\d+\))(?!:)")
_TYPE_NAMES = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}


def _as_variant(table: DataFrame, payload: str) -> Column:
    is_text = isinstance(table.schema[payload].dataType, T.StringType)
    return F.try_parse_json(payload) if is_text else F.col(payload)


def payload_schema(
    table: DataFrame, payload: str = "raw_data", max_keys: int = 2_000,
) -> T.StructType:
    """Union of the keys of all payloads that are objects, at any depth, in order of names.

    One pass with an aggregate that merges schemas, combined before the shuffle; what
    reaches the driver is one line.  Values of different kinds under one key are read as
    text (objects and lists as JSON), numbers of different kinds as doubles.  More than
    ``max_keys`` keys at the top mean that keys are data, which is an error.
    """
    objects = table.select(_as_variant(table, payload).alias("v")).where(
        F.schema_of_variant("v").startswith("OBJECT<"))
    merged = objects.agg(F.schema_of_variant_agg("v")).first()[0]
    if not merged or not merged.startswith("OBJECT<"):
        return T.StructType()
    ddl = _TYPE_WORD.sub(lambda m: m[0] if m[1] is None else _TYPE_NAMES.get(m[1], "DOUBLE"), merged)
    schema = table.sparkSession.range(0).select(F.lit(None).cast(ddl).alias("r")).schema["r"].dataType
    if len(schema) > max_keys:
        raise ValueError(f"more than {max_keys} keys")
    return schema


def _one_column_a_name(df: DataFrame) -> DataFrame:
    """Columns whose names differ in case only become one: the first that has a value.

    The first column keeps its name to itself.
    """
    groups: dict[str, list[int]] = {}
    for i, name in enumerate(df.columns):
        groups.setdefault(name.lower(), []).append(i)
    if len(groups) == len(df.columns):
        return df
    groups[df.columns[0].lower()] = [0]
    fields = df.schema.fields
    numbered = df.toDF(*[f"c{i}" for i in range(len(fields))])
    out = []
    for places in groups.values():
        same = len({fields[i].dataType.simpleString() for i in places}) == 1
        values = [F.col(f"c{i}") if same else F.col(f"c{i}").cast("string") for i in places]
        out.append(F.coalesce(*values).alias(fields[places[0]].name))
    return numbered.select(*out)


def parse_raw(
    table: DataFrame, schema: T.StructType | None = None, payload: str = "raw_data",
) -> DataFrame:
    """Records of a table with one semi-structured column (text or VARIANT).

    Rows without a payload are left out.  Such a table has no order, so
    ``record_no`` is a hash of the payload: the same on every run and cluster.
    Without a schema the records have the keys of all payloads (:func:`payload_schema`).
    """
    rows = table.where(F.col(payload).isNotNull())
    if schema is None:
        schema = payload_schema(table, payload)
        value = _as_variant(table, payload)
        rows = rows.where(F.schema_of_variant(value).startswith("OBJECT<"))
        record, identity = value.try_cast(schema), F.to_json(value)
        if not schema.fields:
            return table.sparkSession.createDataFrame([], _numbered(schema))
    elif isinstance(table.schema[payload].dataType, T.StringType):
        record, identity = F.from_json(payload, schema), F.col(payload)
    else:
        record, identity = F.col(payload).try_cast(schema), F.to_json(payload)
    order = F.col("record_no") if "record_no" in table.columns else F.xxhash64(identity)
    parsed = rows.select(order.alias("record_no"), record.alias("r"))
    parsed = parsed.where("r is not null").select("record_no", "r.*")
    parsed = normalize_nulls(_one_column_a_name(parsed))
    return spread(parsed, "record_no")


def load_raw(
    spark: SparkSession, table: str, schema: T.StructType | None = None, payload: str = "raw_data",
) -> DataFrame:
    """:func:`parse_raw` of a catalog table."""
    numbered = _numbered(schema or T.StructType())
    return _or_empty(spark, numbered, lambda: parse_raw(spark.table(table), schema, payload))


def _parsed(spark: SparkSession, schema: str) -> T.StructType:
    return spark.range(0).select(F.from_json(F.lit(""), schema).alias("r")).select("r.*").schema


def read_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, partition columns included, that may not exist yet."""
    parsed = _parsed(spark, schema)
    return _or_empty(spark, parsed, lambda: spark.read.schema(parsed).parquet(path))


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, partition columns included, that may not exist yet."""
    parsed = _parsed(spark, schema)
    return _or_empty(spark, parsed, lambda: spark.read.schema(parsed).json(path))


def read_state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Result of an earlier run as keyed state."""
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path))

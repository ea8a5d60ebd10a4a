"""Registered queries that write through a sink and read back through a source."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import queries as Q
from postloom.functions import enrich
from postloom.operators import merge, reports
from postloom.plans.specs import SOURCES, STAGING_COLUMNS
from postloom.plans.standardize import classify, prepare, standardize
from postloom.session import shared_dir
from postloom.sources import readers, writers
from postloom.sources.bucketed import BucketedState
from postloom.sources.schemas import RAW_SCHEMAS

#: Records of one written array file.
ARRAY_RECORDS = 250
CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_mktsegment")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def land_and_standardize(spark: SparkSession, sf: str) -> DataFrame:
    """Two landed days, two runs each, of records without a number; the keys that stay.

    Which of several equal keys is kept follows a hash, so only the keys are compared.
    """
    root = _folder(spark, "landed")
    raw = Q.raw_records(spark, sf, "jooble")
    for day in range(2):
        for run in range(2):
            part = raw.where(F.col("record_no") % 4 == 2 * day + run).drop("record_no")
            writers.land(part, root, "jooble", dt.date(2026, 9, 14 + day), f"run-{run}")
    landed = readers.read_landed(spark, root, "jooble", RAW_SCHEMAS["jooble"])
    done = standardize(landed, SOURCES["jooble"], Q.AS_OF, Q.VOCABULARY)
    return done.select("company_name", "job_title")


def raw_variant(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table with one VARIANT column, parsed back to records."""
    path = _folder(spark, "variant")
    raw = Q.raw_records(spark, sf, "jooble")
    payload = F.to_json(F.struct(*[c for c in raw.columns if c != "record_no"]))
    raw.select("record_no", F.when(F.col("url") != "", F.parse_json(payload)).alias("raw_data")
               ).write.parquet(path)
    parsed = readers.parse_raw(spark.read.parquet(path), RAW_SCHEMAS["jooble"])
    return parsed.select("record_no", "title", "company", "location", "date", "snippet", "url")


def json_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one JSON array each, and a source that does not exist."""
    path = _folder(spark, "arrays")
    customers = Q.table(spark, sf, "customer").select(*CUSTOMER_COLUMNS)
    number = F.floor(F.col("c_custkey") / ARRAY_RECORDS)
    arrays = customers.groupBy(number.alias("file_no")).agg(
        F.to_json(F.collect_list(F.struct(*CUSTOMER_COLUMNS))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    read = readers.read_json_array(spark, path, customers.schema)
    absent = readers.read_json_array(spark, f"{path}-absent", customers.schema)
    both = read.unionByName(absent)
    # every record has a number of its own, over all files
    return both.groupBy("record_no").agg(
        *[F.max(c).alias(c) for c in CUSTOMER_COLUMNS]).drop("record_no")


def archive_appends(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs added to one archive."""
    path = _folder(spark, "archive")
    events = Q.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    for rest in range(2):
        writers.append_archive(events.where(F.col("event_id") % 2 == rest), path)
    return readers.read_json_lines(spark, path, events.schema)


def merged_state(spark: SparkSession, sf: str) -> DataFrame:
    """Merged rows written as state and read by the next run."""
    path = _folder(spark, "state")
    merged = Q.merge_first_last_seen(spark, sf).drop("change")
    writers.write_staging_json(merged, path)
    return readers.read_state(spark, path, merged.schema)


def merge_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge into a state of hash buckets, in two batches."""
    keys = ("user_id", "event_type")
    existing, batch = Q.event_batches(spark, sf)
    schema = existing.schema
    state = BucketedState(spark, _folder(spark, "buckets"), schema, keys, 16)
    state.replace(existing, range(16))
    for half in range(2):
        part = batch.where(F.pmod("user_id", F.lit(2)) == half)
        state.merge(part, F.lit(Q.NOW), ["ts", "event_id"])
    return state.read().select(
        *keys, "event_id", "value", Q.stamp("first_seen"), Q.stamp("last_seen"))


def staging_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "csv")
    done = Q.standardized(spark, sf, "jooble")
    writers.write_staging_csv(done, path)
    schema = Q.as_csv(done).schema
    rows = readers.read_csv(spark, path, schema).select(*STAGING_COLUMNS)
    # CSV does not tell an empty text from none
    return rows.withColumn("skills", F.coalesce("skills", F.lit("")))


def staging_table(spark: SparkSession, sf: str) -> DataFrame:
    """Full refresh of a table: the second load replaces the first, an empty one does nothing."""
    name = f"staging_{uuid.uuid4().hex}"
    writers.write_staging_table(Q.standardized(spark, sf, "freehire"), name)
    done = Q.standardized(spark, sf, "jooble")
    writers.write_staging_table(done, name)
    writers.write_staging_table(done.where("false"), name)
    return spark.table(name)


def saved_links(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "links")
    links = Q.found_links(spark, sf)
    writers.save_seen_links(links, path)
    return readers.read_json_lines(spark, path, links.select("url").schema)


def record_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of records as one text, some of their parts missing."""
    orders = Q.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("o_custkey"))
    return orders.select(
        "o_orderkey", merge.record_key("o_orderstatus", "o_custkey").alias("record_key"))


def excluded_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Skip report of a source of which some postings are the excluded pair."""
    is_pair = F.col("record_no") % 6 == 0
    raw = Q.raw_records(spark, sf, "tapneo").withColumns({
        "CompanyName": F.when(is_pair, "AtkinsR").otherwise(F.col("CompanyName")),
        "JobDescription": F.when(is_pair, F.concat(
            F.lit("Job Title: Project Manager "), "JobDescription"))
        .otherwise(F.col("JobDescription"))})
    spec = SOURCES["tapneo"]
    return reports.skip_report(classify(prepare(raw, spec, Q.VOCABULARY), spec))


def _level() -> Column:
    number = F.col("record_no") % 5
    return enrich.education(F.concat(
        "description", F.when(number == 0, " PhD or more").when(number == 1, " a Diploma")
        .when(number == 2, " دكتوراه").otherwise("")))


education_levels = Q._column("level", _level)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in (
    land_and_standardize, raw_variant, json_arrays, archive_appends, merged_state, merge_bucketed,
    staging_csv, staging_table, saved_links, record_keys, excluded_postings)}
QUERIES["education_levels"] = education_levels

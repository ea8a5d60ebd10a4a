"""API responses -> raw records of a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import wordlists as W
from postloom.functions.nulls import first_filled
from postloom.functions.predicates import is_tech_title
from postloom.functions.places import is_country_match, is_domestic_location
from postloom.functions.regex import strip

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _or(column: str, default: str) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def first_url(*links: Column) -> Column:
    """First link that is not blank, trimmed."""
    return first_filled(*[strip(link) for link in links])


def freehire_records(api: DataFrame, extracted_at: Column) -> DataFrame:
    d = W.FREEHIRE_DEFAULTS
    empty = F.array().cast("array<string>")
    return api.select(
        _or("title", d["title"]).alias("job_title"),
        _or("company", d["company"]).alias("company_name"),
        _or("location", d["location"]).alias("location"),
        F.coalesce("cities", empty).alias("cities"),
        first_filled(F.col("posted_at"), _or("created_at", d["date"])).alias("posted_date"),
        F.coalesce("enrichment.category", F.lit(d["category"])).alias("category"),
        F.coalesce("skills", empty).alias("skills"),
        _or("description", d["description"]).alias("job_description"),
        F.col("url").alias("source_url"),
        _or("source", d["source"]).alias("original_source"),
        F.date_format(extracted_at, TIME_FORMAT).alias("extracted_at"),
    )


def jooble_records(api: DataFrame, extracted_at: Column) -> DataFrame:
    """Technical, domestic postings of a response."""
    accepted = api.where(is_tech_title(F.col("title")) & is_domestic_location(F.col("location")))
    return accepted.select(
        _or("title", "").alias("title"), "company", "location",
        F.col("updated").alias("date"), "salary", "snippet", F.col("link").alias("url"),
        F.lit("jooble").alias("source"), F.col("_search_location").alias("search_location"),
        F.date_format(extracted_at, TIME_FORMAT).alias("extracted_at"),
    )


def jsearch_records(api: DataFrame, extracted_at: Column) -> DataFrame:
    """Domestic postings of a response that have a link."""
    d = W.JSEARCH_DEFAULTS
    links = [F.col(c) for c in ("job_apply_link", "job_google_link", "job_link")]
    places = [F.col(c) for c in ("job_location", "job_city", "job_state")]
    accepted = api.where(is_country_match(F.col("job_country"), *places))
    records = accepted.select(
        _or("job_title", d["title"]).alias("title"),
        _or("employer_name", d["company"]).alias("company"),
        _or("job_location", d["location"]).alias("location"),
        F.col("job_posted_at_datetime_utc").alias("date"),
        F.col("job_min_salary").alias("salary"),
        # the snippet is a field of the raw record: this many characters by definition
        F.substring(_or("job_description", ""), 1, W.JSEARCH_SNIPPET_CHARS).alias("snippet"),
        first_url(*links).alias("url"),
        _or("job_employment_type", d["employment_type"]).alias("employment_type"),
        F.lit("jsearch").alias("source"),
        F.date_format(extracted_at, TIME_FORMAT).alias("extracted_at"),
    )
    return records.where("url is not null")

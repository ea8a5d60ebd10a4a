"""Explicit schemas of landed and staged records."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _texts(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.StringType()))


_SEEN = _text("first_seen", "last_seen")

RAW_SCHEMAS = {
    "jooble": T.StructType(_text(
        "title", "company", "location", "date", "salary", "snippet", "url", "source",
        "search_location", "extracted_at") + _SEEN),
    "jsearch": T.StructType(_text(
        "title", "company", "location", "date", "salary", "snippet", "url", "employment_type",
        "source", "extracted_at",
        "job_title", "employer_name", "job_city", "city", "job_location", "job_description",
        "job_apply_link", "job_posted_at", "job_employment_type")),
    "freehire": T.StructType(_text(
        "job_title", "company_name", "location", "posted_date", "category", "job_description",
        "source_url", "original_source", "extracted_at") + [_texts("cities"), _texts("skills")]),
    "tanqeeb": T.StructType(_text(
        "job_title", "company_name", "location", "posted_date", "employment_type",
        "job_description", "job_url", "url", "source_url", "source", "extracted_at")),
    "tapneo": T.StructType(_text(
        "CompanyName", "company_name", "JobDescription", "job_description", "job_location",
        "job_city", "PostedAt", "posted_date", "EmploymentType", "employment_type",
        "source_url", "job_url")),
}

# Responses of the two job APIs and of the direct endpoint, before they are mapped.
API_SCHEMAS = {
    "jooble": T.StructType(_text(
        "title", "company", "location", "updated", "salary", "snippet", "link",
        "_search_location")),
    "jsearch": T.StructType(_text(
        "job_title", "employer_name", "job_location", "job_city", "job_state", "job_country",
        "job_posted_at_datetime_utc", "job_min_salary", "job_description", "job_apply_link",
        "job_google_link", "job_link", "job_employment_type")),
    "freehire": T.StructType(_text(
        "title", "company", "location", "posted_at", "created_at", "description", "url",
        "source") + [
            _texts("cities"), _texts("skills"),
            T.StructField("enrichment", T.StructType(_text("category")))]),
}

STAGING = T.StructType(
    _text("job_title", "company_name", "city", "country", "posted_date", "employment_type",
          "education", "job_description") + [_texts("skills")] + _text("job_url"))
STAGING_SEEN = T.StructType(STAGING.fields + [
    T.StructField("first_seen", T.TimestampType()), T.StructField("last_seen", T.TimestampType())])
SEEN_URLS = T.StructType(_text("url"))
PAGES = T.StructType(_text("url", "html"))

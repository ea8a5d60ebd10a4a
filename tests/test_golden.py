"""A small day of postings, written out by hand, through the whole standardisation."""

import datetime as dt
import json

import pytest

from postloom.functions import places, skills
from postloom.plans.specs import SOURCES
from postloom.plans.standardize import classify, prepare, standardize
from postloom.sources import readers
from postloom.sources.schemas import RAW_SCHEMAS

LONG = "We look for a person who keeps our systems running and who likes to learn new things. "
RAW = [
    {"title": "Platform Engineer (Remote)", "company": "Client of North Sea Data", "location": "Riyadh, Saudi Arabia",
     "date": "2026-08-05T07:54:34.1930000", "url": "https://jobs.example.com/1",
     "snippet": f"About the Role {LONG}<b>Python </b>and&nbsp;SQL server; a Bachelor degree."},
    {"title": "Jeddah - Security Analyst, Saudi Arabia", "company": "Harbour", "location": "",
     "search_location": "Jeddah", "date": "Wednesday, 5 August 2026", "url": "https://jobs.example.com/2",
     "snippet": f"Job Summary: {LONG}OWASP top 10, part time. <template>Hidden <p>java</p></template>"},
    {"title": "Platform Engineer", "company": "North Sea Data", "location": "Al Khobar", "date": "2026-08-09",
     "url": "https://jobs.example.com/3", "snippet": LONG + "The same posting again."},
    {"title": "Accountant", "company": "Harbour", "location": "Riyadh", "date": "2026-08-05",
     "url": "ftp://jobs.example.com/4", "snippet": LONG},
    {"title": "Data Engineer", "company": "Short", "location": "Riyadh", "date": "2026-08-05",
     "url": "https://jobs.example.com/5", "snippet": "Too short."},
    {"title": "Cloud Engineer", "company": "nan", "location": "LinkedIn", "date": "yesterday",
     "url": "https://jobs.example.com/6", "snippet": f"{LONG}Kubernetes, Docker and a PhD; contract."},
]
EXPECTED = [
    {"job_title": "Platform Engineer", "company_name": "North Sea Data", "city": "Riyadh", "country": "Saudi Arabia",
     "posted_date": "2026-08-05", "employment_type": "Full-time", "education": "Bachelor",
     "job_description": LONG + "Python and SQL server; a Bachelor degree.",
     "skills": ["python", "sql", "sql server"], "job_url": "https://jobs.example.com/1"},
    {"job_title": "Security Analyst", "company_name": "Harbour", "city": "Jeddah", "country": "Saudi Arabia",
     "posted_date": "2026-08-05", "employment_type": "Part-time", "education": None,
     "job_description": LONG + "OWASP top 10, part time.", "skills": ["owasp", "owasp top 10"],
     "job_url": "https://jobs.example.com/2"},
    {"job_title": "Cloud Engineer", "company_name": None, "city": None, "country": "Saudi Arabia",
     "posted_date": None, "employment_type": "Contract", "education": "PhD",
     "job_description": LONG + "Kubernetes, Docker and a PhD; contract.",
     "skills": ["docker", "kubernetes"], "job_url": "https://jobs.example.com/6"},
]
DROPPED = {4: "bad_url", 5: "short_description"}


def raw(spark, schema=RAW_SCHEMAS["jooble"]):
    rows = [(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(RAW, 1)]
    return readers.parse_raw(spark.createDataFrame(rows, "record_no long, raw_data string"), schema)


@pytest.mark.parametrize("kind", ["schema", "union of keys", "tables"])
def test_a_day_of_postings(spark, kind):
    records = raw(spark) if kind == "schema" else raw(spark, None)
    options = {}
    if kind == "tables":
        terms = spark.createDataFrame([(t,) for t in skills.STARTER.terms], "term string")
        options = {"vocabulary": skills.SkillTable(terms), "cities": places.city_dictionary(spark)}
    got = standardize(records, SOURCES["jooble"], dt.date(2026, 9, 1), **options)
    rows = sorted((r.asDict() for r in got.drop("source").collect()), key=lambda r: r["job_url"])
    assert [{k: list(v) if k == "skills" else v for k, v in r.items()} for r in rows] == EXPECTED


def test_the_day_as_one_array_file(spark, tmp_path):
    (tmp_path / "day.json").write_text(json.dumps(RAW, ensure_ascii=False), "utf-8")
    records = readers.read_json_array(spark, str(tmp_path / "day.json"), RAW_SCHEMAS["jooble"])
    got = standardize(records, SOURCES["jooble"], dt.date(2026, 9, 1))
    assert sorted(r.job_url for r in got.collect()) == [r["job_url"] for r in EXPECTED]


def test_reasons_of_dropped_postings(spark):
    classified = classify(prepare(raw(spark), SOURCES["jooble"]), SOURCES["jooble"])
    assert {r.record_no: r.skip_reason for r in classified.collect() if r.skip_reason} == DROPPED

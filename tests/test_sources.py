import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.plans import marts, pipeline
from postloom.plans.search import search_plan
from postloom.plans.specs import SOURCES, STAGING_COLUMNS
from postloom.plans.standardize import classify, prepare, standardize
from postloom.sources import readers, records, writers
from postloom.sources.schemas import API_SCHEMAS, RAW_SCHEMAS, STAGING_SEEN

NOW = dt.datetime(2026, 9, 15, 12)
DAY = dt.date(2026, 9, 15)
LONG = "We build reliable software with Python and SQL server for many happy customers."


def posting(**changes):
    base = {
        "title": "Data Engineer - Riyadh", "company": "Client of ACME", "location": "Riyadh",
        "date": "2026-08-05T07:54:34.1930000", "salary": "", "snippet": f"<b>{LONG}</b>&nbsp;",
        "url": "https://jobs.example.com/1", "source": "jooble", "search_location": "Jeddah"}
    return {**base, **changes}


def dump(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_array(spark, tmp_path):
    text = json.dumps([posting(), posting(company=float("nan"), salary=5000), {"title": "t"}])
    df = readers.read_json_array(spark, dump(tmp_path / "a.json", text), RAW_SCHEMAS["jooble"])
    got = {r["record_no"]: r for r in df.collect()}
    assert sorted(got) == [0, 1, 2]
    assert got[1]["company"] is None and got[1]["salary"] == "5000"
    assert got[2]["url"] is None


def test_missing_and_broken_files_are_empty(spark, tmp_path):
    schema = RAW_SCHEMAS["jooble"]
    assert readers.read_json_array(spark, str(tmp_path / "no.json"), schema).count() == 0
    broken = dump(tmp_path / "b.json", '[{"title": "x"')
    assert readers.read_json_array(spark, broken, schema).where("title is not null").count() == 0
    assert readers.read_json_array(spark, dump(tmp_path / "c.json", "oops"), schema).count() == 0
    assert readers.load_raw(spark, "no_such_table", schema).count() == 0
    assert readers.read_state(spark, str(tmp_path / "none"), STAGING_SEEN).count() == 0


def test_raw_table_of_text_and_variant(spark):
    rows = spark.createDataFrame([(json.dumps(posting()),), (None,)], "raw_data string")
    schema = RAW_SCHEMAS["jooble"]
    as_text = readers.parse_raw(rows, schema).drop("record_no").collect()
    variant = rows.select(F.parse_json("raw_data").alias("raw_data"))
    assert readers.parse_raw(variant, schema).drop("record_no").collect() == as_text
    assert len(as_text) == 1 and as_text[0]["company"] == "Client of ACME"
    rows.createOrReplaceTempView("raw_jobs")
    assert readers.load_raw(spark, "raw_jobs", schema).count() == 1


def test_landing_replaces_one_day_only(spark, tmp_path):
    root = str(tmp_path / "raw")
    first = spark.createDataFrame([("a", "jooble")], "url string, source string")
    second = spark.createDataFrame([("b", "jooble")], "url string, source string")
    writers.land(first, root, "jooble", dt.date(2026, 9, 14))
    writers.land(first, root, "jooble", DAY)
    writers.land(second, root, "jooble", DAY)
    landed = readers.read_landed(spark, root, "jooble", T.StructType(
        [T.StructField("url", T.StringType())]))
    assert sorted(map(tuple, landed.collect())) == [("a", dt.date(2026, 9, 14)), ("b", DAY)]
    writers.land(first, root, "tanqeeb", DAY, run_id="r1")
    writers.land(second, root, "tanqeeb", DAY, run_id="r2")
    assert spark.read.json(f"{root}/source=tanqeeb").count() == 2


def test_archive_and_links(spark, tmp_path):
    one = spark.createDataFrame([("b",), ("a",), ("a",)], "url string")
    writers.append_archive(one, str(tmp_path / "archive"))
    writers.append_archive(one, str(tmp_path / "archive"))
    assert spark.read.json(str(tmp_path / "archive")).count() == 6
    writers.save_seen_links(one, str(tmp_path / "links"))
    assert sorted(r["url"] for r in spark.read.json(str(tmp_path / "links")).collect()) == ["a", "b"]


RAW = [
    posting(),
    posting(url="https://jobs.example.com/2", snippet=LONG + " Second."),  # same company, title
    posting(title="Solutions Architect"),
    posting(title="Analyst", snippet="short"),
    posting(title="Analyst", url="ftp://x"),
    posting(title="Analyst", url=None, snippet=LONG),
    posting(title="ML Engineer", company=None, location="", url="https://jobs.example.com/3"),
]


def raw_frame(spark, rows=RAW, source="jooble"):
    data = [json.dumps(r) for r in rows]
    table = spark.createDataFrame(list(enumerate(data)), "record_no long, raw_data string")
    return readers.parse_raw(table, RAW_SCHEMAS[source])


def test_standardize_one_source(spark):
    got = standardize(raw_frame(spark), SOURCES["jooble"], DAY).collect()
    assert sorted((r["job_title"], r["company_name"] or "", r["city"], r["job_url"][-1]) for r in got) == [
        ("Data Engineer", "ACME", "Riyadh", "1"), ("ML Engineer", "", "Jeddah", "3")]
    first = next(r for r in got if r["company_name"] == "ACME")
    assert first["job_description"] == LONG
    assert first["skills"] == ["python", "sql", "sql server"]
    assert (first["posted_date"], first["employment_type"], first["education"], first["country"]) == (
        "2026-08-05", "Full-time", None, "Saudi Arabia")


def test_skip_report(spark):
    spec = SOURCES["jooble"]
    report = pipeline.skip_report(classify(prepare(raw_frame(spark), spec), spec))
    assert sorted(map(tuple, report.collect())) == [
        ("jooble", "bad_url", 2), ("jooble", "non_tech", 1), ("jooble", "short_description", 1)]


def test_other_sources(spark):
    free = [{"job_title": "Data Engineer (Remote)", "company_name": "A", "cities": ["جدة"],
             "category": "contract", "skills": ["Node.js", "SQL"], "job_description": LONG,
             "source_url": "https://x/1", "posted_date": "2026-08-05"},
            {"job_title": "Urban Planner", "job_description": LONG, "source_url": "https://x/2"},
            {"job_title": "Analyst", "job_description": LONG + " Based in Tabuk.", "cities": [],
             "source_url": "https://x/3"}]
    got = standardize(raw_frame(spark, free, "freehire"), SOURCES["freehire"], DAY).collect()
    assert sorted((r["city"], r["employment_type"], tuple(r["skills"])) for r in got) == [
        ("Jeddah", "Contract", ("node.js", "python", "sql", "sql server")),
        ("Tabuk", "Full-time", ("python", "sql", "sql server"))]

    search = [{"title": "Data Engineer", "company": "A", "snippet": LONG, "url": "https://x/1",
               "date": "3 days ago", "location": "Dammam"},
              {"title": "Data Engineer", "snippet": LONG + " U.S. Citizen", "url": "https://x/2"},
              {"job_title": "Analyst", "employer_name": "B", "job_description": LONG,
               "job_apply_link": "https://x/3", "job_city": "Abha", "date": "2026-08-05"}]
    got = standardize(raw_frame(spark, search, "jsearch"), SOURCES["jsearch"], DAY).collect()
    assert sorted((r["job_title"], r["city"], r["posted_date"]) for r in got) == [
        ("Analyst", "Abha", "2026-08-05"), ("Data Engineer", "Dammam", "2026-09-12")]

    file_based = [{"CompanyName": "A", "JobDescription": "<p>data engineer, MBA</p>",
                   "job_location": "Riyadh • x", "PostedAt": "08/05/2026"},
                  {"company_name": "AtkinsR", "job_description": "project manager"},
                  {"company_name": "B", "job_description": "cook"}]
    got = standardize(raw_frame(spark, file_based, "tapneo"), SOURCES["tapneo"], DAY).collect()
    assert [(r["job_title"], r["city"], r["posted_date"], r["education"]) for r in got] == [
        ("Data Engineer", "Riyadh", "2026-08-05", "Master")]

    crawled = [{"job_title": "★ Admin", "job_description": "cloud", "job_url": "u1"},
               {"job_title": "Nurse", "job_description": "python", "job_url": "u2"},
               {"job_title": None, "job_description": "python", "url": "u3"}]
    got = standardize(raw_frame(spark, crawled, "tanqeeb"), SOURCES["tanqeeb"], DAY).collect()
    assert sorted((r["job_title"] or "", r["job_url"]) for r in got) == [("", "u3"), ("Admin", "u1")]


def test_run_all_writes_every_layer(spark, tmp_path):
    out = str(tmp_path / "staging")
    spec = {"jooble": SOURCES["jooble"], "tanqeeb": SOURCES["tanqeeb"]}
    postings, counts, skipped = pipeline.run_all(
        spark, out, NOW, DAY, specs=spec, raw={"jooble": raw_frame(spark)})
    assert sorted(map(tuple, counts.collect())) == [("jooble", 2)]
    assert skipped.count() == 3 and postings.count() == 2
    path = pipeline.version_path(out, spec["jooble"], NOW)
    merged = readers.read_state(spark, path, STAGING_SEEN)
    assert {(r["first_seen"], r["last_seen"]) for r in merged.collect()} == {(NOW, NOW)}
    table = spark.table("STG_JOOBLE_JOBS")
    assert table.columns == STAGING_COLUMNS and table.count() == 2
    csv = readers.read_csv(spark, f"{out}/csv/jooble", table.schema)
    assert sorted(csv.select("skills").collect()) == sorted(table.select("skills").collect())
    # a later run merges with the version before it
    later = NOW + dt.timedelta(days=1)
    result = pipeline.run_source(
        spark, spec["jooble"], out, later, DAY, raw=raw_frame(spark, RAW[:1]), previous_path=path)
    assert sorted((r["change"], r["first_seen"], r["last_seen"]) for r in result.merged.collect()) == [
        ("kept", NOW, NOW), ("updated", NOW, later)]
    # an empty result leaves the table alone
    assert not writers.write_staging_table(result.postings.where("false"), "STG_JOOBLE_JOBS")
    assert spark.table("STG_JOOBLE_JOBS").count() == 1


def frame(spark, source, rows):
    data = spark.createDataFrame([(json.dumps(r),) for r in rows], "j string")
    return data.select(F.from_json("j", API_SCHEMAS[source]).alias("r")).select("r.*")


def test_api_records(spark):
    now = F.lit(NOW)
    jooble = records.jooble_records(frame(spark, "jooble", [
        {"title": "Data Engineer", "location": "Riyadh", "link": "u", "updated": "d"},
        {"title": "Data Engineer", "location": "Austin, TX"}, {"title": "Chef"}]), now).collect()
    assert [(r["url"], r["date"], r["source"], r["extracted_at"]) for r in jooble] == [
        ("u", "d", "jooble", "2026-09-15 12:00:00")]
    jsearch = records.jsearch_records(frame(spark, "jsearch", [
        {"job_country": "sa", "job_apply_link": " ", "job_link": " https://x ",
         "job_description": "d" * 400, "job_min_salary": 10},
        {"job_country": "US", "job_city": "Paris", "job_link": "https://y"},
        {"job_country": "SA"}]), now).collect()
    assert [(r["url"], len(r["snippet"]), r["salary"], r["title"]) for r in jsearch] == [
        ("https://x", 300, "10", "بدون عنوان")]
    free = records.freehire_records(frame(spark, "freehire", [
        {"url": "u", "posted_at": "", "created_at": "c", "enrichment": {"category": "x"}},
        {"url": "v"}]), now).collect()
    assert [(r["source_url"], r["posted_date"], r["category"], r["skills"], r["job_title"]) for r in free] == [
        ("u", "c", "x", [], "غير محدد"), ("v", "غير محدد", "tech", [], "غير محدد")]


def test_search_plan(spark):
    places = spark.createDataFrame([("Riyadh",), ("Hail",)], "location string")
    assert search_plan(places).count() == 2 * 18


def test_marts(spark):
    df = spark.createDataFrame(
        [("Riyadh", "Full-time", "2026-01-01", ["sql", "aws"]), ("Riyadh", "Contract", "2026-01-05", ["sql"]),
         (None, "Full-time", "2026-01-09", []), ("Abha", "Full-time", None, None)],
        "city string, employment_type string, posted_date string, skills array<string>")
    assert sorted(map(tuple, marts.skill_demand(df).collect())) == [
        ("aws", 1, 0.25, 2), ("sql", 2, 0.5, 1)]
    cube = {tuple(r)[:3]: r["postings"] for r in marts.city_employment(df).collect()}
    assert cube[(None, None, 3)] == 4 and cube[("Riyadh", None, 1)] == 2
    assert cube[(None, "Full-time", 2)] == 3 and cube[(None, "Full-time", 0)] == 1
    days = {str(r["day"]): r["recent"] for r in marts.daily_postings(df).collect()}
    assert days == {"2026-01-01": 1, "2026-01-05": 2, "2026-01-09": 2}


def test_array_files_have_distinct_record_numbers(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text('[{"title": "%s1"}, {"title": "%s2"}]' % (name, name))
    schema = T.StructType([T.StructField("title", T.StringType())])
    rows = readers.read_json_array(spark, str(tmp_path), schema).orderBy("record_no").collect()
    assert [r.title for r in rows] == ["a1", "a2", "b1", "b2"]
    assert len({r.record_no for r in rows}) == 4


def test_saved_variant_table_is_read(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([('{"title": "x", "url": "u"}',), (None,)], "t string").select(
        F.expr("parse_json(t)").alias("raw_data")).write.parquet(path)
    rows = readers.parse_raw(spark.read.parquet(path), RAW_SCHEMAS["jooble"]).collect()
    assert [(r.title, r.url) for r in rows] == [("x", "u")]


def test_landed_records_are_standardised(spark, tmp_path):
    schema = RAW_SCHEMAS["jooble"]
    records = spark.createDataFrame([posting(), posting(company="Other")], schema)
    writers.land(records, str(tmp_path), "jooble", dt.date(2026, 9, 15))
    landed = readers.read_landed(spark, str(tmp_path), "jooble", schema)
    done = standardize(landed, SOURCES["jooble"], dt.date(2026, 9, 15)).collect()
    assert sorted((r.company_name, r.posted_date) for r in done) == [
        ("ACME", "2026-08-05"), ("Other", "2026-08-05")]
    lines = readers.read_json_lines(spark, f"{tmp_path}/source=jooble/*", schema)
    assert standardize(lines, SOURCES["jooble"], dt.date(2026, 9, 15)).count() == 2



def test_a_reader_never_misses_a_table_that_is_refreshed(spark, tmp_path):
    import threading

    name, root = "STG_REFRESHED", str(tmp_path / "tables")
    schema = ", ".join(f"{c} {'array<string>' if c == 'skills' else 'string'}" for c in STAGING_COLUMNS)

    def rows(n):
        values = [tuple([str(i)] * 8 + [["a", "b"], "u"]) for i in range(n)]
        return spark.createDataFrame(values, schema)

    assert writers.write_staging_table(rows(3), name, root)
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            seen.add(spark.table(name).count())

    reader = threading.Thread(target=read)
    reader.start()
    for n in (4, 5, 6):
        assert writers.write_staging_table(rows(n), name, root)
    stop.set()
    reader.join()
    assert seen <= {3, 4, 5, 6} and spark.table(name).count() == 6
    with pytest.raises(Exception):  # noqa: B017 - a run that dies while it writes
        writers.write_staging_table(rows(2).withColumn("city", F.raise_error(F.lit("dies"))), name, root)
    assert spark.table(name).count() == 6 and spark.table(name).first()["skills"] == "a, b"


def test_pairs_of_frequent_skills(spark):
    import itertools
    import random
    from collections import Counter

    from postloom.plans.marts import skill_pairs

    rng = random.Random(4)
    baskets = [rng.sample("abcdefgh", rng.randint(0, 5)) for _ in range(200)] + [None, ["a", "a", None]]
    df = spark.createDataFrame([(b,) for b in baskets], "skills array<string>")
    sets = [sorted({s for s in b or [] if s}) for b in baskets]
    single = Counter(s for b in sets for s in b)
    pairs = Counter(p for b in sets for p in itertools.combinations(b, 2))
    for support in (1, 30, 1000):
        got = {(r.skill, r.other): (r.postings, r.lift) for r in skill_pairs(df, support).collect()}
        assert got == {p: (n, round(n * len(sets) / (single[p[0]] * single[p[1]]), 6))
                       for p, n in pairs.items() if n >= support}


_DROPPED = {
    # source -> records that a rule on short fields or on the raw text drops
    "jooble": [("ftp://x/1", "Data Engineer", "boom"), ("https://x/1", "Civil Engineer", "boom"),
               ("https://x/1", None, "boom"), (None, "Data Engineer", "boom")],
    "jsearch": [("https://x/1", "Data Engineer", "boom, u.s. citizen only")],
    "freehire": [("https://x/1", "Urban data engineer", "boom")],
    "tapneo": [("https://x/1", "", "boom without a role"), ("https://x/1", "", None)],
    "tanqeeb": [("https://x/1", "Nurse", "boom"), ("https://x/1", "Helper", "boom of a technician")],
}
_NAMES = {
    "jooble": ("url", "title", "snippet"), "jsearch": ("url", "title", "snippet"),
    "freehire": ("source_url", "job_title", "job_description"),
    "tapneo": ("source_url", "job_title", "JobDescription"),
    "tanqeeb": ("job_url", "job_title", "job_description"),
}


@pytest.mark.parametrize("source", sorted(_DROPPED))
def test_dropped_rows_are_not_cleaned(spark, monkeypatch, source):
    import itertools

    from postloom.plans import standardize as S

    spec, long = SOURCES[source], "Senior Data Engineer for python and SQL server " * 2
    texts = [None, "", "short", long, long + "??? ", long + "? " * 6, long + "nurse", long + "cloud hr",
             long + "United States", "a civil engineer, " * 9, "computer science " * 9]
    rows = list(itertools.product(
        [None, "https://x/1", "x"], [None, "", "Data Engineer", "Sales Engineer", "urban AI"], texts))
    schema = ", ".join(f"{n} string" for n in _NAMES[source]) + ", record_no long"

    def table(records):
        return spark.createDataFrame([(*r, i) for i, r in enumerate(records)], schema)

    # rows that stay are those that no reason is reported for
    reported = S.finish(S.classify(S.prepare(table(rows), spec), spec), spec, DAY)
    ours = S.standardize(table(rows), spec, DAY)
    assert sorted(map(str, ours.collect())) == sorted(map(str, reported.collect()))
    assert ours.count() > 0

    def fails(function):
        return lambda text, *rest: F.when(F.lower(text).contains("boom"), F.raise_error(
            F.lit("worked on"))).otherwise(function(text, *rest))

    name = "extract_skills" if source == "tanqeeb" else "clean_description"
    monkeypatch.setattr(S, name, fails(getattr(S, name)))
    dropped = [("https://x/1", "Data Engineer", long), *_DROPPED[source]]
    assert S.standardize(table(dropped), spec, DAY).count() == 1

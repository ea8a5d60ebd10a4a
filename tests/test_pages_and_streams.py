import datetime as dt

from pyspark.sql import functions as F

from postloom.sources import pages, readers, writers
from postloom.streaming import links, upsert

NOW = dt.datetime(2026, 9, 15)


def page(head="", body=""):
    return f"<html><head>{head}</head><body>{body}</body></html>"


LD = '<script type="application/ld+json">{}</script>'


def test_page_links(spark):
    html = page(body="""
      <a href="/jobs/1.html?x=1">a</a> <a class="c" href='https://saudi.tanqeeb.com/jobs/2.html'>b</a>
      <a href="/jobs/1.html">again</a> <a href="#top">t</a> <a href="javascript:go()">j</a>
      <a href="">e</a> <a href=" ../jobs/3.html ">r</a> <a href=/jobs/4.html>u</a>
      <a href="https://other.example.com/jobs/5.html">o</a> <a href="/companies/jobs/6.html">c</a>
      <a href="//saudi.tanqeeb.com/jobs/7.html">s</a> <link href="/jobs/8.html">
      <a href="https://facebook.com/saudi.tanqeeb.com/jobs/9.html">f</a> <a href="/jobs/x.html">x</a>
      <a data-href="/jobs/10.html">d</a>""")
    df = spark.createDataFrame([(1, html)], "page_no long, html string")
    found = {r["url"].split("/jobs/")[1] for r in pages.page_links(df).collect()}
    assert found == {"1.html", "2.html", "3.html", "4.html", "7.html"}


def test_page_postings(spark):
    nested = ('<div class="job-meta-item">Riyadh,\n <i>KSA</i></div><a class="x job-meta-company">Shop</a>'
              '<div id="jobDescriptionBody"><div><p>one</p><div>two</div></div>\n\n<p>three</p></div><div>no</div>')
    rows = [
        ("full", page(LD.format('{"@type":"JobPosting","title":"Engineer","datePosted":"2026-01-02T03:04",'
                                '"employmentType":"FULL","hiringOrganization":{"name":"ACME"}}'), nested)),
        ("list", page(LD.format('[{"@type":"X"},{"@type":"JobPosting","title":"Analyst",'
                                '"description":"<p>a</p><p>b</p>"}]'))),
        ("html", page(LD.format("broken {"), '<h1>Other</h1><h3 class="job-title-text"> The <b>Job</b></h3>' + nested)),
        ("short", page("", "<h1>ab</h1>" + nested)),
        ("empty", page(LD.format('{"@type":"JobPosting","title":"No text"}'))),
        ("untitled", page("", nested)),
    ]
    df = spark.createDataFrame(rows, "url string, html string")
    got = {r["job_url"]: r for r in pages.page_postings(df, F.lit(NOW)).collect()}
    assert sorted(got) == ["full", "html", "list"]
    full = got["full"]
    assert (full["job_title"], full["company_name"], full["location"], full["posted_date"],
            full["employment_type"]) == ("Engineer", "ACME", "Riyadh, KSA", "2026-01-02", "FULL")
    assert full["job_description"] == "one\ntwo\nthree"
    assert got["list"]["job_description"] == "a\nb"
    assert (got["html"]["job_title"], got["html"]["company_name"], got["html"]["posted_date"]) == (
        "TheJob", "Shop", "Not Specified")


def write_batches(spark, folder, parts):
    for n, rows in enumerate(parts):
        df = spark.createDataFrame(rows, "url string, n long, title string, at timestamp")
        df.coalesce(1).write.mode("append").parquet(str(folder))


PARTS = [
    [("a", 1, "a1", dt.datetime(2026, 1, 1)), ("b", 2, "b1", dt.datetime(2026, 1, 1)), (None, 3, "x", None)],
    [("a", 4, "a2", dt.datetime(2026, 1, 2)), ("c", 5, "c1", dt.datetime(2026, 1, 2))],
    [("a", 6, "a3", dt.datetime(2026, 1, 3)), ("a", 7, "a4", dt.datetime(2026, 1, 4))],
]
EXPECTED = [
    ("a", "a4", dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 4)),
    ("b", "b1", dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1)),
    ("c", "c1", dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 2)),
]


def state_rows(df):
    return sorted(map(tuple, df.select("url", "title", "first_seen", "last_seen").collect()))


def test_stream_equals_batch(spark, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    write_batches(spark, source, PARTS)
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    upsert.start_upserts(stream, ["url"], ["n"], F.col("at"), log, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(log).select("batch_id").distinct().count() > 1
    assert state_rows(upsert.current_state(spark, log, ["url"], ["n"])) == EXPECTED
    # nothing new: the state stays
    stream = spark.readStream.schema(schema).parquet(source)
    upsert.start_upserts(stream, ["url"], ["n"], F.col("at"), log, str(tmp_path / "cp")).awaitTermination()
    assert state_rows(upsert.current_state(spark, log, ["url"], ["n"])) == EXPECTED
    # compaction keeps the state, and reading then leaves the batches of the base alone
    last = spark.read.parquet(log).agg({"batch_id": "max"}).first()[0]
    assert upsert.compact(spark, log, ["url"], ["n"]) == last - 1
    state = upsert.current_state(spark, log, ["url"], ["n"])
    assert state_rows(state) == EXPECTED
    read = {r[0] for r in upsert._stored(spark, log)[0].select(F.input_file_name()).collect()}
    assert {f.split("batch_id=")[1].split("/")[0] for f in read if "batch_id=" in f} == {str(last)}
    assert any(".bases/" in f for f in read)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "(batch_id#" in plan and f"> {last - 1})" in plan.split("PartitionFilters", 2)[-1]
    # nothing to add: no new base; a later batch is folded into the next one
    assert upsert.compact(spark, log, ["url"], ["n"]) == last - 1
    late = spark.createDataFrame([("a", "a9", 9, dt.datetime(2026, 2, 1))], "url string, title string, n int, at timestamp")
    upsert.upsert_batch(["url"], ["n"], F.col("at"), log)(late.select(*schema.names), last + 1)
    after = [("a", "a9", dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)), *EXPECTED[1:]]
    assert state_rows(upsert.current_state(spark, log, ["url"], ["n"])) == after
    assert upsert.compact(spark, log, ["url"], ["n"]) == last
    assert state_rows(upsert.current_state(spark, log, ["url"], ["n"])) == after


def test_stream_of_landed_days(spark, tmp_path):
    root, log = str(tmp_path / "raw"), str(tmp_path / "log")
    schema = spark.createDataFrame([], "url string, title string, extracted_at string").schema
    for day, title in ((1, "old"), (2, "new")):
        run = spark.createDataFrame([("a", title, f"2026-01-0{day} 10:00:00")], schema)
        writers.land(run, root, "jooble", dt.date(2026, 1, day))
    stream = readers.stream_landed(spark, root, "jooble", schema)
    upsert.start_upserts(stream, ["url"], ["extracted_at"], F.to_timestamp("extracted_at"), log,
                         str(tmp_path / "cp")).awaitTermination()
    assert state_rows(upsert.current_state(spark, log, ["url"], ["extracted_at"])) == [
        ("a", "new", dt.datetime(2026, 1, 1, 10), dt.datetime(2026, 1, 2, 10))]


def test_replayed_batch_counts_once(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.createDataFrame(PARTS[1], "url string, n long, title string, at timestamp")
    write = upsert.upsert_batch(["url"], ["n"], F.col("at"), log)
    write(rows, 0)
    write(rows, 0)
    assert spark.read.parquet(log).count() == 2


def test_stream_of_links(spark, tmp_path):
    source = str(tmp_path / "in")
    write_batches(spark, source, PARTS)
    known = spark.createDataFrame([("b",)], "url string")
    schema = spark.read.parquet(source).schema
    for name, within in (("exact", None), ("bounded", ("at", "10 days"))):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = (links.unseen_stream(stream, known, within=within).writeStream.format("parquet")
                 .option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"cp-{name}"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        assert sorted(r["url"] for r in spark.read.parquet(str(tmp_path / name)).collect()) == ["a", "c"]

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postloom.operators import dedup, merge, reports, seen


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [1, 8])
@pytest.mark.parametrize("descending", [False, True])
def test_keep_first_ignores_partitions_and_input_order(spark, partitions, descending):
    data = [(i, None if i % 3 == 0 else f"c{i % 3}", "t") for i in range(50)]
    df = spark.createDataFrame(sorted(data, reverse=descending), "n long, company string, title string")
    kept = dedup.keep_first(df.repartition(partitions), ["company", "title"], ["n"])
    assert rows(kept, "n", "company") == [(0, None), (1, "c1"), (2, "c2")]


def test_keep_first_combines_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 2)
    text = plan(dedup.keep_first(df, ["k"], ["id"]))
    above, below = text.split("Exchange", 1)
    assert "Final" in above and "row_number(), 1, Partial" in below


def test_keep_last(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "n long, k string")
    assert rows(dedup.keep_last(df, ["k"], ["n"]), "n", "k") == [(2, "a"), (3, "b")]


def test_content_dedup_null_date_wins(spark):
    df = spark.createDataFrame(
        [(1, "a", "2026-01-01"), (2, "a", None), (3, "a", "2026-02-01"), (4, None, "2026-01-01"),
         (5, None, "2026-01-02")], "n long, k string, d string")
    assert rows(dedup.deduplicate_by_content(df, ["k"], "d", ["n"]), "n", "k", "repost_count") == [
        (2, "a", 3), (5, None, None)]
    assert rows(dedup.deduplicate_by_content(df, ["k"], "d", ["n"], nulls="lose"), "n") == [
        (3,), (5,)]


def test_repost_count_on_every_row(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, None, "x")],
                               "n long, k string, j string")
    assert rows(dedup.with_repost_count(df, ["k", "j"]), "n", "repost_count") == [
        (1, 2), (2, 2), (3, None)]


T0, T1, T2 = (dt.datetime(2026, 1, d) for d in (1, 2, 3))
STATE = "url string, title string, first_seen timestamp, last_seen timestamp"


def test_merge_by_url(spark):
    state = spark.createDataFrame([("a", "old", T0, T0), ("b", "b", T0, T0)], STATE)
    batch = spark.createDataFrame(
        [(1, "a", "new"), (2, "c", "first"), (3, "c", "last"), (4, None, "x"), (5, "", "y")],
        "n long, url string, title string")
    merged = merge.merge_seen(state, batch, ["url"], F.lit(T1), ["n"], drop_empty_keys=True)
    assert rows(merged, "url", "title", "first_seen", "last_seen", "change") == [
        ("a", "new", T0, T1, "updated"), ("b", "b", T0, T0, "kept"), ("c", "last", T1, T1, "added")]
    assert merge.merge_counts(merged).collect() == [(1, 1)]
    assert rows(merge.processed(merged), "url") == [("a",), ("c",)]
    # the same batch again changes only the time last seen
    again = merge.merge_seen(merged.drop("change"), batch, ["url"], F.lit(T2), ["n"],
                             drop_empty_keys=True)
    assert rows(again, "url", "title", "first_seen", "last_seen") == [
        ("a", "new", T0, T2), ("b", "b", T0, T0), ("c", "last", T1, T2)]


def test_merge_with_null_keys(spark):
    state = spark.createDataFrame([("c", None, "old", T0, T0)],
                                  "company string, city string, title string, "
                                  "first_seen timestamp, last_seen timestamp")
    batch = spark.createDataFrame([(1, "c", None, "new"), (2, "c", "r", "x")],
                                  "n long, company string, city string, title string")
    merged = merge.merge_seen(state, batch, ["company", "city"], F.lit(T1), ["n"])
    assert rows(merged, "city", "title", "first_seen", "change") == [
        ("r", "x", T1, "added"), (None, "new", T0, "updated")]
    assert "CartesianProduct" not in plan(merged) and "NestedLoop" not in plan(merged)
    # each side is shuffled once: the join takes over what keep_last left
    assert plan(merged).count("Exchange hashpartitioning(") == 2
    fresh = merge.fresh_seen(batch, ["company", "city"], F.lit(T2), ["n"])
    assert rows(fresh, "city", "first_seen", "last_seen") == [("r", T2, T2), (None, T2, T2)]


def test_record_key(spark):
    df = spark.createDataFrame([("c", None, 1)], "a string, b string, n int")
    assert df.select(merge.record_key("a", "b", "n")).collect() == [("c||None||1",)]


def test_unseen_links(spark):
    known = spark.createDataFrame([("a",)], "url string")
    raw = spark.createDataFrame([("b", "x"), (None, "c"), ("", None)],
                                "job_url string, source_url string")
    seen_links = seen.seen_urls(known, raw, ["job_url", "source_url"])
    assert rows(seen_links, "url") == [("a",), ("b",), ("c",)]
    run = spark.createDataFrame([(1, "a"), (2, "d"), (3, "d"), (4, None), (5, "")],
                                "n long, url string")
    assert rows(seen.unseen(run, seen_links, "url", ["n"]), "n", "url") == [(2, "d")]
    assert seen.sample_links(run.where("url is not null"), 2, "s").count() == 2


def test_link_report_and_running_total(spark):
    links = spark.createDataFrame(
        [(p, f"u{(p * 7 + i) % 40}") for p in range(30) for i in range(3)], "page_no long, url string")
    known = spark.createDataFrame([("u0",), ("u5",)], "url string")
    seen_now, expected, total = {"u0", "u5"}, [], 0
    for page in range(30):
        found = {f"u{(page * 7 + i) % 40}" for i in range(3)}
        fresh = found - seen_now
        seen_now |= found
        total += len(fresh)
        expected.append((page, len(found), len(fresh), total))
    totals = reports.running_total(
        spark.createDataFrame([(i, 1) for i in range(50)], "n long, v long"), "n", "v", "t", width=7)
    assert sorted(map(tuple, totals.select("n", "t").collect())) == [(i, i + 1) for i in range(50)]
    report = reports.link_report(links, known)
    assert sorted(map(tuple, report.select(
        "page_no", "links", "new_links", "total_new").collect())) == expected


def test_hot_key_is_counted_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 2)
    text = plan(dedup.repost_counts(df, ["k"]))
    assert text.count("HashAggregate") == 2
    assert "partial_count" in text

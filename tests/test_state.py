"""Bucketed state, the bitmap of seen links and the table of seen links."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postloom.operators import bitmap_filter, merge, seen
from postloom.sources.bucketed import BucketedState
from postloom.streaming import seen_table

SCHEMA = "k string, n long, text string, first_seen timestamp, last_seen timestamp"


def day(n):
    return dt.datetime(2026, 1, n)


def rows_of(df):
    return sorted((r.k or "", r.n, r.text, r.first_seen, r.last_seen) for r in df.collect())


def files(root):
    return {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_bucketed_merges_equal_merges_of_the_whole_state(spark, tmp_path):
    rng = random.Random(1)
    schema = spark.createDataFrame([], SCHEMA).schema
    state = BucketedState(spark, str(tmp_path / "state"), schema, ("k",), 8)
    whole = spark.createDataFrame([], SCHEMA)
    assert state.read().count() == 0 and state.version() == -1
    for n in range(1, 6):
        keys = [rng.choice([None, *"abcdefghijklmnop"]) for _ in range(rng.randint(1, 9))]
        batch = spark.createDataFrame(
            [(k, n * 100 + i, f"text {n} {i}") for i, k in enumerate(keys)], "k string, n long, text string")
        before = state.version()
        state.merge(batch, F.lit(day(n)), ["n"])
        whole = spark.createDataFrame(merge.merge_seen(
            whole, batch, ["k"], F.lit(day(n)), ["n"]).drop("change").collect(), SCHEMA)
        assert rows_of(state.read()) == rows_of(whole)
        assert state.version() == before + 1
    assert rows_of(state.read(version=0)) != rows_of(whole)
    assert state.merge(batch.limit(0), F.lit(day(9)), ["n"]) == state.version()


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    state = BucketedState(spark, str(tmp_path / "state"), schema, ("k",), 16)
    first = spark.createDataFrame([(f"key {i}", i, "t") for i in range(200)], "k string, n long, text string")
    state.merge(first, F.lit(day(1)), ["n"])
    old, listed = files(tmp_path), state.manifest()
    batch = spark.createDataFrame([("key 7", 500, "new"), ("key 8", 501, "new")], "k string, n long, text string")
    touched = {r.b for r in batch.select(state.bucket_of().alias("b")).collect()}
    state.merge(batch, F.lit(day(2)), ["n"])
    now = state.manifest()
    assert {b for b in now if now[b] != listed.get(b)} == touched and len(listed) == 16
    assert all(files(tmp_path)[p] == t for p, t in old.items())  # nothing is rewritten in place
    assert state.read().count() == 200 and state.read().where("text = 'new'").count() == 2
    assert state.read(version=0).where("text = 'new'").count() == 0


def test_a_run_that_dies_before_its_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], SCHEMA).schema
    state = BucketedState(spark, str(tmp_path / "state"), schema, ("k",), 4)
    batch = spark.createDataFrame([("a", 1, "t")], "k string, n long, text string")
    state.merge(batch, F.lit(day(1)), ["n"])
    wanted = rows_of(state.read())
    monkeypatch.setattr(BucketedState, "manifest", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        state.replace(spark.createDataFrame([("b", 2, "x", day(2), day(2))], SCHEMA), [0, 1, 2, 3])
    monkeypatch.undo()
    assert rows_of(state.read()) == wanted


@pytest.mark.parametrize("limit", [64 << 20, -1])
@pytest.mark.parametrize("bits", [1 << 31, 64])
def test_the_bitmap_leaves_what_the_anti_join_leaves(spark, monkeypatch, bits, limit):
    monkeypatch.setattr(bitmap_filter, "BITS", bits)
    monkeypatch.setattr(bitmap_filter, "BROADCAST_BYTES", limit)
    rng = random.Random(bits)
    links = [(i, rng.choice([None, "", *[f"https://x/{n}" for n in range(300)]])) for i in range(500)]
    known = [(f"https://x/{n}",) for n in range(0, 300, 3)] + [(None,), ("",), ("https://x/0",)]
    df = spark.createDataFrame(links, "n int, url string")
    table = spark.createDataFrame(known, "url string")
    got = bitmap_filter.unseen_by_bitmap(df, table, "url", ["n"])
    assert sorted(got.collect()) == sorted(seen.unseen(df, table, "url", ["n"]).collect())
    assert bitmap_filter.unseen_by_bitmap(df, table.limit(0), "url", ["n"]).count() == len(
        {u for _, u in links if u})


def test_only_possible_hits_reach_the_anti_join(spark):
    df = spark.range(2000).select(F.concat(F.lit("u"), "id").alias("url"))
    table = spark.range(1990, 2100).select(F.concat(F.lit("u"), "id").alias("url"))
    bitmap = bitmap_filter.seen_bitmap(table)
    flagged = bitmap_filter.possible_hits(df, bitmap, "url", bitmap.count())
    assert flagged.where("__possible").count() == 10
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_links_are_given_out_once_over_restarts_and_queries(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "seen")
    start = spark.createDataFrame([("a",), (None,)], "url string")

    def land(*urls):
        spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1).write.mode(
            "append").json(str(source))

    def run(query):
        stream = spark.readStream.schema("url string").option("maxFilesPerTrigger", 1).json(str(source))
        seen_table.start_unseen(stream, root, query, str(tmp_path / query), start).awaitTermination()
        return sorted((r.url, r.query) for r in seen_table.seen_links(spark, root).collect())

    assert seen_table.seen_links(spark, root).count() == 0
    land("a", "b", "b", None, "")
    assert run("one") == [("b", "one")]
    land("b", "c")
    land("c", "d", "a")
    assert run("one") == [("b", "one"), ("c", "one"), ("d", "one")]
    land("e")
    assert run("two") == [("b", "one"), ("c", "one"), ("d", "one"), ("e", "two")]
    # a batch that is replayed after its rows were written gives the same rows
    last = seen_table.seen_links(spark, root).where("query = 'one'").agg(F.max("batch_id")).first()[0]
    wanted = seen_table.seen_links(spark, root).where(F.col("batch_id") == last).where("query = 'one'").collect()
    again = spark.createDataFrame([(r.url,) for r in wanted] + [("a",), ("b",)], "url string")
    seen_table.add_unseen(root, "one", start)(again, last)
    assert sorted((r.url, r.query) for r in seen_table.seen_links(spark, root).collect()) == [
        ("b", "one"), ("c", "one"), ("d", "one"), ("e", "two")]

"""Registered queries against SQL on the smallest given tables, and their plans."""

import pytest
from conftest import tables

import __spark_entry__ as entry
from checks.compare import connect, rows_of
from checks.registry import ORACLES, QUERIES
from postloom.operators.compute_once import compute_once
from postloom.operators.spread import spread

# the library's own; what else is registered is tested beside its operators
assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.fixture(scope="module")
def duck():
    return connect(tables())


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, tables())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_entry(spark):
    tables()
    assert entry.entry(spark).columns == ["skill", "postings", "share", "demand_rank"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    text = plan(QUERIES["dedup_keep_last"](spark, tables()))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_texts_are_cleaned_once(spark):
    """The description rule occurs once in the plan although it is filtered on."""
    text = plan(QUERIES["standardize_jooble"](spark, tables()))
    assert text.count("view email address on") == 1
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_compute_once_keeps_the_filter_above(spark):
    from pyspark.sql import functions as F

    df = compute_once(spark.range(3).selectExpr("id", "concat('ab', id % 1) AS t"), t=F.regexp_replace("t", "a", "x"))
    kept = df.where(F.length("t") > 1).where(F.col("t") != "y")
    assert plan(kept).count("regexp_replace") == 1
    assert [r["t"] for r in kept.collect()] == ["xb0"] * 3


def test_spread_leaves_many_partitions_alone(spark):
    df = spark.read.parquet(f"{tables()}/documents.parquet")
    assert "Exchange" in plan(spread(df, "doc_id"))
    many = df.repartition(64)
    assert spread(many, "doc_id") is many

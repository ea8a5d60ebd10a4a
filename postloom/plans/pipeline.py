"""Run a source, or all of them, from raw records to the staging layer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions.skills import STARTER, SkillTable, SkillVocabulary
from postloom.operators.merge import fresh_seen, merge_seen
from postloom.operators.reports import skip_report, source_counts
from postloom.plans.specs import MERGE_KEYS, SOURCES, SourceSpec
from postloom.plans.standardize import classify, finish, prepare
from postloom.session import cut_lineage
from postloom.sources.readers import load_raw, read_state
from postloom.sources.schemas import RAW_SCHEMAS, STAGING_SEEN
from postloom.sources.writers import write_staging_csv, write_staging_json, write_staging_table


@dataclass(frozen=True)
class RunResult:
    postings: DataFrame
    merged: DataFrame
    skipped: DataFrame


def stage_source(
    raw: DataFrame, spec: SourceSpec, now: dt.datetime, as_of: dt.date,
    previous: DataFrame | None = None, vocabulary: SkillVocabulary | SkillTable = STARTER,
    strict_dates: bool = False, cities: DataFrame | None = None,
) -> RunResult:
    """Standardised postings, their merge with earlier ones, and the skip report.

    Texts are cleaned once: the classified rows are checkpointed and both the
    report and the rest of the plan start from there.  Without ``previous`` the
    merged state starts fresh.
    """
    classified = cut_lineage(classify(prepare(raw, spec, vocabulary, cities), spec))
    postings = cut_lineage(
        finish(
            classified, spec, as_of, vocabulary, strict_dates, keep_order=True, cities=cities))
    order, instant = list(spec.order), F.lit(now)
    if previous is None:
        merged = fresh_seen(postings.drop("source"), MERGE_KEYS, instant, order).drop(*order)
    else:
        merged = merge_seen(previous, postings.drop("source"), MERGE_KEYS, instant, order)
    return RunResult(postings.drop(*order), merged, skip_report(classified))


def version_path(out: str, spec: SourceSpec, now: dt.datetime) -> str:
    """Folder of the merged state written at ``now``; versions are never overwritten
    while they are read, and a lost run leaves the one before intact."""
    return f"{out}/json/{spec.name}/version={now:%Y%m%dT%H%M%S}"


def run_source(
    spark: SparkSession, spec: SourceSpec, out: str, now: dt.datetime, as_of: dt.date,
    raw: DataFrame | None = None, previous_path: str | None = None,
    vocabulary: SkillVocabulary | SkillTable = STARTER, table: bool = True,
    cities: DataFrame | None = None,
) -> RunResult:
    """Read, stage and write one source: merged JSON, CSV and the staging table."""
    if raw is None:
        raw = load_raw(spark, spec.raw_table, RAW_SCHEMAS[spec.name])
    previous = read_state(spark, previous_path, STAGING_SEEN) if previous_path else None
    result = stage_source(raw, spec, now, as_of, previous, vocabulary, cities=cities)
    write_staging_json(result.merged.drop("change"), version_path(out, spec, now))
    write_staging_csv(result.postings, f"{out}/csv/{spec.name}")
    if table:
        write_staging_table(result.postings, spec.staging_table)
    return result


def union_sources(postings: Mapping[str, DataFrame]) -> DataFrame:
    """Postings of all sources side by side, with their source."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), postings.values())


def run_all(
    spark: SparkSession, out: str, now: dt.datetime, as_of: dt.date,
    vocabulary: SkillVocabulary | SkillTable = STARTER, table: bool = True,
    specs: Mapping[str, SourceSpec] = SOURCES, raw: Mapping[str, DataFrame] | None = None,
    cities: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All sources; returns postings, rows per source and skipped rows per reason."""
    raw = raw or {}
    results = {
        name: run_source(
            spark, spec, out, now, as_of, raw=raw.get(name), vocabulary=vocabulary, table=table,
            cities=cities)
        for name, spec in specs.items()
    }
    postings = union_sources({n: r.postings for n, r in results.items()})
    skipped = reduce(DataFrame.unionByName, [r.skipped for r in results.values()])
    return postings, source_counts(postings), skipped

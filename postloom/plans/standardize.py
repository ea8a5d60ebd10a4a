"""Raw records of one source -> postings in the common schema.

Stages, in the order that does the least work:

1. ``prepare``  - clean the texts the drop rules and keys need, each once; where no report of
   the reasons is asked for, rows that a rule on short fields drops are not cleaned;
2. ``classify`` - name the first drop rule that applies (``skip_reason``);
3. keep the first posting per key (one shuffle, combined before it);
4. ``enrich``   - date, city, employment type, education, skills of the rows left.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import predicates as P
from postloom.functions import wordlists as W
from postloom.functions.dates import format_date, relative_date
from postloom.functions.enrich import education, employment_type
from postloom.functions.nulls import field, null_words_to_null, normalize_nulls
from postloom.functions.places import clean_bulleted_city, clean_city, unbulleted, with_city
from postloom.functions.skills import (
    STARTER, SkillTable, SkillVocabulary, extract_skills, union_skills, with_skills,
)
from postloom.functions.text import (
    clean_company_name, clean_description, clean_title, html_to_text, keep_title_characters,
    title_from_description,
)
from postloom.operators.compute_once import compute_once
from postloom.operators.dedup import keep_first
from postloom.plans.specs import STAGING_COLUMNS, SourceSpec
from postloom.session import stored

RAW = "__raw_description"

# drop rule -> (reason reported, test)
DROP_RULES: dict[str, tuple[str, Callable[[SourceSpec], Column]]] = {
    "foreign": ("foreign", lambda s: P.is_foreign_posting(F.col(RAW), F.col("__place"))),
    "short_description": ("short_description", lambda s: P.is_short(F.col("job_description"))),
    "bad_url": ("bad_url", lambda s: P.is_bad_url(F.col("job_url"))),
    "non_tech": (
        "non_tech",
        lambda s: ~P.is_valid_posting(F.col("job_title"), F.col("job_description"))),
    "forbidden_title": ("non_tech", lambda s: P.has_forbidden_title(F.col("job_title"))),
    "unresolved_title": (
        "unresolved_title", lambda s: F.col("job_title") == W.DEFAULT_TITLE),
    "excluded_posting": ("excluded_posting", lambda s: _is_excluded(s)),
    "not_tech_posting": (
        "non_tech",
        lambda s: ~P.is_tech_posting(
            F.col("job_title"), F.col("job_description"), F.col("__skills"))),
}

# what these rules tell before the description is cleaned: the same test, or its part on the title
EARLY_RULES: dict[str, Callable[[SourceSpec], Column]] = {
    **{rule: DROP_RULES[rule][1] for rule in (
        "foreign", "bad_url", "forbidden_title", "unresolved_title", "excluded_posting")},
    "non_tech": lambda s: ~P.is_valid_title(F.col("job_title")),
}


def _not_dropped(rules: list[Column]) -> Column:
    """No test holds; as in ``classify``, a test that is NULL drops nothing."""
    return reduce(and_, [~F.coalesce(r, F.lit(False)) for r in rules], F.lit(True))


def _is_excluded(spec: SourceSpec) -> Column:
    test = F.lit(False)
    for title, company in spec.excluded:
        test |= (F.col("job_title") == title) & (F.col("company_name") == company)
    return F.coalesce(test, F.lit(False))


def _title(df: DataFrame, spec: SourceSpec, description: Column) -> Column:
    if spec.title_rule == "description":
        return title_from_description(description)
    title = field(df, spec.title)
    return keep_title_characters(title) if spec.title_rule == "characters" else clean_title(title)


def _city(spec: SourceSpec) -> Column:
    place = F.col("__city_text")
    if spec.city_rule == "bulleted":
        # the result is looked up again: a city only known by its Arabic name drops out
        return clean_city(clean_bulleted_city(place))
    if spec.city_rule == "list_then_description":
        return F.coalesce(clean_city(place), clean_city(F.col("job_description")))
    return clean_city(place)


def _with_city(df: DataFrame, spec: SourceSpec, cities: DataFrame) -> DataFrame:
    """:func:`_city` with a dictionary that is a table."""
    place = F.col("__city_text")
    if spec.city_rule == "bulleted":
        found = with_city(df, "city", cities, unbulleted(place))
        return with_city(found, "city", cities, F.col("city"))
    if spec.city_rule == "list_then_description":
        return with_city(df, "city", cities, place, F.col("job_description"))
    return with_city(df, "city", cities, place)


def _city_text(df: DataFrame, spec: SourceSpec) -> Column:
    place = field(df, spec.city)
    if spec.city_rule == "list_then_description" and "cities" in df.columns:
        return F.when(F.size("cities") > 0, F.get("cities", F.lit(0))).otherwise(place)
    return place


def _ordered(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Records without an order of their own (lines, CSV, landed days) are ordered by a hash
    of their content: the same on every run and cluster."""
    if "record_no" not in spec.order or "record_no" in raw.columns:
        return raw
    return raw.withColumn("record_no", F.xxhash64(*raw.columns))


def prepare(
    raw: DataFrame, spec: SourceSpec, vocabulary: SkillVocabulary | SkillTable = STARTER,
    cities: DataFrame | None = None, drop_early: bool = False,
) -> DataFrame:
    """Cleaned texts and the raw fields later stages need.

    With ``drop_early``, rows that ``classify`` would drop leave before their description is
    cleaned, or before skills are looked for, if the fields at hand decide it. The rows that
    stay are the same; reasons of the others are not told.
    """
    raw = _ordered(normalize_nulls(raw), spec)
    description = field(raw, spec.description)
    text = html_to_text(description) if spec.html else description
    given = F.col(spec.given_skills) if spec.given_skills in raw.columns else F.lit(None)
    columns = {
        "company_name": clean_company_name(field(raw, spec.company)),
        "job_title": _title(raw, spec, description),
        "job_description": clean_description(text),
        "job_url": field(raw, spec.url),
        "__city_text": _city_text(raw, spec),
        "__place": field(raw, spec.location_fields),
        "__date": field(raw, spec.date),
        "__employment": field(raw, spec.employment),
        "__given": given.cast("array<string>"),
        RAW: description,
    }
    order = {c: F.col(c) for c in spec.order}
    early = [EARLY_RULES[r](spec) for r in spec.drops if r in EARLY_RULES] if drop_early else []
    if early:
        short = {n: v for n, v in columns.items() if n != "job_description"}
        raw = compute_once(raw, **short).select(*order, *short).where(_not_dropped(early))
        text = html_to_text(F.col(RAW)) if spec.html else F.col(RAW)
        ready = compute_once(raw, job_description=clean_description(text)).select(*order, *columns)
    else:
        ready = compute_once(raw, **columns).select(*order, *columns)
    tech = "not_tech_posting" in spec.drops
    if tech and drop_early:
        by_words = P.is_tech_by_words(F.col("job_title"), F.col("job_description"))
        ready = ready.where(_not_dropped([~by_words]))
    extra = {}
    if "city" in spec.dedup_keys and cities is None:
        extra["city"] = _city(spec)
    if tech and isinstance(vocabulary, SkillVocabulary):
        extra["__skills"] = extract_skills(F.col("job_description"), vocabulary)
    ready = compute_once(ready, **extra) if extra else ready
    if "city" in spec.dedup_keys and cities is not None:
        ready = _with_city(ready, spec, cities)
    if tech and isinstance(vocabulary, SkillTable):
        ready = with_skills(ready, F.col("job_description"), vocabulary, "__skills")
    return ready


def classify(prepared: DataFrame, spec: SourceSpec) -> DataFrame:
    """Adds ``source`` and ``skip_reason`` (NULL for postings that stay)."""
    reason = F.lit(None).cast("string")
    for rule in reversed(spec.drops):
        name, test = DROP_RULES[rule]
        reason = F.when(test(spec), F.lit(name)).otherwise(reason)
    return prepared.select("*", F.lit(spec.name).alias("source"), reason.alias("skip_reason"))


def enrich(
    kept: DataFrame, spec: SourceSpec, as_of: dt.date,
    vocabulary: SkillVocabulary | SkillTable = STARTER, strict_dates: bool = False,
    cities: DataFrame | None = None,
) -> DataFrame:
    """Common schema for the postings that stay."""
    description = F.col("job_description")
    if "city" not in kept.columns and cities is not None:
        kept = _with_city(kept, spec, cities)
    if "__skills" not in kept.columns and isinstance(vocabulary, SkillTable):
        # read twice, by the texts that meet the terms and by the rows that they are joined back to
        kept = stored(kept if spec.detail_text == "raw" else kept.drop(RAW))
        kept = with_skills(kept, description, vocabulary, "__skills")
    detail = F.col(RAW) if spec.detail_text == "raw" else description
    date = (
        relative_date(F.col("__date"), as_of, absolute_first=not strict_dates)
        if spec.date_rule == "relative" else format_date(F.col("__date")))
    skills = (
        F.col("__skills") if "__skills" in kept.columns
        else extract_skills(description, vocabulary))
    if spec.given_skills:
        skills = union_skills(F.col("__given"), skills)
    city = F.col("city") if "city" in kept.columns else _city(spec)
    values = {
        "job_title": null_words_to_null(F.col("job_title")),
        "company_name": F.col("company_name"),
        "city": city,
        "country": F.lit(W.COUNTRY),
        "posted_date": date,
        "employment_type": employment_type(F.col("__employment"), detail),
        "education": education(detail),
        "job_description": null_words_to_null(description),
        "skills": skills,
        "job_url": F.col("job_url"),
    }
    return kept.select(
        *[values[c].alias(c) for c in STAGING_COLUMNS], *spec.order, "source")


def standardize(
    raw: DataFrame, spec: SourceSpec, as_of: dt.date,
    vocabulary: SkillVocabulary | SkillTable = STARTER, strict_dates: bool = False,
    keep_order: bool = False, cities: DataFrame | None = None,
) -> DataFrame:
    """All stages; returns the common columns (and the order columns if asked).

    ``vocabulary`` may be a table of any size, and so may ``cities`` (see places.with_city);
    without it the built-in city spellings count.
    """
    classified = classify(prepare(raw, spec, vocabulary, cities, drop_early=True), spec)
    return finish(classified, spec, as_of, vocabulary, strict_dates, keep_order, cities)


def finish(
    classified: DataFrame, spec: SourceSpec, as_of: dt.date,
    vocabulary: SkillVocabulary | SkillTable = STARTER, strict_dates: bool = False,
    keep_order: bool = False, cities: DataFrame | None = None,
) -> DataFrame:
    """Stages after ``classify``."""
    kept = classified.where("skip_reason is null").drop("skip_reason", "source")
    first = keep_first(kept, list(spec.dedup_keys), list(spec.order))
    first = first.withColumn("source", F.lit(spec.name))
    done = enrich(first, spec, as_of, vocabulary, strict_dates, cities)
    return done if keep_order else done.drop(*spec.order)

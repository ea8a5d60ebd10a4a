"""Source specifications: one declarative entry per source.

A new source is a new :class:`SourceSpec`; no code changes.  Field lists name the
accepted columns in order of preference; a column a source does not have is
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

STAGING_COLUMNS = [
    "job_title", "company_name", "city", "country", "posted_date", "employment_type",
    "education", "job_description", "skills", "job_url",
]
MERGE_KEYS = ["company_name", "city", "job_description"]


@dataclass(frozen=True)
class SourceSpec:
    name: str
    raw_table: str
    staging_table: str
    company: tuple[str, ...]
    description: tuple[str, ...]
    url: tuple[str, ...]
    date: tuple[str, ...]
    employment: tuple[str, ...]
    city: tuple[str, ...] = ()
    title: tuple[str, ...] = ()
    # how the title is made: "location", "description" or "characters"
    title_rule: str = "location"
    # whether the description is HTML (text nodes) before it is cleaned
    html: bool = True
    # which text employment type and education are read from: "clean" or "raw"
    detail_text: str = "clean"
    # how the city is made: "plain", "bulleted" or "list_then_description"
    city_rule: str = "plain"
    # how the date is read: "absolute" or "relative"
    date_rule: str = "absolute"
    # names of the drop rules, in order (see standardize.DROP_RULES)
    drops: tuple[str, ...] = ()
    dedup_keys: tuple[str, ...] = ("company_name", "job_title", "job_description")
    given_skills: str | None = None
    location_fields: tuple[str, ...] = ()
    excluded: tuple[tuple[str, str], ...] = ()
    order: tuple[str, ...] = field(default=("record_no",))


_QUALITY = ("short_description", "bad_url", "non_tech")

TAPNEO = SourceSpec(
    name="tapneo", raw_table="RAW_TEPNEO_JOBS", staging_table="STG_TEPNEO_JOBS",
    company=("CompanyName", "company_name"),
    description=("JobDescription", "job_description"), html=False,
    title_rule="description", detail_text="raw",
    city=("job_location", "job_city"), city_rule="bulleted",
    date=("PostedAt", "posted_date"), employment=("EmploymentType", "employment_type"),
    url=("source_url", "job_url"),
    drops=("unresolved_title", "excluded_posting"),
    excluded=(("Project Manager", "AtkinsR"),),
)
JSEARCH = SourceSpec(
    name="jsearch", raw_table="RAW_JSEARCH_JOBS", staging_table="STG_JSEARCH_JOBS",
    company=("employer_name", "company"), description=("job_description", "snippet"),
    title=("job_title", "title"),
    city=("job_city", "city", "job_location", "location"),
    location_fields=("job_location", "location"),
    date=("job_posted_at", "date"), date_rule="relative",
    employment=("job_employment_type", "employment_type"), url=("job_apply_link", "url"),
    drops=("foreign", *_QUALITY),
)
JOOBLE = SourceSpec(
    name="jooble", raw_table="RAW_JOOBLE_JOBS", staging_table="STG_JOOBLE_JOBS",
    company=("company",), description=("snippet",), title=("title",),
    city=("location", "search_location"), date=("date",), employment=("employment_type",),
    url=("url",), drops=_QUALITY, dedup_keys=("company_name", "job_title"),
)
FREEHIRE = SourceSpec(
    name="freehire", raw_table="RAW_FREEHIRE_JOBS", staging_table="STG_FREEHIRE_JOBS",
    company=("company_name",), description=("job_description",), title=("job_title",),
    city=("location",), city_rule="list_then_description", date=("posted_date",),
    employment=("category",), url=("source_url",), given_skills="skills",
    drops=("forbidden_title", *_QUALITY),
    dedup_keys=("company_name", "city", "job_description"),
)
TANQEEB = SourceSpec(
    name="tanqeeb", raw_table="RAW_TANQEEB_JOBS", staging_table="STG_TANQEEB_JOBS",
    company=("company_name",), description=("job_description",), html=False,
    title=("job_title",), title_rule="characters", city=("location",),
    date=("posted_date",), employment=("employment_type",), url=("job_url", "url"),
    drops=("not_tech_posting",),
)

SOURCES = {s.name: s for s in (TAPNEO, JSEARCH, JOOBLE, FREEHIRE, TANQEEB)}

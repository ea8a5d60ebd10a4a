"""The same results in DuckDB SQL.

Word lists are shared with the library, because they are fixed values; every rule
is written again here, in the dialect of another engine and regex library.
"""

from __future__ import annotations

from checks import inputs
from checks.queries import AS_OF, LINK_RULES, NOW, SPLIT, VOCABULARY
from postloom.functions import wordlists as W
from postloom.plans.specs import SOURCES, STAGING_COLUMNS

WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"
NAMES = {n: n for n in ("documents", "customer", "orders", "pages", "nation", "part")}
POSTINGS = inputs.POSTINGS.format(**NAMES)
DATE_TEXTS = inputs.DATE_TEXTS.format(**NAMES)
POSTING_PAGES = inputs.POSTING_PAGES.format(**NAMES)
DICTIONARY = inputs.DICTIONARY.format(**NAMES)
TERMS = inputs.TERMS.format(**NAMES)


# ------------------------------------------------------------------- fragments
def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def rx(words) -> str:
    return "|".join("".join("\\" + c if c in r"\.+*?()[]{}|^$-" else c for c in w) for w in words)


def sub(x: str, pattern: str, by: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, '{flags}')"


def strip(x: str) -> str:
    return sub(x, f"^[{SPACE}]+|[{SPACE}]+$")


def collapse(x: str) -> str:
    return f"trim({sub(x, f'[{SPACE}]+', ' ')})"


def has(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def filled(*values: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({v}, '')" for v in values) + ")"


# ----------------------------------------------------------------- text rules
ENTITIES = [("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'),
            ("&amp;", "\x02"), ("&amp", "\x02"), ("\x02", "&")]


def decode(x: str) -> str:
    for name, char in ENTITIES:
        x = f"replace({x}, {q(name)}, {q(char)})"
    return x


def html_text(x: str, separator: str = " ") -> str:
    x = sub(x, r"<!--.*?-->", "\x01", "gs")
    for block in ("script", "style", "template"):
        x = sub(x, rf"<{block}\b[^>]*>.*?</{block}\s*>", "\x01", "gsi")
    x = sub(x, r"<[!?][^>]*>", "\x01")
    x = sub(x, r"</?[a-zA-Z][^>]*>", "\x01")
    nodes = f"list_transform(string_split({x}, chr(1)), lambda n: {strip(decode('n'))})"
    return (f"coalesce(array_to_string(list_filter({nodes}, lambda n: n <> ''), "
            f"{q(separator)}), '')")


MARKS = f"[{SPACE}\\-:•📍|]*"


def clean_description(x: str) -> str:
    t = sub(x, "<[^<]+?>")
    for name, char in W.DESCRIPTION_ENTITIES:
        t = f"replace({t}, {q(name)}, {q(char)})"
    for phrase in W.INTRO_PHRASES:
        t = sub(t, f"(?i)^{MARKS}{phrase}{MARKS}", flags="")
    t = sub(t, "[*•❖✔#—–]", " ")
    t = sub(t, rf"(?i)view email address on [^{SPACE}]+")
    return f"coalesce({collapse(t)}, '')"


def clean_company(x: str) -> str:
    stripped = strip(sub(strip(x), rf"(?i)^client of[{SPACE}]+"))
    return f"CASE WHEN {strip(x)} <> '' THEN {stripped} END"


LOCS = "(?:" + rx(W.TITLE_LOCATIONS) + ")"
DASH = rf"[{SPACE}]*[\-–,][{SPACE}]*"


def clean_title(x: str) -> str:
    t = sub(x, rf"(?i)[{SPACE}]*[\-–,]?[{SPACE}]*(?:posted|منذ)[{SPACE}]+.*$")
    for _ in range(3):
        t = sub(t, rf"(?i)^{LOCS}[,\-•–{SPACE}]+")
    t = sub(t, rf"(?i){DASH}{LOCS}(?:{DASH}{LOCS})*$")
    t = sub(t, rf"(?i)[{SPACE}]*\([^)]*(?:{LOCS}|Part Time|Without Accommodation)[^)]*\)$")
    t = sub(t, rf"[{SPACE}]*\([^)]*\)")
    t = sub(collapse(t), rf"^[,\-{SPACE}]+|[,\-{SPACE}]+$")
    return f"coalesce(nullif({t}, ''), {x})"


def title_characters(x: str) -> str:
    return strip(sub(strip(x), rf"[^{WORD}{SPACE}/\-().,+]+"))


def title_case(x: str) -> str:
    runs = f"regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+')"
    return (f"array_to_string(list_transform({runs}, "
            "lambda r: upper(r[1]) || lower(r[2:])), '')")


def title_from_description(x: str) -> str:
    roles = sorted({r.lower() for r in W.ROLES}, key=lambda r: (-len(r), r))
    low = f"lower({x})"
    branches = " ".join(f"WHEN contains({low}, {q(r)}) THEN {q(r.title())}" for r in roles)
    inline = (rf"(?i)job[{SPACE}]*title[:\-{SPACE}]*([A-Za-z0-9/&,\-{SPACE}]{{3,45}})"
              r"(?:location|position|about|summary|requirements|$)")
    found = f"regexp_extract({strip(x)}, {q(inline)}, 1)"
    cut = strip(sub(strip(found),
                    r"(?i)\b(?:location|position|about|summary|requirements|onsite|remote)\b.*$"))
    words = f"len(list_filter(regexp_split_to_array({cut}, '[{SPACE}]+'), lambda w: w <> ''))"
    return (f"CASE WHEN {has(low, W.NON_TECH_PHRASES)} THEN 'Technical Professional' {branches} "
            f"WHEN {found} <> '' AND {words} <= 6 THEN {title_case(cut)} "
            "ELSE 'Technical Professional' END")


def clean_city(x: str) -> str:
    low = f"lower({x})"
    branches = " ".join(
        f"WHEN {has(low, s)} THEN {q(c)}" for c, s in W.CITY_SPELLINGS.items())
    return f"CASE WHEN {has(low, W.JOB_PLATFORMS)} THEN NULL {branches} END"


def first_level(x: str, levels: dict, default: str = "NULL") -> str:
    branches = " ".join(f"WHEN {has(x, s)} THEN {q(v)}" for v, s in levels.items())
    return f"CASE {branches} ELSE {default} END"


def employment(kind: str, description: str) -> str:
    return first_level(f"lower(concat_ws(' ', {kind}, {description}))",
                       W.EMPLOYMENT_SPELLINGS, "'Full-time'")


def education(x: str) -> str:
    return first_level(f"lower({x})", W.EDUCATION_SPELLINGS)


TIME = r"([T ]+\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?"


def iso_date(x: str) -> str:
    t = strip(x)
    d = lambda pattern, fmt: (
        f"WHEN regexp_full_match({t}, {q('(' + pattern + ')' + TIME)}) "
        f"THEN strftime(try_strptime(regexp_extract({t}, {q(pattern)}), {q(fmt)}), '%Y-%m-%d')")
    return "CASE " + " ".join([
        d(r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"), d(r"\d{4}/\d{2}/\d{2}", "%Y/%m/%d"),
        d(r"\d{8}", "%Y%m%d"), d(r"\d{2}/\d{2}/\d{4}", "%m/%d/%Y")]) + " END"


def relative_date(x: str, absolute_first: bool = False) -> str:
    n = f"try_cast(nullif(regexp_extract({x}, '[0-9]+'), '') AS INTEGER)"
    day = f"strftime(DATE '{AS_OF}' - coalesce({n}, 0), '%Y-%m-%d')"
    return f"coalesce({iso_date(x)}, {day})" if absolute_first else day


# ----------------------------------------------------------------- predicates
def yes(x: str) -> str:
    return f"coalesce({x}, false)"


def tech_title(x: str) -> str:
    low = f"lower({x})"
    return yes(f"NOT {has(low, W.TECH_TITLE_EXCLUSIONS)} AND {has(low, W.TECH_TITLE_WORDS)}")


def domestic(x: str) -> str:
    return f"NOT {yes(has(f'lower({x})', W.US_LOCATION_MARKS))}"


def country_match(country: str, *where: str) -> str:
    return (f"({yes(f'upper({strip(country)}) = ' + q('SA'))} OR "
            f"{has('lower(concat_ws(' + q(' ') + ', ' + ', '.join(where) + '))', W.SAUDI_WORDS)})")


def foreign(description: str, location: str) -> str:
    return (f"({yes(has(f'lower({description})', W.US_TEXT_MARKS))} OR "
            f"{yes(has(f'lower({location})', W.US_PLACE_MARKS))})")


def valid(title: str, description: str) -> str:
    marks = f"(length({description}) - length(replace({description}, '?', '')))"
    return yes(f"{title} <> '' AND {description} <> '' AND NOT contains({description}, '???') "
               f"AND {marks} <= 5 AND NOT {has(f'lower({title})', W.NON_TECH_TITLE_WORDS)}")


def tech_posting(title: str, description: str, n_skills: str) -> str:
    t, d = f"lower({title})", f"lower({description})"
    either = lambda w: f"({yes(has(t, w))} OR {yes(has(d, w))})"
    return (f"CASE WHEN {either(W.INFRA_WORDS)} THEN true WHEN {either(W.BLOCK_WORDS)} THEN false "
            f"WHEN {yes(has(d, W.DEGREE_PHRASES))} THEN true ELSE {n_skills} > 0 END")


# --------------------------------------------------------------------- skills
def normalize_skill(x: str, keep_dash: bool = False) -> str:
    t = strip(sub(sub(strip(f"lower({x})"), r"[()\[\]{}<>.]"), f"[{SPACE}]+", " "))
    if not keep_dash:
        t = f"replace({t}, '-', ' ')"
    for wrong, right in W.SKILL_CORRECTIONS:
        t = f"replace({t}, {q(wrong)}, {q(right)})"
    return t


def skill_text(x: str) -> str:
    return sub(sub(f"lower({x})", rf"[^{WORD}{SPACE}\-./+#]", " "), f"[{SPACE}]+", " ")


def _bounded(term: str) -> str:
    word = lambda c: c == "_" or c.isalnum()
    before = f"(?:^|[^{WORD}])" if word(term[0]) else f"[{WORD}]"
    after = f"(?:$|[^{WORD}])" if word(term[-1]) else f"[{WORD}]"
    return before + rx([term]) + after


#: Rows of skill_terms for terms of the tables, which are letters, digits and blanks.
TABLE_TERMS = (f" UNION ALL SELECT term, term, '(?:^|[^{WORD}])' || term || '(?:$|[^{WORD}])' "
               f"FROM ({TERMS})")


def skills_ctes(source: str, key: str, text: str, versioned: bool = False, more: str = "") -> str:
    """CTE ``found_skills(key, skills)``: sorted list of skills per row."""
    terms = list(dict.fromkeys(
        [*VOCABULARY.terms, *(W.VERSIONED_EXTRA_SKILLS if versioned else [])]))
    rows = [(t, t, _bounded(t)) for t in terms]
    rows += [(a, s, _bounded(a)) for a, s in W.SKILL_ALIASES.items()]
    rows += [(p, p, "") for p in W.COMPOUND_PHRASES]
    values = ", ".join(f"({q(a)}, {q(s)}, {q(p)})" for a, s, p in rows)
    parts = [
        "SELECT k, skill FROM skill_texts JOIN skill_terms ON CASE WHEN contains(t, spelling) "
        "THEN pattern = '' OR regexp_matches(t, pattern) ELSE false END"]
    parts += [
        f"SELECT k, regexp_extract(t, {q(v)}) AS skill FROM skill_texts"
        for v in W.COMPOUND_VARIANTS]
    if versioned:
        parts += [
            f"SELECT k, unnest(regexp_extract_all(t, {q(p)}, 1)) AS skill "
            "FROM skill_texts" for p in W.VERSION_PATTERNS]
    return f"""
skill_terms(spelling, skill, pattern) AS (SELECT * FROM (VALUES {values}) v{more}),
skill_texts AS (SELECT {key} AS k, {skill_text(text)} AS t FROM {source}),
skill_hits AS ({' UNION ALL '.join(parts)}),
skill_names AS (SELECT DISTINCT k, {normalize_skill('skill', versioned)} AS skill FROM skill_hits),
found_skills AS (
  SELECT s.k, coalesce(list_sort(list(n.skill) FILTER (WHERE n.skill IS NOT NULL)), []) AS skills
  FROM skill_texts s LEFT JOIN (
    SELECT k, skill FROM skill_names WHERE length(skill) > 1
      AND NOT list_contains({texts(W.SKILL_STOP_WORDS)}, skill)
      AND NOT regexp_full_match(skill, '[0-9]+')) n ON n.k = s.k
  GROUP BY s.k)"""


def union_skills(given: str, found: str) -> str:
    both = f"list_filter(list_concat({given}, {found}), lambda s: s IS NOT NULL AND s <> '')"
    normal = f"list_transform({both}, lambda s: {normalize_skill('s')})"
    return f"list_sort(list_distinct(list_filter({normal}, lambda s: s <> '')))"


def comma(x: str) -> str:
    return f"array_to_string({x}, ', ')"


# ------------------------------------------------------------------ standardise
SHORT = "length(job_description) < 50"
_HTTP = f"starts_with(lower({strip('job_url')}), 'http')"
BAD_URL = f"NOT {yes(_HTTP)}"
NON_TECH = f"NOT {valid('job_title', 'job_description')}"
PER_SOURCE = {
    "tapneo": dict(
        raw="description || ' ' || title", html=False, title=title_from_description,
        title_on="raw", city=clean_city(clean_city("replace(replace(location, ',', ' •'), '•', '-')")),
        date=iso_date("date_text"), kind="employment_type", detail="raw",
        reasons=[("unresolved_title", "job_title = 'Technical Professional'"),
                 ("excluded_posting", "coalesce(job_title = 'Project Manager' AND company_name = 'AtkinsR', false)")]),
    "jsearch": dict(
        raw="description", html=True, title=clean_title, title_on="title",
        city=clean_city("location"), date=relative_date("date_text", True),
        kind="employment_type", detail="job_description",
        reasons=[("foreign", foreign("raw", "location")), ("short_description", SHORT),
                 ("bad_url", BAD_URL), ("non_tech", NON_TECH)]),
    "jooble": dict(
        raw="description", html=True, title=clean_title, title_on="title",
        city=clean_city(filled("location", "'Jeddah'")), date=iso_date("date_text"),
        kind="NULL", detail="job_description",
        reasons=[("short_description", SHORT), ("bad_url", BAD_URL), ("non_tech", NON_TECH)]),
    "freehire": dict(
        raw="description", html=True, title=clean_title, title_on="title",
        city=f"coalesce({clean_city('location')}, {clean_city('job_description')})",
        date=iso_date("date_text"), kind="employment_type", detail="job_description",
        reasons=[("non_tech", yes(has("lower(job_title)", W.FORBIDDEN_TITLE_WORDS))),
                 ("short_description", SHORT), ("bad_url", BAD_URL), ("non_tech", NON_TECH)]),
    "tanqeeb": dict(
        raw="description", html=False, title=title_characters, title_on="title",
        city=clean_city("location"), date=iso_date("date_text"), kind="employment_type",
        detail="job_description",
        reasons=[("non_tech", "NOT " + tech_posting("job_title", "job_description", "len(skills)"))]),
}


CITIES = f"""cities(key, value, priority) AS (SELECT * FROM (VALUES {', '.join(
    f"({q(k)}, {q(v)}, {i})" for i, (k, v) in enumerate(
        (k, v) for v, spellings in W.CITY_SPELLINGS.items() for k in spellings))}) v
  UNION ALL {DICTIONARY})"""


def looked_up(name: str, source: str, x: str) -> str:
    """CTE ``name(record_no, city)``: first entry of ``cities`` in a text of ``source``."""
    return f"""{name} AS (SELECT record_no, arg_min(value, (priority, key)) AS city
  FROM (SELECT record_no, lower({x}) AS low FROM {source}) s
  JOIN cities ON key <> '' AND contains(low, key)
  WHERE NOT {has('low', W.JOB_PLATFORMS)} GROUP BY record_no)"""


def classified_ctes(source: str, tables: bool = False) -> str:
    """CTEs up to ``classified``: cleaned rows with the reason they are dropped."""
    s = PER_SOURCE[source]
    if tables:
        s = s | {"city": "coalesce(by_place.city, by_text.city)"}
    text = html_text("raw") if s["html"] else "raw"
    reasons = " ".join(f"WHEN {test} THEN {q(name)}" for name, test in s["reasons"])
    return f"""
p AS ({POSTINGS}),
raws AS (SELECT *, {s['raw']} AS raw FROM p),
cleaned AS (SELECT record_no, {clean_company('company')} AS company_name,
  {s['title'](s['title_on'])} AS job_title, {clean_description(text)} AS job_description,
  nullif(url, '') AS job_url, location, date_text, employment_type, raw FROM raws),
{skills_ctes('cleaned', 'record_no', 'job_description', more=TABLE_TERMS if tables else '')},
{CITIES + ', ' + looked_up('by_place', 'cleaned', 'location') + ', ' + looked_up(
    'by_text', 'cleaned', 'job_description') + ',' if tables else ''}
detailed AS (SELECT c.*, f.skills, {s['city']} AS city FROM cleaned c
  JOIN found_skills f ON f.k = c.record_no{
  ' LEFT JOIN by_place ON by_place.record_no = c.record_no'
  ' LEFT JOIN by_text ON by_text.record_no = c.record_no' if tables else ''}),
classified AS (SELECT *, CASE {reasons} END AS skip_reason FROM detailed)"""


def staged_ctes(source: str, tables: bool = False) -> str:
    s = PER_SOURCE[source]
    keys = ", ".join(SOURCES[source].dedup_keys)
    skills = "skills"
    if source == "freehire":
        skills = union_skills("['Node.js', '(AWS)', 'scikit-learn']", "skills")
    return f"""{classified_ctes(source, tables)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY record_no) AS rank_no
  FROM classified WHERE skip_reason IS NULL),
staged AS (SELECT record_no, job_title, company_name, city, 'Saudi Arabia' AS country,
  {s['date']} AS posted_date, {employment(s['kind'], s['detail'])} AS employment_type,
  {education(s['detail'])} AS education, job_description, {skills} AS skills, job_url
  FROM ranked WHERE rank_no = 1)"""


def with_skills_text() -> str:
    return ", ".join(comma(c) + " AS skills" if c == "skills" else c for c in STAGING_COLUMNS)


def standardized(source: str, tables: bool = False) -> str:
    return f"WITH {staged_ctes(source, tables)} SELECT {with_skills_text()} FROM staged"


def every_source(select: str, ctes) -> str:
    return " UNION ALL ".join(
        f"SELECT * FROM (WITH {ctes(s)} {select.format(source=s)})" for s in SOURCES)


# -------------------------------------------------------------- simple queries
def on_postings(expression: str, name: str) -> str:
    return f"WITH p AS ({POSTINGS}) SELECT record_no, {expression} AS {name} FROM p"


def accepted(test: str) -> str:
    return on_postings(f"CAST({test} AS INTEGER)", "accepted")


TITLED = ("description || CASE WHEN record_no % 2 = 0 THEN title "
          "ELSE ' Job Title: cloud/ops guru remote' END")


def skills_query(text: str, expression: str = "skills", versioned: bool = False,
                 more: str = "") -> str:
    return (f"WITH p AS ({POSTINGS}), {skills_ctes('p', 'record_no', text, versioned, more)} "
            f"SELECT record_no, {comma(expression)} AS skills "
            "FROM p JOIN found_skills f ON f.k = p.record_no")


CONTEXT_TEXT = "'Python and python, ' || description"
SKILLS_CONTEXT = f"""
WITH p AS (SELECT record_no, {CONTEXT_TEXT} AS body FROM ({POSTINGS})),
{skills_ctes('p', 'record_no', 'body', True)},
pairs AS (SELECT p.record_no, body, lower(body) AS low, unnest(skills) AS skill
  FROM p JOIN found_skills f ON f.k = p.record_no),
cuts AS (SELECT *, string_split(low, skill) AS pieces FROM pairs WHERE contains(low, skill)),
spots AS (SELECT record_no, body, low, skill, pieces, unnest(range(1, len(pieces))) AS i FROM cuts),
spans AS (SELECT record_no, body, low, skill,
    list_sum(list_transform(pieces[1:i], lambda x: length(x))) + (i - 1) * length(skill) AS start FROM spots),
placed AS (SELECT *, substr(low, CAST(start AS BIGINT), 1) AS before,
    substr(low, CAST(start + length(skill) AS BIGINT) + 1, 1) AS after FROM spans),
bounded AS (SELECT * FROM placed WHERE
  regexp_matches(before, '[{WORD}]') <> regexp_matches(left(skill, 1), '[{WORD}]')
  AND regexp_matches(after, '[{WORD}]') <> regexp_matches(right(skill, 1), '[{WORD}]'))
SELECT record_no, skill,
  CAST(row_number() OVER (PARTITION BY record_no, skill ORDER BY start) - 1 AS INTEGER) AS pos,
  {strip("body[CAST(greatest(start - 50, 0) + 1 AS BIGINT):CAST(start + length(skill) + 50 AS BIGINT)]")} AS context
FROM bounded
"""

TERM_MATCHES = f"""
WITH terms AS ({TERMS}),
most AS (SELECT max(len(string_split(term, ' '))) AS n FROM terms),
words AS (SELECT doc_id, {skill_text('text')} AS t FROM documents),
tokens AS (SELECT doc_id, regexp_extract_all(t, '[{WORD}]+|[^{WORD}]+') AS w FROM words),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM tokens),
phrases AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2 * more], '') AS term
  FROM places, (SELECT unnest(range(0, n)) AS more FROM most)
  WHERE i + 2 * more <= len(w) AND regexp_matches(w[i], '[{WORD}]'))
SELECT doc_id, term FROM phrases SEMI JOIN terms USING (term)
"""

EVENT_MERGE = f"""
WITH early AS (
  SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id,
    arg_max(value, (ts, event_id)) AS value, min(ts) AS first_seen, max(ts) AS last_seen
  FROM events WHERE ts < TIMESTAMP '{SPLIT}' GROUP BY ALL),
late AS (
  SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id,
    arg_max(value, (ts, event_id)) AS value
  FROM events WHERE ts >= TIMESTAMP '{SPLIT}' GROUP BY ALL),
merged AS (
  SELECT coalesce(n.user_id, o.user_id) AS user_id,
    coalesce(n.event_type, o.event_type) AS event_type,
    CASE WHEN n.event_id IS NOT NULL THEN n.event_id ELSE o.event_id END AS event_id,
    CASE WHEN n.event_id IS NOT NULL THEN n.value ELSE o.value END AS value,
    coalesce(o.first_seen, TIMESTAMP '{NOW}') AS first_seen,
    CASE WHEN n.event_id IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE o.last_seen END AS last_seen,
    CASE WHEN n.event_id IS NULL THEN 'kept' WHEN o.event_id IS NULL THEN 'added'
      ELSE 'updated' END AS change
  FROM early o FULL JOIN late n ON o.user_id = n.user_id AND o.event_type = n.event_type)
"""


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column}"


MERGE_STAGING = f"""
WITH old AS (SELECT * FROM (WITH {staged_ctes('jooble')},
    last AS (SELECT *, row_number() OVER (PARTITION BY company_name, city, job_description
      ORDER BY record_no DESC) AS n FROM staged)
    SELECT * FROM last WHERE n = 1)),
new AS (SELECT * FROM (WITH {staged_ctes('jsearch')},
    last AS (SELECT *, row_number() OVER (PARTITION BY company_name, city, job_description
      ORDER BY record_no DESC) AS n FROM staged)
    SELECT * FROM last WHERE n = 1)),
pairs AS (SELECT o.record_no AS o_no, n.record_no AS n_no,
    CASE WHEN n.record_no IS NULL THEN o.company_name ELSE n.company_name END AS company_name,
    CASE WHEN n.record_no IS NULL THEN o.city ELSE n.city END AS city,
    CASE WHEN n.record_no IS NULL THEN o.job_description ELSE n.job_description END AS job_description,
    CASE WHEN n.record_no IS NULL THEN o.job_title ELSE n.job_title END AS job_title,
    CASE WHEN n.record_no IS NULL THEN o.posted_date ELSE n.posted_date END AS posted_date
  FROM old o FULL JOIN new n ON o.company_name IS NOT DISTINCT FROM n.company_name
    AND o.city IS NOT DISTINCT FROM n.city
    AND o.job_description = n.job_description)
SELECT company_name, city, job_description, job_title, posted_date,
  CASE WHEN o_no IS NOT NULL THEN '2026-08-16 12:00:00.000000' ELSE '2026-09-15 12:00:00.000000' END AS first_seen,
  CASE WHEN n_no IS NOT NULL THEN '2026-09-15 12:00:00.000000' ELSE '2026-08-16 12:00:00.000000' END AS last_seen,
  CASE WHEN n_no IS NULL THEN 'kept' WHEN o_no IS NULL THEN 'added' ELSE 'updated' END AS change
FROM pairs
"""


# ------------------------------------------------------------------------ links
def links_ctes(name: str = "links", where: str = "true") -> str:
    ignored = " AND ".join(f"NOT contains(url, {q(p)})" for p in LINK_RULES.ignored)
    social = " AND ".join(f"NOT contains(url, {q(p)})" for p in LINK_RULES.social)
    return f"""
{name} AS (SELECT DISTINCT page_no, url FROM (
  SELECT page_no, string_split(CASE
      WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
      WHEN starts_with(href, '//') THEN 'https:' || href
      WHEN starts_with(href, '/') THEN {q(LINK_RULES.base_url)} || href
      ELSE {q(LINK_RULES.base_url + '/')} || href END, '?')[1] AS url
  FROM (SELECT page_id AS page_no, {strip(decode('h'))} AS href FROM (
    SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS h
    FROM pages WHERE {where}))
  WHERE href <> '' AND NOT starts_with(href, '#') AND NOT starts_with(href, 'javascript:'))
  WHERE contains(url, {q(LINK_RULES.host)}) AND {ignored} AND {social}
    AND regexp_matches(url, {q(LINK_RULES.posting)}))"""


SEEN = f"""{links_ctes('secure', "starts_with(url, 'https')")},
seen AS (SELECT url FROM secure
  UNION SELECT 'https://jobs.example.com/' || lower(n_name) FROM nation)"""
LINK_STATS = f"""
WITH {links_ctes()}, {SEEN},
firsts AS (SELECT url, min(page_no) AS page_no FROM links GROUP BY url),
fresh AS (SELECT page_no, count(*) AS n FROM firsts ANTI JOIN seen USING (url) GROUP BY page_no),
per_page AS (SELECT l.page_no, count(*) AS links, coalesce(any_value(f.n), 0) AS new_links
  FROM links l LEFT JOIN fresh f ON f.page_no = l.page_no GROUP BY l.page_no)
SELECT page_no, links, new_links,
  CAST(sum(new_links) OVER (ORDER BY page_no) AS BIGINT) AS total_new FROM per_page
"""

PAGE_POSTING = f"""
WITH p AS ({POSTING_PAGES}),
made AS (SELECT page_id, url, head,
  CASE page_id % 5 WHEN 0 THEN 'Engineer ' || page_id WHEN 1 THEN 'Analyst' ELSE {html_text('head', '')} END AS job_title,
  CASE WHEN page_id % 5 = 0 THEN 'ACME' WHEN page_id % 3 = 0 THEN 'Company ' || page_id
    ELSE 'Not Specified' END AS company_name,
  CASE WHEN page_id % 3 = 0 THEN 'Riyadh, Saudi Arabia' ELSE 'Saudi Arabia' END AS location,
  CASE WHEN page_id % 5 = 0 THEN '2026-08-05' ELSE 'Not Specified' END AS posted_date,
  CASE WHEN page_id % 5 = 0 THEN 'CONTRACTOR' ELSE 'Not Specified' END AS employment_type,
  CASE WHEN page_id % 3 = 0 THEN {decode('head')} || chr(10) || 'More & text' || chr(10)
      || {html_text('article', chr(10))}
    WHEN page_id % 5 = 0 THEN {decode('head')} || chr(10) || '&'
    WHEN page_id % 5 = 1 THEN {decode('head')} ELSE '' END AS description
  FROM p)
SELECT page_id, job_title, company_name, location, posted_date, employment_type,
  {strip('description')} AS job_description, url AS job_url
FROM made WHERE length(job_title) >= 3 AND description <> ''
"""

FALLBACK = "'غير محدد'"
EXTRACTED = f"strftime(TIMESTAMP '{NOW}', '%Y-%m-%d %H:%M:%S')"


def _skip_report() -> str:
    return every_source(
        "SELECT {source!r} AS source, skip_reason, count(*) AS n FROM classified "
        "WHERE skip_reason IS NOT NULL GROUP BY skip_reason", classified_ctes)


ORACLES: dict[str, str] = {
    **{f"standardize_{s}": standardized(s) for s in SOURCES},
    "union_sources": every_source(
        "SELECT {source!r} AS source, count(*) AS n FROM staged", staged_ctes),
    "skip_reasons": _skip_report(),
    "raw_payloads": f"""WITH p AS ({POSTINGS}) SELECT record_no, title, company, location,
        date_text AS date, description AS snippet, url FROM p WHERE url <> ''""",
    "raw_inferred": f"""WITH p AS ({POSTINGS}) SELECT record_no, title, location,
        description AS snippet, CASE WHEN record_no % 5 = 0 THEN record_no / 4 END AS score,
        CASE WHEN record_no % 2 = 0 THEN CAST(record_no AS VARCHAR) ELSE date_text END AS mixed,
        CASE WHEN record_no % 3 = 0 THEN record_no * 2 END AS n,
        CASE WHEN record_no % 3 = 0 THEN title END AS tag FROM p""",
    "html_nested_text": f"""WITH p AS (SELECT page_id, regexp_replace(html, '<nav>.*?</nav>', '', 's') AS html
        FROM pages) SELECT page_id, {html_text('html')} AS body FROM p""",
    "html_text": f"SELECT page_id, {html_text('html')} AS body FROM pages",
    "clean_description": on_postings(clean_description("description"), "body"),
    "clean_title": on_postings(clean_title("title"), "job_title"),
    "title_characters": on_postings(title_characters("description"), "job_title"),
    "title_from_description": f"""WITH p AS (SELECT record_no, {TITLED} AS t FROM ({POSTINGS}))
        SELECT record_no, {title_from_description('t')} AS job_title FROM p""",
    "company_name": on_postings(clean_company("company"), "company_name"),
    "city": on_postings(
        f"coalesce({clean_city('location')}, {clean_city('description')})", "city"),
    "employment_type": on_postings(employment("employment_type", "description"), "kind"),
    "education": on_postings(education("description"), "level"),
    "iso_date": f"""WITH d AS ({DATE_TEXTS}) SELECT record_no, CASE WHEN date_text NOT LIKE 'posted%'
        THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM d""",
    "relative_date": on_postings(relative_date("date_text"), "day"),
    "tech_title": accepted(tech_title("title")),
    "domestic_location": accepted(domestic("location")),
    "country_match": accepted(country_match(
        "CASE WHEN record_no % 3 = 0 THEN ' sa ' END", "location", "title")),
    "valid_posting": accepted(valid("title", clean_description("description"))),
    "foreign_posting": accepted(foreign("description", "location")),
    "tech_classifier": f"""WITH p AS ({POSTINGS}), {skills_ctes('p', 'record_no', 'description')}
        SELECT record_no, CAST({tech_posting('title', 'description', 'len(skills)')} AS INTEGER)
        AS accepted FROM p JOIN found_skills f ON f.k = p.record_no""",
    "skills": skills_query("description"),
    "skills_versioned": skills_query(
        "description || ' python3 data lake, asp.net core 6; Spring Boot 2.7 java 17'",
        versioned=True),
    "skills_union": skills_query(
        "description", union_skills("['Node.js', '(AWS)', employment_type]", "skills")),
    "skills_context": SKILLS_CONTEXT,
    "term_matches": TERM_MATCHES,
    "skills_from_table": skills_query("description", versioned=True, more=TABLE_TERMS),
    "city_lookup_table": f"""WITH p AS ({POSTINGS}), {CITIES},
        {looked_up('by_place', 'p', 'location')},
        {looked_up('by_text', 'p', "concat_ws(' ', company, description)")}
        SELECT p.record_no, coalesce(a.city, b.city) AS city FROM p
        LEFT JOIN by_place a ON a.record_no = p.record_no
        LEFT JOIN by_text b ON b.record_no = p.record_no""",
    "standardize_with_tables": standardized("freehire", tables=True),
    "dedup_keep_first": """SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (
        PARTITION BY text ORDER BY doc_id) AS n FROM documents) WHERE n = 1""",
    "dedup_keep_last": """SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events)
        WHERE n = 1""",
    "dedup_latest_repost_count": """WITH e AS (SELECT event_id, event_type,
          CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id,
          CASE WHEN event_id % 97 <> 0 THEN ts END AS ts FROM events)
        SELECT event_id, user_id, event_type,
          CASE WHEN user_id IS NOT NULL THEN n END AS repost_count
        FROM (SELECT *, count(*) OVER (PARTITION BY user_id, event_type) AS n,
          row_number() OVER (PARTITION BY user_id, event_type
            ORDER BY ts DESC NULLS FIRST, event_id DESC) AS r FROM e) WHERE r = 1""",
    "repost_counts": """SELECT doc_id, count(*) OVER (PARTITION BY text) AS repost_count
        FROM documents""",
    "merge_first_last_seen": f"""{EVENT_MERGE} SELECT user_id, event_type, event_id, value,
        {stamp('first_seen')}, {stamp('last_seen')}, change FROM merged""",
    "merge_counts": f"""{EVENT_MERGE} SELECT count(*) FILTER (WHERE change = 'added') AS added,
        count(*) FILTER (WHERE change = 'updated') AS updated FROM merged""",
    "merge_staging": MERGE_STAGING,
    "page_links": f"WITH {links_ctes()} SELECT page_no, url FROM links",
    "page_posting": PAGE_POSTING,
    "unseen_urls": f"""WITH {links_ctes()}, {SEEN} SELECT min(page_no) AS page_no, url
        FROM links ANTI JOIN seen USING (url) GROUP BY url""",
    "unseen_by_bitmap": f"""WITH {links_ctes()}, {SEEN} SELECT min(page_no) AS page_no, url
        FROM links ANTI JOIN seen USING (url) GROUP BY url""",
    "seen_urls": f"WITH {SEEN} SELECT url FROM seen",
    "link_stats": LINK_STATS,
    "sample_links": f"""WITH {links_ctes()} SELECT url FROM (SELECT DISTINCT url FROM links)
        ORDER BY md5(url || 'seed-1'), url LIMIT 20""",
    "top_n_accepted": f"""WITH p AS ({POSTINGS}) SELECT record_no, title, location FROM p
        WHERE {tech_title('title')} AND {domestic('location')} ORDER BY record_no LIMIT 50""",
    "search_plan": f"""SELECT n_name AS location, CAST(i - 1 AS BIGINT) AS keyword_no,
        ({texts(W.SEARCH_KEYWORDS)})[i] AS keyword
        FROM nation, range(1, {len(W.SEARCH_KEYWORDS) + 1}) AS k(i)""",
    "search_queries": f"""SELECT keyword, keyword || ' jobs in ' || r_name AS query
        FROM region, (SELECT unnest({texts(W.QUERY_KEYWORDS)}) AS keyword)""",
    "records_jooble": f"""WITH p AS ({POSTINGS}) SELECT coalesce(title, '') AS title, company,
        location, date_text AS date, '' AS salary, description AS snippet, url,
        'jooble' AS source, 'Riyadh' AS search_location, {EXTRACTED} AS extracted_at
        FROM p WHERE {tech_title('title')} AND {domestic('location')}""",
    "records_jsearch": f"""WITH p AS (SELECT *, coalesce(nullif({strip('url')}, ''),
          CASE WHEN record_no % 2 = 0 THEN 'https://x.example.com/1' END) AS link
          FROM ({POSTINGS}))
        SELECT coalesce(title, 'بدون عنوان') AS title, coalesce(company, 'بدون شركة') AS company,
          coalesce(location, 'السعودية') AS location, date_text AS date, '5000' AS salary,
          left(description, 300) AS snippet, link AS url,
          coalesce(employment_type, 'دوام كامل') AS employment_type, 'jsearch' AS source,
          {EXTRACTED} AS extracted_at
        FROM p WHERE link IS NOT NULL AND {country_match(
            "CASE WHEN record_no % 3 = 0 THEN ' sa ' END", "location")}""",
    "records_freehire": f"""WITH p AS ({POSTINGS}) SELECT coalesce(title, {FALLBACK}) AS job_title,
          coalesce(company, {FALLBACK}) AS company_name, coalesce(location, 'Saudi Arabia') AS location,
          CASE WHEN record_no % 2 = 0 THEN coalesce(location, '') ELSE '' END AS cities,
          coalesce(date_text, {FALLBACK}) AS posted_date,
          CASE WHEN record_no % 3 <> 0 THEN coalesce(employment_type, 'tech') ELSE 'tech' END AS category,
          'aws' AS skills, description AS job_description, url AS source_url,
          'freehire' AS original_source, {EXTRACTED} AS extracted_at FROM p""",
    "mart_skill_demand": f"""WITH a AS ({every_source('SELECT skills FROM staged', staged_ctes)}),
        n AS (SELECT skill, count(*) AS postings FROM (SELECT unnest(skills) AS skill FROM a)
          GROUP BY skill)
        SELECT skill, postings, round(postings / (SELECT count(*) FROM a), 6) AS share,
          rank() OVER (ORDER BY postings DESC) AS demand_rank FROM n""",
    "mart_skill_pairs": f"""WITH a AS (SELECT row_number() OVER () AS r, skills
          FROM ({every_source('SELECT skills FROM staged', staged_ctes)})),
        s AS (SELECT DISTINCT r, unnest(skills) AS skill FROM a),
        n AS (SELECT skill, count(*) AS n FROM s GROUP BY skill),
        p AS (SELECT x.skill, y.skill AS other, count(*) AS postings FROM s x JOIN s y
          ON x.r = y.r AND x.skill < y.skill GROUP BY ALL HAVING count(*) >= 20)
        SELECT p.skill, other, postings, round(postings * (SELECT count(*) FROM a)
          / (a.n * b.n), 6) AS lift
        FROM p JOIN n a ON a.skill = p.skill JOIN n b ON b.skill = other""",
    "mart_city_type": f"""WITH a AS ({every_source(
            'SELECT city, employment_type FROM staged', staged_ctes)})
        SELECT city, employment_type, CAST(grouping(city, employment_type) AS BIGINT) AS level,
          count(*) AS postings FROM a GROUP BY CUBE (city, employment_type)""",
    "mart_daily_rolling": """WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS postings
          FROM events GROUP BY ALL)
        SELECT strftime(day, '%Y-%m-%d') AS day, postings, CAST(sum(postings) OVER (ORDER BY day
          RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS recent FROM d""",
    "stream_upsert": f"""SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id,
        arg_max(value, (ts, event_id)) AS value,
        strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_seen,
        strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_seen
        FROM events GROUP BY user_id, event_type""",
    "stream_seen_table": f"""WITH {links_ctes()}, {SEEN}
        SELECT DISTINCT url FROM links ANTI JOIN seen USING (url)""",
    "stream_unseen": f"""WITH {links_ctes()}, {SEEN}
        SELECT DISTINCT url FROM links ANTI JOIN seen USING (url)""",
}

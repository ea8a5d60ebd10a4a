"""The results of :mod:`checks.round_trips` in DuckDB SQL: what was written is read back."""

from __future__ import annotations

from checks import oracle as O

_PAIRED = f"""SELECT * REPLACE (
    CASE WHEN record_no % 6 = 0 THEN 'AtkinsR' ELSE company END AS company,
    CASE WHEN record_no % 6 = 0 THEN 'Job Title: Project Manager ' || description
      ELSE description END AS description) FROM ({O.POSTINGS})"""

ORACLES: dict[str, str] = {
    "land_and_standardize": f"""WITH {O.staged_ctes('jooble')}
        SELECT company_name, job_title FROM staged""",
    "raw_variant": O.ORACLES["raw_payloads"],
    "json_arrays": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "archive_appends": "SELECT event_id, user_id, event_type, value FROM events",
    "merged_state": f"""{O.EVENT_MERGE} SELECT user_id, event_type, event_id, value,
        {O.stamp('first_seen')}, {O.stamp('last_seen')} FROM merged""",
    "merge_bucketed": f"""{O.EVENT_MERGE} SELECT user_id, event_type, event_id, value,
        {O.stamp('first_seen')}, {O.stamp('last_seen')} FROM merged""",
    "staging_csv": O.ORACLES["standardize_jooble"],
    "staging_table": O.ORACLES["standardize_jooble"],
    "saved_links": f"WITH {O.links_ctes()} SELECT DISTINCT url FROM links",
    "record_keys": """SELECT o_orderkey, coalesce(o_orderstatus, 'None') || '||' ||
        CASE WHEN o_orderkey % 3 <> 0 THEN coalesce(CAST(o_custkey AS VARCHAR), 'None')
          ELSE 'None' END AS record_key FROM orders""",
    "excluded_postings": f"""WITH {O.classified_ctes('tapneo').replace(O.POSTINGS, _PAIRED)}
        SELECT 'tapneo' AS source, skip_reason, count(*) AS n FROM classified
        WHERE skip_reason IS NOT NULL GROUP BY skip_reason""",
    "education_levels": O.on_postings(O.education(
        "description || CASE record_no % 5 WHEN 0 THEN ' PhD or more' WHEN 1 THEN ' a Diploma' "
        "WHEN 2 THEN ' دكتوراه' ELSE '' END"), "level"),
}

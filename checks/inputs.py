"""Inputs of the checks, as SQL that Spark and DuckDB read the same way.

The given tables hold invented text, so domain words are written around it: each
document becomes a posting whose title, place, date and introduction follow from
its number, and whose description holds the whole text of the document.
"""

from __future__ import annotations

POSTINGS = """
SELECT d.doc_id AS record_no,
  CASE d.doc_id % 8 WHEN 0 THEN 'Senior Data Engineer - Riyadh' WHEN 1 THEN 'Software Engineer (Remote)'
    WHEN 2 THEN 'Jeddah - DevOps Engineer, Saudi Arabia' WHEN 3 THEN 'Civil Engineer'
    WHEN 4 THEN 'Solutions Architect' WHEN 5 THEN 'مهندس برمجيات - الرياض'
    WHEN 6 THEN 'QA Tester posted 3 days ago' ELSE '' END AS title,
  CASE WHEN d.doc_id % 11 = 0 THEN 'Client of ' ELSE '' END || c.c_name AS company,
  CASE d.doc_id % 9 WHEN 0 THEN 'Riyadh, Saudi Arabia' WHEN 1 THEN 'جدة' WHEN 2 THEN 'Al Khobar'
    WHEN 3 THEN 'Saudi Arabia' WHEN 4 THEN 'LinkedIn' WHEN 5 THEN 'Huntsville, AL'
    WHEN 6 THEN 'Austin, TX' WHEN 7 THEN 'الدمام' ELSE NULL END AS location,
  CASE d.doc_id % 5 WHEN 0 THEN '2026-08-05T07:54:34.1930000' WHEN 1 THEN '2026-08-06'
    WHEN 2 THEN 'Not Specified' WHEN 3 THEN '3 days ago' ELSE '2026-08-05T23:54:34-08:00' END AS date_text,
  CASE d.doc_id % 4 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'Part time' WHEN 2 THEN 'عقد' ELSE NULL END AS employment_type,
  '<p>Job Summary: ' ||
  CASE d.doc_id % 7 WHEN 0 THEN 'Python, SQL server and machine learning;&nbsp;Bachelor degree'
    WHEN 1 THEN 'node.js / ASP.NET core, C# &amp; full-stack' WHEN 2 THEN 'nurse for hospital'
    WHEN 3 THEN 'master of computer science' WHEN 4 THEN 'خبرة في python و علوم الحاسب'
    WHEN 5 THEN 'contract role, aws and CI/CD, zero trust architecture' ELSE 'u.s. citizen only' END
  || '</p><b>' || d.text || '</b>' AS description,
  CASE WHEN d.doc_id % 13 = 0 THEN '' WHEN d.doc_id % 17 = 0 THEN 'ftp://x/1'
    ELSE 'https://jobs.example.com/jobs/' || CAST(d.doc_id % 900 AS VARCHAR(20)) || '.html' END AS url
FROM (SELECT *, doc_id % (SELECT max(c_custkey) + 1 FROM {customer}) AS custkey FROM {documents}) d
LEFT JOIN {customer} c ON c.c_custkey = d.custkey
"""

# A dictionary that grows with the tables: nations, words of part names, customers and
# phrases of documents.
DICTIONARY = """
SELECT lower(n_name) AS key, n_name AS value, CAST(1000 + n_nationkey AS BIGINT) AS priority FROM {nation}
UNION ALL SELECT word, upper(word), CAST(10000 + min(p_partkey) AS BIGINT)
  FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS word FROM {part}
    UNION ALL SELECT p_partkey, split_part(p_name, ' ', 2) FROM {part}) w GROUP BY word
UNION ALL SELECT lower(c_name), c_name, CAST(1000000 + c_custkey AS BIGINT) FROM {customer}
UNION ALL SELECT lower(regexp_extract(text, '([A-Za-z]+ [a-z]+)', 1)), 'Place ' || CAST(doc_id AS VARCHAR(20)),
  CAST(100000000 + doc_id AS BIGINT) FROM {documents}
"""

# Terms that grow with the tables: words and whole names of parts, phrases of documents.
TERMS = """
SELECT DISTINCT term FROM (
  SELECT split_part(p_name, ' ', 1) AS term FROM {part}
  UNION ALL SELECT split_part(p_name, ' ', 2) FROM {part}
  UNION ALL SELECT lower(p_name) FROM {part}
  UNION ALL SELECT lower(regexp_extract(text, '([A-Za-z]+ [a-z]+)', 1)) FROM {documents}
  UNION ALL SELECT lower(regexp_extract(text, '([a-z]+ [a-z]+ [a-z]+ [a-z]+)', 1)) FROM {documents}
  UNION ALL SELECT lower(regexp_extract(text, '([a-z]+, [a-z]+ [a-z]+)', 1)) FROM {documents}) t
WHERE term <> '' AND term NOT LIKE '%,%'
"""

# Dates in several spellings, from the order dates.
DATE_TEXTS = """
SELECT o_orderkey AS record_no, o_orderdate,
  CASE o_orderkey % 24
    WHEN 0 THEN y || '-' || m || '-' || d WHEN 1 THEN y || '/' || m || '/' || d
    WHEN 2 THEN m || '/' || d || '/' || y WHEN 3 THEN y || m || d
    WHEN 4 THEN y || '-' || m || '-' || d || 'T23:30:00-08:00'
    WHEN 5 THEN ' ' || y || '-' || m || '-' || d || ' 10:15:00 '
    WHEN 6 THEN 'posted ' || y
    WHEN 7 THEN CASE WHEN d > '12' THEN d || '/' || m || '/' || y ELSE m || '/' || d || '/' || y END
    WHEN 8 THEN mon || ' ' || d || ', ' || y WHEN 9 THEN lower(mon) || ' ' || d || ' ' || y
    WHEN 10 THEN d || '-' || mon || '-' || y WHEN 11 THEN mon || '. ' || d || ', ' || y
    WHEN 12 THEN d || ' ' || upper(mon) || ' ' || y
    WHEN 13 THEN y || '-' || m || '-' || d || ' 10:00:00 EST'
    WHEN 14 THEN y || '-' || m || '-' || d || 'T10:00:00+03'
    WHEN 15 THEN y || '-' || m || '-' || d || 'T23:30:00Z'
    WHEN 16 THEN 'Wednesday, ' || d || ' ' || mon || ' ' || y
    WHEN 17 THEN mon || ' ' || CAST(day(o_orderdate) AS VARCHAR(2)) || CASE WHEN d IN ('01', '21', '31') THEN 'st'
      WHEN d IN ('02', '22') THEN 'nd' WHEN d IN ('03', '23') THEN 'rd' ELSE 'th' END || ', ' || y
    WHEN 18 THEN '10:15 PM ' || d || ' ' || mon || ' ' || y WHEN 19 THEN 'the ' || d || ' of ' || mon || ', ' || y
    WHEN 20 THEN y || ' ' || mon || ' ' || d WHEN 21 THEN '23:59:59.5 GMT+3 ' || y || '/' || m || '/' || d
    WHEN 22 THEN y || m || d || 'T101500' ELSE 'Sun, ' || d || ' ' || mon || ' ' || y || ' 22:10:00 +0300' END AS date_text
FROM (SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS VARCHAR(4)) AS y,
        lpad(CAST(month(o_orderdate) AS VARCHAR(2)), 2, '0') AS m,
        lpad(CAST(day(o_orderdate) AS VARCHAR(2)), 2, '0') AS d,
        substr('JanFebMarAprMayJunJulAugSepOctNovDec',
          CAST(3 * month(o_orderdate) - 2 AS INTEGER), 3) AS mon FROM {orders}) o
"""

# Pages whose navigation stands in nested hidden elements, one of them never closed by its own tag.
NESTED_PAGES = """
SELECT page_id, replace(replace(html, '<nav>', '<section><template><div><template>'), '</nav>',
  CASE page_id % 2 WHEN 0 THEN '</template>hidden</div><br/></template></section>'
    ELSE '</template>hidden</section>' END) AS html
FROM {pages}
"""

# Pages with posting markup written into them: JSON-LD as an object, as a list,
# of another type, or none; a nested description element, or none.
POSTING_PAGES = """
SELECT page_id, url,
  replace(replace(replace(html, '</head>',
    CASE page_id % 5
      WHEN 0 THEN '<script type="application/ld+json">{{"@type": "JobPosting", "title": "Engineer '
        || CAST(page_id AS VARCHAR(20)) || '", "datePosted": "2026-08-05T10:00:00", "employmentType": "CONTRACTOR", '
        || '"hiringOrganization": {{"name": "ACME"}}, "description": "<p>' || head || '</p>&amp;"}}</script></head>'
      WHEN 1 THEN '<script type="application/ld+json">[{{"@type": "Organization", "title": "No"}}, '
        || '{{"@type": "JobPosting", "title": "Analyst", "description": "' || head || '"}}]</script></head>'
      WHEN 2 THEN '<script type="application/ld+json">{{"@type": "WebPage", "title": "No"}}</script></head>'
      ELSE '</head>' END),
    '<article>',
    '<article>' || CASE page_id % 3
      WHEN 0 THEN '<div class="big job-meta-item"> Riyadh, <b>Saudi</b>  Arabia</div>'
        || '<a class="job-meta-company" href="/c">Company ' || CAST(page_id AS VARCHAR(20)) || '</a>'
        || '<div data-note="1 > 0" id="jobDescriptionBody"><div><p>' || head || '</p></div></b><p>More &amp; text</p>'
      ELSE '' END),
    -- the description is the article: its element ends by its own tag or with the article
    '</article>', CASE WHEN page_id % 6 = 0 THEN '</div><p>Not part of it</p></article>' ELSE '</article>' END) AS html,
  head, article
FROM (SELECT page_id, url, html, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS article,
        trim(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '"', '')) AS head FROM {pages}) p
"""

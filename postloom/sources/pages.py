"""Fetched pages -> posting links and posting records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import wordlists as W
from postloom.functions.html import element_html, has_class, has_value
from postloom.functions.nulls import first_filled
from postloom.functions.regex import SPACE, collapse, contains_any, let, strip
from postloom.functions.text import decode_entities, html_to_text
from postloom.operators.compute_once import compute_once


@dataclass(frozen=True)
class LinkRules:
    """Which links of a listing page are postings."""

    base_url: str = "https://saudi.tanqeeb.com"
    host: str = "saudi.tanqeeb.com"
    posting: str = W.POSTING_LINK_PATTERN
    ignored: tuple[str, ...] = tuple(W.IGNORED_LINK_PARTS)
    social: tuple[str, ...] = tuple(W.SOCIAL_LINK_HOSTS)


_HREF = r"""(?is)<a\b[^>]*?[\s"']href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def page_hrefs(html: Column) -> Column:
    """``href`` values of the anchors of a page, as written."""
    values = F.regexp_extract_all(html, F.lit(_HREF), F.lit(1))
    return F.transform(values, lambda v: strip(decode_entities(F.regexp_replace(
        v, r"""(?s)\A(["'])(.*)\1\z""", "$2"))))


def resolve_link(href: Column, base_url: str) -> Column:
    """Absolute link without its query, for pages that live at the site root."""
    scheme = base_url.split(":", 1)[0]
    return F.substring_index(
        F.when(href.rlike(r"\A[a-zA-Z][a-zA-Z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(f"{scheme}:"), href))
        .when(href.startswith("/"), F.concat(F.lit(base_url), href))
        .otherwise(F.concat(F.lit(base_url + "/"), F.regexp_replace(href, r"\A(?:\.{1,2}/)+", ""))),
        "?", 1)


def is_posting_link(link: Column, rules: LinkRules) -> Column:
    return (
        link.contains(rules.host)
        & ~contains_any(link, rules.ignored) & ~contains_any(link, rules.social)
        & link.rlike(rules.posting))


def page_links(pages: DataFrame, rules: LinkRules = LinkRules(), page: str = "page_no") -> DataFrame:
    """``(page, url)``: the distinct posting links of every page.

    Links are made distinct inside the page row, so nothing is shuffled.
    """
    hrefs = F.filter(page_hrefs(F.col("html")), lambda h: (h != "") & ~h.startswith("#")
                     & ~h.startswith("javascript:"))
    links = F.transform(hrefs, lambda h: resolve_link(h, rules.base_url))
    wanted = F.array_distinct(F.filter(links, lambda u: is_posting_link(u, rules)))
    return pages.select(page, F.explode(wanted).alias("url"))


LD_SCHEMA = (
    "array<struct<`@type`: string, title: string, datePosted: string, description: string, "
    "employmentType: string, hiringOrganization: struct<name: string>>>"
)
_LD_BLOCK = (
    r"""(?is)<script\b[^>]*\btype\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script\s*>"""
)


def json_ld_posting(html: Column) -> Column:
    """The ``JobPosting`` of the page's JSON-LD block (an object or a list), or NULL."""
    listed = F.from_json(F.regexp_extract(html, _LD_BLOCK, 1), LD_SCHEMA)
    return F.get(F.filter(listed, lambda x: x["@type"] == "JobPosting"), F.lit(0))


def page_postings(pages: DataFrame, extracted_at: Column, source: str = "tanqeeb") -> DataFrame:
    """Posting record of every valid page; other columns of ``pages`` are kept.

    JSON-LD wins over page elements for title, company and dates; the page wins
    for location and description.  Pages without a title of at least three
    characters or without a description are not postings.
    """
    html, ld = F.col("html"), F.col("__ld")
    others = [c for c in pages.columns if c not in ("url", "html")]
    staged = pages.select(*others, "url", "html", json_ld_posting(html).alias("__ld"))
    no_sep = lambda element: html_to_text(element, "")
    default = F.lit(W.NOT_SPECIFIED)
    title = F.coalesce(
        element_html(html, "h3", has_class("job-title-text")), element_html(html, "h1"))
    place = html_to_text(element_html(html, "div", has_class("job-meta-item")))
    body = F.coalesce(
        element_html(html, "div", has_value("id", "jobDescriptionBody")),
        element_html(html, "div", has_value("data-jb-field", "description")))
    description = F.when(body.isNotNull(), html_to_text(body, "\n")).otherwise(
        html_to_text(ld["description"], "\n"))
    # both are filtered on below: made once, see compute_once
    staged = compute_once(
        staged,
        job_title=first_filled(ld["title"], no_sep(title), default),
        job_description=strip(F.regexp_replace(description, rf"\n[{SPACE}]*\n", "\n")))
    kept = staged.where(
        (F.col("job_title") != W.NOT_SPECIFIED)
        & (F.length("job_title") >= W.MIN_PAGE_TITLE_CHARS)
        & (F.col("job_description") != ""))
    return kept.select(
        *others,
        "job_title",
        first_filled(
            ld["hiringOrganization"]["name"],
            no_sep(element_html(html, "a", has_class("job-meta-company"))), default,
        ).alias("company_name"),
        collapse(first_filled(place, F.lit(W.COUNTRY))).alias("location"),
        F.substring_index(F.coalesce(ld["datePosted"], default), "T", 1).alias("posted_date"),
        F.coalesce(ld["employmentType"], default).alias("employment_type"),
        "job_description",
        F.col("url").alias("job_url"),
        F.lit(source).alias("source"),
        F.date_format(extracted_at, "yyyy-MM-dd HH:mm:ss").alias("extracted_at"),
    )

"""Cleaning of company names, titles, descriptions and HTML."""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import wordlists as W
from postloom.functions.html import HIDDEN, texts, visible_texts
from postloom.functions.regex import (
    SPACE, SPACE_CHARACTERS, WORD, collapse, contains_any, first_listed, let, one_of, quote, strip, word_map,
)

# --------------------------------------------------------------------------
# HTML
# --------------------------------------------------------------------------
_HIDES = rf"(?i)<(?:{'|'.join(HIDDEN)})\b"
# entity name -> character; numbers 128-159 mean the Windows code page
_ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
# the other names of HTML 5, looked up only where the common ones have no entry
_RARE_ENTITIES = {
    name.rstrip(";"): text for name, text in html5.items() if name.rstrip(";") not in _ENTITIES
}
_CODE_PAGE = {
    f"#{n}": bytes([n]).decode("cp1252", errors="replace") for n in range(128, 160)
}


def _from_code_point(n: Column) -> Column:
    valid = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(F.when(valid, n).otherwise(F.lit(0xFFFD))), 8, "0"))
    return F.decode(utf32, "UTF-32")


def _decode_after_ampersand(piece: Column) -> Column:
    number = F.regexp_extract(piece, r"\A#(?:[xX][0-9a-fA-F]+|[0-9]+)", 0)
    name = F.regexp_extract(piece, r"\A[a-zA-Z][-.a-zA-Z0-9]*", 0)
    code = F.when(
        F.lower(F.substring(number, 2, 1)) == "x",
        F.conv(F.substring(number, 3, 20), 16, 10).try_cast("bigint"),
    ).otherwise(F.substring(number, 2, 20).try_cast("bigint"))
    tail_of = lambda entity: F.regexp_replace(
        F.substring(piece, F.length(entity) + 1, F.length(piece)), r"\A;", "")
    return (
        F.when(number != "", F.concat(
            F.coalesce(F.try_element_at(word_map(_CODE_PAGE), F.concat(F.lit("#"), code.cast("string"))),
                       _from_code_point(code), F.lit("\ufffd")),
            tail_of(number)))
        .when(name != "", F.concat(
            F.coalesce(F.try_element_at(word_map(_ENTITIES), name),
                       F.try_element_at(word_map(_RARE_ENTITIES), name),
                       F.concat(F.lit("&"), name)), tail_of(name)))
        .otherwise(F.concat(F.lit("&"), piece))
    )


def decode_entities(text: Column) -> Column:
    """Named and numeric character references become characters."""
    pieces = F.split(text, "&")
    decoded = F.array_join(
        F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(_decode_after_ampersand(p))),
        "")
    return F.when(text.contains("&"), decoded).otherwise(text)


def html_to_text(html: Column, separator: str = " ") -> Column:
    """Visible text of an HTML fragment: trimmed text nodes joined by a separator."""
    def visible(node: Column) -> Column:
        return strip(decode_entities(node))

    def extract(source: Column) -> Column:
        # only texts with an element that hides its content need the stack of open elements
        pieces = F.when(source.rlike(_HIDES), visible_texts(source)).otherwise(texts(source))
        nodes = F.filter(F.transform(pieces, visible), lambda n: n != "")
        return F.when(source.contains("<"), F.array_join(nodes, separator)).otherwise(
            visible(source))

    return F.coalesce(let(html, extract), F.lit(""))


# --------------------------------------------------------------------------
# Descriptions
# --------------------------------------------------------------------------
_MARKS = f"[{SPACE}{quote(W.INTRO_MARKS)}]*+"
# One pass removes the introductions that open the text, in list order: a phrase
# whose turn has passed stays.
_INTRO = r"(?iu)\A" + "".join(f"(?:{_MARKS}{p}{_MARKS})?+" for p in W.INTRO_PHRASES)


_TITLE_PREFIX = rf"(?iu)\A(?:{'|'.join(W.TITLE_PREFIXES)})[{SPACE}]*"


def _without_title(text: Column, title: Column) -> Column:
    """Text without a leading "job title: <title>"; the title is compared as a literal."""
    def cut(rest: Column) -> Column:
        same = F.lower(F.substring(rest, F.lit(1), F.length(title))) == F.lower(title)
        behind = F.regexp_replace(
            F.substring(rest, F.length(title) + 1, F.length(rest)), rf"\A[{SPACE}]*", "")
        return F.when(text.rlike(_TITLE_PREFIX) & same & (title != ""), behind).otherwise(text)

    return let(F.regexp_replace(text, _TITLE_PREFIX, ""), cut)


def clean_description(description: Column, job_title: Column | None = None) -> Column:
    """Plain description: no tags, introductions, bullets or mail hints.

    With ``job_title`` a leading "job title: <title>" is dropped too.
    """
    text = F.regexp_replace(description, "<[^<]+?>", "")
    for entity, character in W.DESCRIPTION_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    if job_title is not None:
        text = _without_title(text, job_title)
    text = F.regexp_replace(text, _INTRO, "")
    text = F.translate(text, W.BULLET_MARKS, " " * len(W.BULLET_MARKS))
    text = F.regexp_replace(text, rf"(?iu)view email address on [^{SPACE}]+", "")
    return F.coalesce(collapse(text), F.lit(""))


# --------------------------------------------------------------------------
# Companies and titles
# --------------------------------------------------------------------------
def clean_company_name(company: Column) -> Column:
    name = F.regexp_replace(strip(company), rf"(?iu)\Aclient of[{SPACE}]+", "")
    return F.nullif(strip(name), F.lit(""))


def title_case(text: Column) -> Column:
    """Upper case after every non-letter, lower case elsewhere."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


_INLINE_TITLE = (
    rf"(?iu)job[{SPACE}]*title[:\-{SPACE}]*([A-Za-z0-9/&,\-{SPACE}]{{3,45}})"
    rf"(?={'|'.join(W.INLINE_TITLE_STOPS)}|\z)"
)
_INLINE_CUT = rf"(?iud)\b(?:{'|'.join(W.INLINE_TITLE_CUTS)})\b.*$"


def ranked_roles() -> list[str]:
    """Role names, lower case: longest first, equal lengths in alphabetical order."""
    return sorted({r.lower() for r in W.ROLES}, key=lambda r: (-len(r), r))


def title_from_description(description: Column) -> Column:
    """Title found inside a description: a known role, else "job title: ...".

    Falls back to the default title when the text is blank, names a non-technical
    role or holds no title.
    """
    def inline(text: Column) -> Column:
        def tidy(found: Column) -> Column:
            title = strip(F.regexp_replace(strip(found), _INLINE_CUT, ""))
            n_words = F.size(F.filter(F.split(title, f"[{SPACE}]+"), lambda w: w != ""))
            return F.when((found != "") & (n_words <= 6), title_case(title))

        return let(F.regexp_extract(text, _INLINE_TITLE, 1), tidy)

    titles = {role: role.title() for role in ranked_roles()}

    def choose(lowered: Column) -> Column:
        return (
            F.when(contains_any(lowered, W.NON_TECH_PHRASES), F.lit(W.DEFAULT_TITLE))
            .otherwise(F.coalesce(
                first_listed(lowered, titles),
                F.when(lowered.contains("title"), inline(strip(description))))))

    return F.coalesce(let(F.lower(description), choose), F.lit(W.DEFAULT_TITLE))


_PLACES = one_of(W.TITLE_LOCATIONS)
# Runs of space are taken whole and from their start, so that a title full of
# blanks costs no more than another.
_GAP = f"[{SPACE}]*+"
_FIRST_GAP = f"(?<![{SPACE}]){_GAP}"
_PLACE_AT_END = rf"{_FIRST_GAP}[\-–,]{_GAP}{_PLACES}"
_TITLE_FRONT = [
    # "... posted 3 days ago"
    rf"(?iud){_FIRST_GAP}[\-–,]?{_GAP}{one_of(W.TITLE_POSTED_WORDS)}[{SPACE}]+.*$",
    # up to three places in front
    rf"(?iud)\A(?:{_PLACES}[,\-•–{SPACE}]+){{0,3}}",
]
_TITLE_BRACKETS = [
    # a bracket at the end that names a place or a working mode
    rf"(?iud){_FIRST_GAP}\([^)]*(?:{_PLACES}|{one_of(W.TITLE_BRACKET_WORDS)})[^)]*\)$",
    # any other bracket
    rf"{_FIRST_GAP}\([^)]*\)",
]


def _without_places_at_end(title: Column) -> Column:
    """All places after the last other word.

    The repeated part is possessive, so that a title of any length is matched in a loop.
    """
    return F.regexp_replace(
        title, rf"(?iud){_PLACE_AT_END}(?:{_GAP}[\-–,]{_GAP}{_PLACES}(?={_GAP}(?:[\-–,]|$)))*+$", "")


def clean_title(title: Column) -> Column:
    """Title without places, brackets and age; the given title if nothing is left."""
    text = title
    for step in _TITLE_FRONT:
        text = F.regexp_replace(text, step, "")
    text = _without_places_at_end(text)
    for step in _TITLE_BRACKETS:
        text = F.regexp_replace(text, step, "")
    text = F.btrim(collapse(text), F.lit("-," + SPACE_CHARACTERS))
    return F.coalesce(F.nullif(text, F.lit("")), title)


def keep_title_characters(title: Column) -> Column:
    """Title reduced to letters, numbers, space and ``/ - ( ) . , +``."""
    return strip(F.regexp_replace(strip(title), rf"[^{WORD}{SPACE}/\-().,+]+", ""))

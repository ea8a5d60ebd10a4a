"""Elements of HTML texts: one constant pattern finds the tags, a fold keeps the open elements.

A text is cut into tags and the texts between them. Comments, declarations, and ``script`` and
``style`` with their raw content are one tag each; a ``>`` in a quoted value ends no tag. The
fold runs over the tags with a stack of open elements: an end tag closes the last open element
of its name and all that are open inside it, one without an open element is ignored, void and
self-closing tags stay closed at once, and what is open at the end reaches to the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions.regex import SPACE, let, strip, word_array

# A possessive group is matched in a loop, so the matcher's stack stays flat.
TAG_BODY = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
_RAW = rf"(script|style)\b(?:{TAG_BODY}|[^>]*+>).*?(?:</\1\s*+>|\z)"
TAG = rf"(?is)<(?:!--.*?-->|{_RAW}|[!?][^>]*+>|/?[a-z](?:{TAG_BODY}|[^>]*+>))"

# Elements without content, and those whose content is no visible text.
VOID = ["area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr",
        "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid",
        "param", "source", "spacer", "track", "wbr"]
HIDDEN = ["template", "rt", "rp"]

_NAME = rf"(?s)\A</?([a-zA-Z][^{SPACE}/>]*)"
_ATTRIBUTE = (rf"""(?s)([^{SPACE}"'<>/=]+)(?:[{SPACE}]*=[{SPACE}]*"""
              rf"""("[^"]*+"|'[^']*+'|[^{SPACE}"'>]++))?""")


def tag_name(tag: Column) -> Column:
    """Name of a tag in lower case; empty for comments and declarations."""
    return F.lower(F.regexp_extract(tag, _NAME, 1))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, as written, or NULL; the last one counts."""
    def last(pairs: Column) -> Column:
        own = F.filter(pairs, lambda p: F.lower(p["n"]) == name)
        return F.when(F.size(own) > 0, F.regexp_replace(
            F.element_at(own, -1)["v"], r"""(?s)\A(["'])(.*)\1\z""", "$2"))

    return let(F.arrays_zip(
        F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1)).alias("n"),
        F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(2)).alias("v")), last)


def has_class(name: str) -> Callable[[Column], Column]:
    """Test of an opening tag: ``name`` is one of its classes."""
    return lambda tag: F.array_contains(
        F.split(strip(F.coalesce(attribute(tag, "class"), F.lit(""))), f"[{SPACE}]+"), name)


def has_value(key: str, value: str) -> Callable[[Column], Column]:
    """Test of an opening tag: the attribute ``key`` is ``value``."""
    return lambda tag: F.coalesce(attribute(tag, key) == value, F.lit(False))


def tags(html: Column) -> Column:
    """The tags of a text, in order; the texts between them are those of :func:`texts`."""
    return F.regexp_extract_all(html, F.lit(TAG), F.lit(0))


def texts(html: Column) -> Column:
    """The texts before, between and behind the tags: one more than there are tags."""
    return F.split(html, TAG)


def _events(listed: Column) -> Column:
    """Tags that open or close an element, as (name, place, opens)."""
    raw = F.array(F.lit("script"), F.lit("style"))
    named = F.transform(listed, lambda t, i: F.struct(
        tag_name(t).alias("name"), i.alias("place"), (~t.startswith("</")).alias("opens"),
        t.endswith("/>").alias("shut")))
    return F.filter(named, lambda e: (e["name"] != "") & ~F.array_contains(raw, e["name"])
                    & ~(e["opens"] & (e["shut"] | F.array_contains(word_array(VOID), e["name"]))))


def _after(stack: Column, event: Column) -> Column:
    """Open elements behind an event."""
    at = F.array_position(F.reverse(stack), event["name"])  # 1 for the innermost, 0 for none
    left = F.slice(stack, F.lit(1), (F.size(stack) - at).cast("int"))
    return F.when(event["opens"], F.array_append(stack, event["name"])).when(
        at > 0, left).otherwise(stack)


def element_html(html: Column, tag: str, test: Callable[[Column], Column] | None = None) -> Column:
    """Inner HTML of the first element ``tag`` that passes the test, or NULL."""
    empty = F.array().cast("array<string>")

    def inner(listed: Column) -> Column:
        hits = F.filter(F.transform(listed, lambda t, i: F.struct(
            i.alias("place"), (t.startswith("<") & (tag_name(t) == tag) & ~t.startswith("</")
                               & (test(t) if test else F.lit(True))).alias("hit"))),
            lambda h: h["hit"])
        return let(F.get(hits, F.lit(0))["place"], lambda start: F.when(
            start.isNotNull(), let(end_of(listed, start), lambda end: cut(listed, start, end))))

    def end_of(listed: Column, start: Column) -> Column:
        """Place of the tag that closes the element; the number of tags if none does."""
        state = F.struct(empty.alias("stack"), F.lit(0).alias("depth"),
                         F.lit(None).cast("int").alias("end"))

        def step(s: Column, e: Column) -> Column:
            return let(_after(s["stack"], e), lambda stack: F.struct(
                stack.alias("stack"),
                F.when(e["place"] == start, F.size(stack)).otherwise(s["depth"]).alias("depth"),
                F.when(s["end"].isNull() & (s["depth"] > 0) & (F.size(stack) < s["depth"]),
                       e["place"]).otherwise(s["end"]).alias("end")))

        return F.aggregate(_events(listed), state, step,
                           lambda s: F.coalesce(s["end"], F.when(
                               s["depth"] > 0, F.size(listed)).otherwise(start + 1)))

    def cut(listed: Column, start: Column, end: Column) -> Column:
        size = end - start - 1  # tags inside
        between = F.slice(texts(html), start + 2, size + 1)
        inside = F.concat(F.slice(listed, start + 2, size), F.array(F.lit("")))
        return F.array_join(F.zip_with(between, inside, lambda a, b: F.concat(a, b)), "")

    possible = html.rlike(rf"(?i)<{tag}\b")
    return F.when(possible, let(tags(html), inner))


def visible_texts(html: Column) -> Column:
    """The texts between tags that stand in no hidden element, at any depth."""
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("stack"), F.lit(0).alias("hidden"),
                     F.array().cast("array<struct<place:int,off:boolean>>").alias("turns"))

    def step(s: Column, e: Column) -> Column:
        """``hidden``: depth of the outermost hidden element; ``turns``: where that changes."""
        def after(stack: Column) -> Column:
            opens = (s["hidden"] == 0) & e["opens"] & F.array_contains(word_array(HIDDEN), e["name"])
            closes = (s["hidden"] > 0) & (F.size(stack) < s["hidden"])
            turn = F.struct(e["place"].alias("place"), opens.alias("off"))
            return F.struct(
                stack.alias("stack"),
                F.when(opens, F.size(stack)).when(closes, 0).otherwise(s["hidden"]).alias("hidden"),
                F.when(opens | closes, F.array_append(s["turns"], turn)).otherwise(
                    s["turns"]).alias("turns"))

        return let(_after(s["stack"], e), after)

    def shown(pieces: Column, turns: Column) -> Column:
        # text i stands behind tag i - 1: the last turn in front of it decides
        return F.filter(F.transform(pieces, lambda t, i: F.struct(t.alias("t"), F.coalesce(
            F.try_element_at(F.filter(turns, lambda x: x["place"] < i), F.lit(-1))["off"],
            F.lit(False)).alias("off"))), lambda x: ~x["off"])

    def read(listed: Column) -> Column:
        turns = F.aggregate(_events(listed), start, step, lambda s: s["turns"])
        return let(turns, lambda ts: F.transform(
            F.when(F.size(ts) > 0, shown(texts(html), ts)).otherwise(
                F.transform(texts(html), lambda t: F.struct(t.alias("t"), F.lit(False).alias("off")))),
            lambda x: x["t"]))

    return let(tags(html), read)

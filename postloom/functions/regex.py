"""Regular-expression building blocks shared by all text rules.

Character classes are written out (letters, numbers, underscore; all Unicode
space) instead of ``\\w`` and ``\\s``: Java's shorthands are ASCII unless flagged
and would erase Arabic text, and their meaning differs between JDK versions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"
SPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WORD_AFTER, NO_WORD_AFTER = f"(?=[{WORD}])", f"(?![{WORD}])"
WORD_BEFORE, NO_WORD_BEFORE = f"(?<=[{WORD}])", f"(?<![{WORD}])"

_SPECIAL = set("\\^$.|?*+()[]{}-#&/")


def quote(text: str) -> str:
    return "".join("\\" + ch if ch in _SPECIAL else ch for ch in text)


def is_word_char(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def one_of(words: Iterable[str]) -> str:
    """Plain alternation, in the given order."""
    return "(?:" + "|".join(quote(w) for w in words) + ")"


def longest_of(words: Iterable[str], end: Callable[[str], str] = lambda ch: "") -> str:
    """Alternation that shares common prefixes and prefers the longest word.

    A matcher walks it like a prefix tree, so the cost per text position depends
    on the letters read, not on the number of words.  ``end`` gives the assertion
    to put after a word, from its last letter.
    """
    tree: dict = {}
    for word in words:
        node = tree
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = word[-1]

    def render(node: dict) -> str:
        options = [quote(ch) + render(child) for ch, child in node.items() if ch]
        if "" in node:
            options.append(end(node[""]))
        return options[0] if len(options) == 1 else "(?:" + "|".join(options) + ")"

    return render(tree)


def whole_word_scans(words: Iterable[str], separators: str) -> list[str]:
    """Patterns whose group 1 is the longest whole word starting at a position.

    ``separators`` are the characters, other than word characters, that occur in
    the text (as the inside of a character class).  A word that starts (ends) with
    a separator needs a word character before (after) it: that is what a word
    boundary means there.  Words overlap, so they are looked at, not consumed.
    """
    def end(ch: str) -> str:
        return NO_WORD_AFTER if is_word_char(ch) else WORD_AFTER

    words = list(words)
    plain = [w for w in words if is_word_char(w[0])]
    marked = [w for w in words if not is_word_char(w[0])]
    scans = []
    if plain:
        scans.append(rf"(?:\A|[{separators}])(?=({longest_of(plain, end)}))")
    if marked:
        scans.append(f"(?=({longest_of(marked, end)})){WORD_BEFORE}")
    return scans


def by_part(words: Iterable[str]) -> dict[str, list[str]]:
    """part -> words that hold it: every word stands under one part, which may be the word itself.

    A text without the part holds none of its words, so a long list costs few searches.
    """
    left, groups = list(dict.fromkeys(words)), {}
    while left:
        # short parts stand in most texts
        parts = {p: sum(p in w for w in left) for w in left for p in (w, *w.split()) if len(p) > 3}
        best = max(parts, key=lambda p: (parts[p], len(p)), default=left[0])
        groups[best] = [w for w in left if best in w]
        left = [w for w in left if best not in w]
    return groups


def listed_words(text: Column, words: Iterable[str]) -> Column:
    """The words that occur in the text, as substrings; in no given order."""
    groups = by_part(words)
    single = [g[0] for g in groups.values() if len(g) == 1]
    none = F.array().cast("array<string>")

    def search(t: Column) -> Column:
        found = [F.filter(word_array(single), lambda w: t.contains(w))] if single else []
        found += [
            F.when(t.contains(part), F.filter(word_array(group), lambda w: t.contains(w))).otherwise(none)
            for part, group in groups.items() if len(group) > 1]
        return F.when(t.isNotNull(), F.concat(*found))

    return let(text, search)


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Whether any word occurs in the text, as a substring.

    Plain substring searches are several times cheaper than one pass of a regular
    expression; the first hit ends them.
    """
    words = list(words)
    groups = by_part(words)
    shared = {part: g for part, g in groups.items() if len(g) > 1}
    single = [w for w in words if not any(w in g for g in shared.values())]

    def search(t: Column) -> Column:
        found = F.lit(False)
        if single or not shared:
            found = F.exists(word_array(single), lambda w: t.contains(w))
        for part, group in shared.items():
            found |= t.contains(part) & F.exists(word_array(group), lambda w: t.contains(w))
        return found

    return let(text, search)


def first_listed(text: Column, values: dict[str, str]) -> Column:
    """Value of the first key, in the given order, that occurs in the text."""
    places = word_map({key: str(i) for i, key in enumerate(values)})
    found = F.transform(listed_words(text, values), lambda k: F.try_element_at(places, k).cast("int"))
    return F.get(word_array(values.values()), F.array_min(found))


def by_spelling(levels: dict[str, list[str]]) -> dict[str, str]:
    """``value -> spellings`` turned round, keeping the order."""
    return {s: value for value, spellings in levels.items() for s in spellings}


def strip(text: Column) -> Column:
    """Trim all Unicode space, not only the ASCII blank that ``trim`` removes."""
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def collapse(text: Column) -> Column:
    """Every run of space becomes one blank; none stays at the ends.

    Only runs that are not one blank already are rewritten.
    """
    return F.trim(F.regexp_replace(text, f"[{SPACE}&&[^ ]][{SPACE}]*+| [{SPACE}]++", " "))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def word_array(words: Iterable[str]) -> Column:
    """Constant array, sent to the planner as one literal."""
    return F.split(F.lit("\x01".join(words)), "\x01")


def word_map(pairs: dict[str, str]) -> Column:
    """Constant map, sent to the planner as one literal."""
    text = "\x01".join(f"{k}\x02{v}" for k, v in pairs.items())
    return F.str_to_map(F.lit(text), F.lit("\x01"), F.lit("\x02"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)

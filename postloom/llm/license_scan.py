"""Licence scans: matching statistics against a suffix automaton of licence templates.

The templates' words form one generalised suffix automaton. A text is streamed through it word by
word; the state's length is the longest template passage that ends at that word (the matching
statistic). A maximal match of at least ``MIN_MATCH`` words is a long match. Of the matches of
one template the best chain is found by dynamic programming: a match follows another one behind
it in text and template, at most ``GAP`` words later in the text and ``SKIPPED`` in the template, and
is trimmed where the two overlap. A template whose best chain covers at least ``MIN_SHARE`` of it
gives its label, and so does one of at most ``SHORT`` words that stands in the text as a whole; the
score is the largest share.

Templates and base phrases are parameters: pairs of label and text, whole licences or notices.

Base phrases (``mit license``, ``apache license``, ``general public license``) are counted at
every place, also where they overlap a template.

Words: A-Z become lower case; runs of digits, letters and characters beyond ASCII.

Defined cases: null and empty texts have no words, score 0 and null places; repeated rows each
have their row; equal matches go to the template that comes first; an empty table gives an
empty result; extra columns are not read.

Scale: no shuffle; the automaton is a small constant of every task; a text is read once, and
words outside the templates' vocabulary only reset the state.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import arrow_rows, ascii_words, utf8

MIN_MATCH = 4
SHORT = 6
GAP, SKIPPED = 8, 60
MIN_SHARE = 0.5

#: Phrases of the base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Texts and notices of public licences.
#: Label and text of each.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions: "
     "The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software. "
     "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
     "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
     "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
     "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
     "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
     "DEALINGS IN THE SOFTWARE."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit", "Released under the MIT License."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met:"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
     "or without fee is hereby granted, provided that the above copyright notice and this "
     "permission notice appear in all copies."),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc", "Licensed under CC BY-NC"),
    ("cc", "Licensed under CC BY-SA"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced."),
    ("proprietary", "All rights reserved."),
)


class Automaton:
    """Generalised suffix automaton of the templates' words.

    A state stands for the passages that end at the same template places; ``ends`` names one
    such place per template (template, index behind the last word).
    """

    def __init__(self, templates: tuple[tuple[str, str], ...]) -> None:
        self.labels = [label for label, _ in templates]
        self.words = [ascii_words(text.encode()) for _, text in templates]
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for t, words in enumerate(self.words):
            last = 0
            for i, word in enumerate(words):
                last = self._add(last, word)
                self.ends[last].append((t, i + 1))
        self.vocabulary = frozenset(w for words in self.words for w in words)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[state]] += self.ends[state]
        self.ends = [sorted(set(e)) for e in self.ends]
        #: short templates that are a suffix of a state's passages
        self.whole: list[tuple[int, ...]] = [()] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            own = tuple(t for t, end in self.ends[state] if self.length[state] == end
                        == len(self.words[t]) and end <= SHORT)
            self.whole[state] = self.whole[self.link[state]] + own

    def _new(self, step: dict[bytes, int], link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.step) - 1

    def _add(self, last: int, word: bytes) -> int:
        """State of the passage of ``last`` with one more word."""
        if word in self.step[last]:
            return self._split(last, word)
        state = self._new({}, 0, self.length[last] + 1)
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, word)
        return state

    def _split(self, state: int, word: bytes) -> int:
        """Target of a step, made a state of its own if it also has longer passages."""
        target = self.step[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(dict(self.step[target]), self.link[target], self.length[state] + 1)
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def matches(self, words: list[bytes], whole: set[int] | None = None) -> list[tuple[int, int, int]]:
        """Maximal matches (first word, number of words, state) of at least MIN_MATCH words.

        Short templates that stand in the text as a whole are added to ``whole``.
        """
        out = []
        state, length = 0, 0
        step, link, lengths = self.step, self.link, self.length
        known = self.vocabulary
        for i in [i for i, w in enumerate(words) if w in known] + [len(words)]:
            word = words[i] if i < len(words) else b""
            if length and at != i - 1:  # a word outside the templates stands between
                if length >= MIN_MATCH:
                    out.append((at - length + 1, length, state))
                state = length = 0
            if word not in step[state]:
                if length >= MIN_MATCH:
                    out.append((i - length, length, state))
                while state and word not in step[state]:
                    state = link[state]
                    length = lengths[state]
            if word in step[state]:
                state = step[state][word]
                length += 1
                if whole is not None and self.whole[state]:
                    whole.update(t for t in self.whole[state] if len(self.words[t]) <= length)
            at = i
        return out


@lru_cache(maxsize=4)
def automaton(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> Automaton:
    return Automaton(templates)


def best_chain(parts: list[tuple[int, int, int]]) -> int:
    """Words of a template that the best chain of matches covers.

    ``parts``: (first word in the text, number of words, first word in the template), in the
    order of the text. Only matches that end at most ``GAP`` words in front are looked back at,
    and matches are no longer than the template, so the work grows with the text.
    """
    longest = max(n for _, n, _ in parts)
    covered: list[int] = []
    back = 0
    for i, (start, n, first) in enumerate(parts):
        best = n
        while parts[back][0] + longest < start - GAP:
            back += 1
        for j in range(i - 1, back - 1, -1):
            behind, place = parts[j][0] + parts[j][1], parts[j][2] + parts[j][1]
            if start <= parts[j][0] or first <= parts[j][2]:
                continue
            overlap = max(0, behind - start, place - first)
            if overlap < n and start + overlap - behind <= GAP and first + overlap - place <= SKIPPED:
                best = max(best, covered[j] + n - overlap)
        covered.append(best)
    return max(covered)


def chains(found: list[tuple[int, int, int]], auto: Automaton) -> dict[int, float]:
    """Share of each template that its best chain of matches covers."""
    places: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for start, n, state in found:
        for template, end in auto.ends[state]:
            places[template].append((start, n, end - n))
    return {t: best_chain(parts) / len(auto.words[t]) for t, parts in places.items()}


def _split_phrases(phrases: dict[str, str]) -> list[tuple[tuple[bytes, ...], str]]:
    return [(tuple(ascii_words(p.encode())), label) for p, label in phrases.items()]


def scan(data: bytes, auto: Automaton, phrases: list) -> dict[str, object]:
    words = ascii_words(data)
    places = []
    lasts = {p[-1] for p, _ in phrases}
    if not lasts.isdisjoint(words):
        for i, word in enumerate(words):
            if word in lasts:
                for phrase, label in phrases:
                    start = i + 1 - len(phrase)
                    if start >= 0 and tuple(words[start:i + 1]) == phrase:
                        places.append((start, label))
    whole: set[int] = set()
    shares = chains(auto.matches(words, whole), auto) | dict.fromkeys(whole, 1.0)
    base = {label for _, label in places}
    more = {auto.labels[t] for t, share in shares.items() if share >= MIN_SHARE}
    return {
        "n_words": len(words), "n_base": len(places),
        "first_word": min(places)[0] if places else None,
        "last_word": max(places)[0] if places else None,
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | more)),
        "score": min(1.0, max(shares.values(), default=0.0)),
    }


def license_scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """One row per document: places of base phrases, labels and score of covered templates."""
    listed = _split_phrases(phrases)

    def make(ids: list, texts: list):
        auto = automaton(templates)
        rows = [scan(t, auto, listed) for t in texts]
        yield {"doc_id": ids} | {c: [r[c] for r in rows] for c in (
            "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}

    return arrow_rows(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("data")), make,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double")

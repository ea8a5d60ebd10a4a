"""A vocabulary table as a prefix tree, matched word by word.

Texts and terms are cut into runs of word characters and the runs of marks between them. A term
that stands between word boundaries is a sequence of whole runs: marks at either of its ends
need a word character beyond them, so the text's run of marks ends there as well. A node of the
tree is a prefix of a term that ends with a word, or a whole term that ends with marks; its
table has one row a node.

Terms of two or more words are opened by their first two words: those of every place of a text
meet the nodes, and only what does meet is followed to the next words. Shorter terms meet
the distinct words of a text and what stands around marks. All of it is equi-joins: neither the plan
nor the driver holds the terms. A text is cut by two patterns without any looking ahead; the
rest is work on the arrays of its words.

Beyond ``BROADCAST_NODES`` nodes the places of texts are not shuffled from level to level: where the
first two words may open a term, all spellings that may be terms are made at once, and those that the
bits of the terms (:mod:`postloom.operators.hash_bits`) let through meet the terms by one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.regex import WORD
from postloom.operators.hash_bits import HashBits, meet
from postloom.operators.substring_index import HASH
from postloom.session import cut_lineage

BROADCAST_NODES = 1_000_000
_TOKEN = f"([{WORD}]++|[^{WORD}])"
#: A word with the marks before it.
_WORD, _CHUNK = f"[{WORD}]++", f"[^{WORD}]*+[{WORD}]++"
#: Nodes of terms of two or more words, those of them that begin with marks, ends that are marks.
_LONG, _MARKED, _TAIL = "long", "marked", "tail"
_SHAPES = ["w", "wm", "m", "mw", "mwm"]
_PLACE = "struct<node:string,rest:array<string>>"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s){_TOKEN}"), F.lit(1))


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_CHUNK), F.lit(0))


def _marks(chunk: Column) -> Column:
    return F.regexp_extract(chunk, rf"\A[^{WORD}]*+", 0)


def build_trie(terms: DataFrame) -> DataFrame:
    """(``level``, ``shape``, ``node``, ``reports``): every node and what the term that ends there reports.

    ``terms``: ``term`` and ``report``, the name it stands for. ``level``: words of the node;
    terms of one word or none have level 1 and the order of their words and marks as shape.
    """
    cut = terms.where(F.coalesce("term", F.lit("")) != "").select(
        "term", "report", _chunks(F.col("term")).alias("c"))
    cut = cut.select("*", F.size("c").alias("n"), F.array_join("c", "").alias("words"))
    whole = F.col("words") == F.col("term")

    def node(level: Column, shape: Column, text: Column, report: Column) -> Column:
        return F.struct(level.alias("level"), shape.alias("shape"), text.alias("node"),
                        report.alias("report"))

    opened = F.when(F.col("term").rlike(rf"\A[^{WORD}]"), "m").otherwise("")
    shape = F.concat(opened, F.when(F.col("n") == 0, "").when(whole, "w").otherwise("wm"))
    short = F.array(node(F.lit(1), shape, F.col("term"), F.col("report")))
    prefixes = F.transform(F.sequence(F.lit(2), F.col("n")), lambda n: node(
        n, F.when((n == 2) & (opened != ""), _MARKED).otherwise(_LONG), F.array_join(F.slice("c", 1, n), ""),
        F.when((n == F.col("n")) & whole, F.col("report"))))
    tail = F.when(whole, F.array().cast(
        "array<struct<level:int,shape:string,node:string,report:string>>")).otherwise(
        F.array(node(F.col("n"), F.lit(_TAIL), F.col("term"), F.col("report"))))
    nodes = F.when(F.col("n") < 2, short).otherwise(F.concat(prefixes, tail))
    return cut.select(F.inline(nodes)).groupBy("level", "shape", "node").agg(
        F.collect_set("report").alias("reports"))


def _place(node: Column, rest: Column | None = None) -> Column:
    return F.struct(node.alias("node"), (F.lit(None) if rest is None else rest).cast(
        "array<string>").alias("rest"))


def _with_gaps(cut: DataFrame) -> DataFrame:
    """Places whose marks may belong to a term: those that are one blank do not."""
    def is_gap(i: Column) -> Column:
        chunk, word = F.get("c", i), F.get("w", i)
        return ~F.startswith(chunk, F.lit(" ")) | (F.octet_length(chunk) > F.octet_length(word) + 1)

    return cut.withColumn("gaps", F.filter(_after(), is_gap))


def _after() -> Column:
    """The places of all words but the first."""
    size = F.size("w")
    return F.when(size > 1, F.sequence(F.lit(1), size - 1)).otherwise(F.array().cast("array<int>"))


def _places(shapes: set[str], beyond: int) -> Column:
    """What terms may begin with, from ``w``, the words of a text, and ``c``, those with the marks before.

    (``node``, ``rest``): a piece of a given shape, or two words and the ``beyond`` next chunks.
    """
    w, c, gaps = F.col("w"), F.col("c"), F.col("gaps")
    inner = F.filter(gaps, lambda i: i < F.size("w") - 1)

    def word(i: Column) -> Column:
        return F.get(w, i)

    def marked(i: Column) -> Column:
        return F.get(c, i)

    def marks(i: Column) -> Column:
        return _marks(marked(i))

    pieces = {
        "w": w,
        "wm": F.transform(gaps, lambda i: F.concat(word(i - 1), marks(i))),
        "m": F.transform(gaps, marks),
        "mw": F.transform(gaps, marked),
        "mwm": F.transform(inner, lambda i: F.concat(marked(i), marks(i + 1))),
    }
    listed = [pieces[s] for s in _SHAPES if s in shapes]
    found = F.transform(
        F.array_distinct(F.concat(F.array().cast("array<string>"), *listed)),
        lambda p: _place(p))

    def opening(i: Column, first: Column) -> Column:
        rest = F.array(*[marked(i + 2 + k) for k in range(beyond)])
        return _place(F.concat(first, marked(i + 1)), rest)

    if _LONG in shapes:
        found = F.concat(found, F.transform(
            _after(), lambda i: opening(i - 1, word(i - 1))))
    if _MARKED in shapes:
        found = F.concat(found, F.transform(inner, lambda i: opening(i, marked(i))))
    return found.cast(f"array<{_PLACE}>")


def _small(nodes: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(nodes) if rows <= BROADCAST_NODES else nodes


def _spellings(ends: set[tuple[int, str]]) -> Column:
    """What a place may stand for, from ``node`` and ``rest``; ``ends``: levels and shapes of whole terms."""
    def from_opening(words: int) -> list[Column]:
        return [F.col("node"), *[F.get("rest", F.lit(i)) for i in range(words - 2)]]

    whole = [F.concat(*from_opening(level)) for level, shape in sorted(ends)
             if level > 2 and shape == _LONG]
    tails = [F.concat(*from_opening(level), _marks(F.get("rest", F.lit(level - 2))))
             for level, shape in sorted(ends) if shape == _TAIL]
    return F.array(F.col("node"), *whole, *tails)


def _reports_by_bits(
    keyed: DataFrame, trie: DataFrame, opening: DataFrame, rows: int, ends: dict[tuple[int, str], int],
) -> DataFrame:
    """(hash, ``report``) by one join of what may be a term with all terms."""
    opened = keyed.where(HashBits(opening, "node", rows).may_hold(F.col("node")))
    spelled = opened.select(*HASH, F.explode(_spellings(set(ends))).alias("node"))
    whole = trie.where(F.size("reports") > 0).select("node", "reports")
    found = meet(spelled, whole, "node", sum(ends.values()), BROADCAST_NODES)
    return found.select(*HASH, F.explode("reports").alias("report"))


def trie_reports(texts: DataFrame, trie: DataFrame) -> DataFrame:
    """(hash, ``reports``): distinct names reported by the terms that stand in a text.

    ``texts``: hash and ``text``, repeated or not. The number of levels is that of the longest term; a position
    that ends early stays as it is, under a key of its own.
    """
    trie = cut_lineage(trie)
    # one number for each shape and each level of the longest term
    counted = trie.groupBy("level", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.size("reports") > 0).alias("whole")).collect()
    sizes = {(r.level, r.shape): r.n for r in counted}
    depth = max((level for level, _ in sizes), default=0)
    tails = {level for level, shape in sizes if shape == _TAIL}
    cut = texts.select(*HASH, F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)).alias("w"),
                       _chunks(F.col("text")).alias("c"))
    shapes = {shape for _, shape in sizes}
    if shapes & {*_SHAPES[1:], _MARKED}:
        cut = _with_gaps(cut)
    keyed = cut.select(*HASH, F.inline(_places(shapes, max(depth - 2 + bool(tails), 0))))

    opening = trie.where((F.col("level") <= 2) & (F.col("shape") != _TAIL)).select(
        "node", F.col("reports").alias("found"))
    rows = sum(n for (level, shape), n in sizes.items() if level <= 2 and shape != _TAIL)
    if sum(sizes.values()) > BROADCAST_NODES:
        ends = {(r.level, r.shape): r.whole for r in counted if r.whole}
        return _reports_by_bits(keyed, trie, opening, rows, ends).groupBy(*HASH).agg(
            F.collect_set("report").alias("reports"))
    state = keyed.join(_small(opening, rows), "node").select(*HASH, "node", "found", "rest")
    # what does not go on gets a key that no node has and that differs between texts
    done = F.concat(F.lit("\x01"), F.col(HASH[0]).cast("string"))

    def meet(state: DataFrame, level: int, shape: str, key: Column) -> DataFrame:
        nodes = trie.where((F.col("level") == level) & (F.col("shape") == shape)).select(
            F.col("node").alias("key"), "reports")
        return state.withColumn("key", F.coalesce(key, done)).join(
            _small(nodes, sizes[level, shape]), "key", "left")

    more = F.concat("found", F.coalesce("reports", F.array().cast("array<string>")))
    for level in range(2, depth + 1):
        if level > 2:
            state = meet(state, level, _LONG, F.concat("node", F.get("rest", F.lit(level - 3))))
            state = state.select(
                *HASH, F.when(F.col("reports").isNotNull(), F.col("key")).alias("node"),
                more.alias("found"), "rest")
        if level in tails:
            beyond = _marks(F.get("rest", F.lit(level - 2)))
            state = meet(state, level, _TAIL, F.concat("node", beyond)).select(
                *HASH, "node", more.alias("found"), "rest")
    return state.select(*HASH, F.explode("found").alias("report")).groupBy(*HASH).agg(
        F.collect_set("report").alias("reports"))

"""Filter interaction audit by decision diagrams: what each filter removes in every order.

Five filters fail a text on these conditions: A under 100 words (maximal runs without ASCII
white space); B under 80 distinct words in 100; C over 10 letters A-Z in 100 code points; D any
of ``#$%&*|``; E a text that a row with a smaller doc_id holds too, removed or not.

Documents become failure masks, one bit a filter, and are counted by part and mask: all,
``quality`` = 1 and ``toxic`` = 1. Of each part's counts a decision diagram is built: one level a
filter, a passing and a failing branch at each node, counts as leaves, equal nodes shared, the
weight below on each node. All orders are visited so that each differs from the one before by
one swap of neighbours (Steinhaus-Johnson-Trotter), which changes the nodes of two levels only.
The path of passing branches from the root then gives an order's steps: the weight of the
failing branch is what the filter removes there.

Defined cases: a null text is an empty one; a null part is the empty string; for E a null id is
larger than all others and no smaller than another null, so that of texts which only rows
without id hold none fails; rows that share the smallest id of a text all pass; a document with
several labels has the largest of each; one without labels or id has none; an empty table has
no parts and gives an empty result; extra columns are not read.

Scale: one scan in Arrow batches that keeps an id, a 128-bit hash of the text and five bits.
Copies are folded by combinable aggregates, so that a text which a third of all rows hold is
one row for each id and then one row; labels are joined by id, rows without id beside that
join. What reaches one task is at most 2^5 counts a part, whatever the corpus; parts are
spread over tasks. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import arrow_rows, utf8, written

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80  # in 100 words
MAX_CAPITALS = 10  # in 100 code points
MARKS = b"#$%&*|"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_WEIGHTS = 3  # documents, good ones, toxic ones


def text_failures(data: bytes) -> int:
    """Bits of the filters that look at a text alone: A is bit 0, D is bit 3."""
    words = data.split()  # bytes.split knows ASCII white space only
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    length = len(data) if data.isascii() else len(data.decode())
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT * len(words)) << 1
            | (100 * capitals > MAX_CAPITALS * length) << 2
            | (len(data.translate(None, MARKS)) < len(data)) << 3)


def _scan(ids: list, parts: list, texts: list):
    digests = b"".join([xxhash.xxh3_128_digest(t) for t in texts])
    hashes = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)
    yield {"doc_id": ids, "part": parts, "h1": hashes[:, 0], "h2": hashes[:, 1],
           "mask": [text_failures(t) for t in texts]}


def failure_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
                   text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and failure mask."""
    spark = docs.sparkSession
    rows = arrow_rows(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                    F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                    utf8(text).alias("data")),
        _scan, "doc_id long, part string, h1 long, h2 long, mask int")
    # equal texts of one id are one row, with their number
    rows = written(spark, rows.groupBy("h1", "h2", "part", "mask", "doc_id").agg(
        F.count("*").alias("c")), "masks")
    one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality"), one("toxic"))
    flags = [F.coalesce(c, F.lit(0)).alias(c) for c in ("quality", "toxic")]
    kept = ["h1", "h2", "part", "mask", "doc_id", "c"]
    labelled = rows.where(F.col("doc_id").isNotNull()).join(known, "doc_id", "left").select(
        *kept, *flags).unionByName(rows.where(F.col("doc_id").isNull()).select(
            *kept, F.lit(0).alias("quality"), F.lit(0).alias("toxic")))
    # of each text: rows by part and labels, its smallest id and that id's rows
    texts = labelled.groupBy("h1", "h2", "part", "mask", "quality", "toxic").agg(
        F.sum("c").alias("n"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "c"))).alias("first"))
    texts = written(spark, texts, "texts")
    least = texts.groupBy(F.col("h1").alias("l1"), F.col("h2").alias("l2")).agg(
        F.min("first.doc_id").alias("least"))
    both = texts.join(least, (F.col("h1") == F.col("l1")) & (F.col("h2") == F.col("l2")))
    passing = F.when(F.col("least").isNull(), F.col("n")).otherwise(
        F.when(F.col("first.doc_id") == F.col("least"), F.col("first.c")).otherwise(0))
    split = both.select("part", "quality", "toxic", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), passing.alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - passing).alias("n")))))
    total = lambda c: F.sum(F.col("n") * F.col(c)).alias(c)
    return split.groupBy("part", "mask").agg(
        total("quality").alias("good"), total("toxic"), F.sum("n").alias("n")).select(
        "part", "mask", "n", "good", "toxic")


class Diagram:
    """Decision diagram over failure masks; nodes carry the counts below them."""

    def __init__(self, counts: dict[int, tuple[int, ...]], n_filters: int) -> None:
        self.order = list(range(n_filters))
        self.weight: list[tuple[int, ...]] = []
        self.branches: list[tuple[int, int] | None] = []  # node -> (passing, failing)
        self.known: list[dict] = [{} for _ in range(n_filters + 1)]  # of each level
        none = (0,) * _WEIGHTS
        nodes = [self._leaf(counts.get(mask, none)) for mask in range(1 << n_filters)]
        for level in range(n_filters - 1, -1, -1):  # the highest bit left is this level's
            half = len(nodes) // 2
            nodes = [self._node(level, nodes[i], nodes[i + half]) for i in range(half)]
        self.root = nodes[0]

    def _leaf(self, weight: tuple[int, ...]) -> int:
        return self._add(len(self.known) - 1, weight, weight, None)

    def _node(self, level: int, passing: int, failing: int) -> int:
        weight = tuple(a + b for a, b in zip(
            self.weight[passing], self.weight[failing], strict=True))
        return self._add(level, (passing, failing), weight, (passing, failing))

    def _add(self, level: int, key: tuple, weight: tuple, branches: tuple | None) -> int:
        if key not in self.known[level]:
            self.known[level][key] = len(self.weight)
            self.weight.append(weight)
            self.branches.append(branches)
        return self.known[level][key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one; other levels stay as they are."""
        upper = self.known[level]
        self.known[level], self.known[level + 1] = {}, {}
        for (passing, failing), node in upper.items():
            (pp, pf), (fp, ff) = self.branches[passing], self.branches[failing]
            # the node stays, so that nodes above it need no change
            key = self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)
            self.branches[node] = key
            self.known[level][key] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, kept, removed) along the path of texts that pass."""
        node = self.root
        for which in self.order:
            node, failing = self.branches[node]
            yield which, self.weight[node], self.weight[failing]


def neighbour_swaps(n: int) -> Iterator[int]:
    """Places whose swaps with the next place visit every order of ``n`` once."""
    order, ahead = list(range(n)), [-1] * n
    while True:
        for item in range(n - 1, -1, -1):  # the largest that can move over a smaller one
            at = order.index(item)
            to = at + ahead[item]
            if 0 <= to < n and order[to] < item:
                break
        else:
            return
        order[at], order[to] = order[to], order[at]
        for larger in range(item + 1, n):
            ahead[larger] = -ahead[larger]
        yield min(at, to)


def audit_rows(counts: dict[int, tuple[int, ...]], filters: str = FILTERS) -> dict[str, list]:
    """All steps of all orders for the counts (documents, good, toxic) of one part."""
    n = len(filters)
    diagram = Diagram(counts, n)
    fails = [sum(c[0] for mask, c in counts.items() if mask >> i & 1) for i in range(n)]
    alone = [counts.get(1 << i, (0,) * _WEIGHTS)[0] for i in range(n)]
    names = ("filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails",
             "good_lost", "toxic_lost")
    out: dict[str, list] = {name: [] for name in names}
    total = [0] * n

    def visit() -> None:
        order = "".join(filters[i] for i in diagram.order)
        for step, (i, kept, removed) in enumerate(diagram.steps(), 1):
            total[i] += removed[0]
            row = (order, step, i, kept[0], removed[0], fails[i] - removed[0], alone[i],
                   removed[1], removed[2])
            for name, value in zip(names, row, strict=True):
                out[name].append(value)

    visit()
    for place in neighbour_swaps(n):
        diagram.swap(place)
        visit()
    out["shapley"] = [total[i] for i in out["filter"]]
    out["filter"] = [filters[i] for i in out["filter"]]
    return out


RESULT = ("part string, filter_order string, step int, filter string, kept long, removed long, "
          "redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every step of every order, by part. ``counts``: as :func:`failure_counts` gives them.

    ``filters`` names the bits of the masks; k filters have k! orders.
    """
    def of_part(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        by_mask = {r["mask"]: (r["n"], r["good"], r["toxic"]) for r in table.to_pylist()}
        rows = audit_rows(by_mask, filters)
        columns = {"part": [part] * len(rows["step"])} | rows
        kinds = {"part": pa.string(), "filter_order": pa.string(), "step": pa.int32(),
                 "filter": pa.string()}
        return pa.table({n: pa.array(v, kinds.get(n, pa.int64())) for n, v in columns.items()})

    ordered = counts.select("part", "mask", "n", "good", "toxic")
    return ordered.groupBy("part").applyInArrow(of_part, RESULT).select(
        *[F.col(c) for c in _names(RESULT)])


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def filter_audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
                 text: str = "text", part: str = "lang") -> DataFrame:
    """The audit of the five filters over ``docs``."""
    return audit(failure_counts(docs, labels, doc_id, text, part))

"""Benchmark decontamination by winnowing, in DataFrame functions only.

A-Z become lower case; words are runs of digits, letters and characters beyond ASCII. A
window is ``WINDOW`` consecutive words of an item; an item with fewer words is one window.

Winnowing: of every ``w`` consecutive k-gram hashes the smallest is kept, ``w = L - k + 1``
for windows of ``L`` words, so a shared window always has the same kept hash on both sides.
Kept hashes of the documents are joined with those of the benchmark; where they meet, the hit
is extended from the k-gram to the window by its own hash. Words inside any matched window
count as hit. Both hashes are chains of 64-bit XXH64 over all words of their range.

Benchmark tables are small, yet their size is checked: up to ``BROADCAST_ROWS`` windows they
are broadcast, beyond that Spark joins by shuffle.

Defined cases: null and empty texts have no words; every row is a document, also where rows
have no id or share one, and each is judged by its own text; repeated items count by distinct
item_id, an item without id is searched but not listed; with an empty benchmark nothing is hit;
an empty table gives an empty result; extra columns are not read by ``hits`` and pass unchanged
through ``drop_contaminated``, whatever their names.

Scale: one scan of the corpus; with a broadcast benchmark only matched windows are shuffled.
Per document the matched starts are collected, never more than its words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import packed, row_key, unpacked, written

WINDOW = 10
GRAM = 4
BROADCAST_ROWS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    parts = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), _BETWEEN)
    return F.filter(parts, lambda w: w != "")


def _combined(df: DataFrame, new: str, a: str, b: str, shift: int,
              how: Callable[[Column, Column], Column]) -> DataFrame:
    """Array column ``new[i] = how(a[i], b[i + shift])``, as long as both exist."""
    n = F.greatest(F.least(F.size(a), F.size(b) - shift), F.lit(0))
    return df.withColumn(new, F.zip_with(
        F.slice(a, F.lit(1), n), F.slice(b, F.lit(shift + 1), n), how))


def _chained(df: DataFrame, length: int, base: str, kind: str,
             how: Callable[[Column, Column], Column]) -> tuple[DataFrame, str]:
    """Column that folds every ``length`` neighbours of ``base`` by doubling steps."""
    have = 1
    name = base
    powers = {1: base}
    while have * 2 <= length:
        new = f"_{kind}{have * 2}"
        if new not in df.columns:
            df = _combined(df, new, powers[have], powers[have], have, how)
        have *= 2
        powers[have] = name = new
    if kind.startswith("min") and have < length:  # ranges of a minimum may overlap
        new = f"_{kind}{length}"
        return (df if new in df.columns else
                _combined(df, new, name, name, length - have, how)), new
    done = have
    for size in sorted(powers, reverse=True):
        if size < have and done + size <= length:
            new = f"_{kind}{done + size}"
            if new not in df.columns:
                df = _combined(df, new, name, powers[size], done, how)
            done, name = done + size, new
    return df, name


def _windows(df: DataFrame, lengths: list[int]) -> tuple[DataFrame, Column]:
    """Arrays of (len, kept, whole) for every start of a window; ``_words`` must exist."""
    df = df.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    arrays = []
    for length in lengths:
        k = min(GRAM, length)
        df, gram = _chained(df, k, "_h", "gram", lambda a, b: F.xxhash64(a, b))
        df, kept = _chained(df, length - k + 1, gram, f"min{k}_", lambda a, b: F.least(a, b))
        df, whole = _chained(df, length, "_h", "gram", lambda a, b: F.xxhash64(a, b))
        arrays.append(_placed(kept, whole, length))
    return df, F.concat(*arrays)


def _placed(kept: str, whole: str, length: int) -> Column:
    both = F.zip_with(kept, whole, lambda m, g: F.struct(m.alias("kept"), g.alias("whole")))
    return F.transform(both, lambda x, i: F.struct(
        i.alias("start"), F.lit(length).alias("len"), x["kept"].alias("kept"),
        x["whole"].alias("whole")))


def _checked(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (sorted strings)."""
    key = ["_k1", "_k2"]  # of id and text: equal rows have the same hits
    texts = docs.select(
        *row_key(doc_id, text), F.col(doc_id).cast("long").alias("doc_id"),
        words(text).alias("_words"))
    rows, listed = _matched(texts, [*key, "doc_id"], benchmark, item_id, item_text)
    every = rows.where("len = 0").select(
        *key, "doc_id", F.col("start").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    if listed is None:
        return every.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"),
                            F.lit(0).cast("long").alias("n_items"), none.alias("items"))
    item_rows = rows.where("len > 0").select(*key, "len", "whole").distinct().join(
        _checked(listed), ["len", "whole"]).groupBy(*key).agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    matched = rows.where("len > 0").groupBy(*key).agg(
        F.array_sort(F.collect_set(F.struct("start", "len"))).alias("places"))
    covered = F.aggregate(
        "places", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["start"] + x["len"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), x["start"] + x["len"] - F.greatest(
                acc["end"], x["start"]))).alias("n")),
        lambda acc: acc["n"])
    hit = matched.select(*key, covered.alias("n_hit")).join(item_rows, key, "left")
    # one row for each text with a hit, as a table of its own: a text that many rows hold is split
    hit = written(docs.sparkSession, hit, "hit-texts")
    result = every.join(hit, key, "left").withColumns({
        "items": F.coalesce("items", none), "n_hit": F.coalesce("n_hit", F.lit(0).cast("long"))})
    return result.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items")


def _matched(texts: DataFrame, key: list[str], benchmark: DataFrame, item_id: str,
             item_text: str) -> tuple[DataFrame, DataFrame | None]:
    """Matched windows (key, start, len, whole) and, with len 0, the number of words as start;
    the benchmark's windows (len, whole, item), None if it has none. ``texts``: key, _words."""
    spark = texts.sparkSession
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), words(item_text).alias("_words"))
    items = items.withColumn("_len", F.least(F.size("_words"), F.lit(WINDOW))).where("_len > 0")
    items = written(spark, items, "items")
    lengths = sorted(r["_len"] for r in items.select("_len").distinct().collect())  # ten at most
    parts = []
    for length in lengths:
        df, array = _windows(items.where(F.col("_len") == length), [length])
        parts.append(df.select("item", F.inline(array)).drop("start"))
    nothing = F.struct(
        F.size("_words").alias("start"), F.lit(0).alias("len"), F.lit(None).cast("long").alias("kept"),
        F.lit(None).cast("long").alias("whole"))
    if not parts:
        rows = texts.select(*key, F.size("_words").alias("start"), F.lit(0).alias("len"))
        listed = None
    else:
        known = parts[0]
        for part in parts[1:]:
            known = known.unionByName(part)
        known = written(spark, known.distinct(), "windows")
        df, array = _windows(texts, lengths)
        # one more row per document carries its number of words
        found = df.select(*key, F.inline(F.concat(F.array(nothing), array)))
        kept = known.select("len", "kept").distinct().withColumn("_met", F.lit(True))
        found = found.join(_checked(kept), ["len", "kept"], "left").where("_met OR len = 0")
        whole = known.select("len", "whole").distinct().withColumn("_same", F.lit(True))
        found = found.join(_checked(whole), ["len", "whole"], "left").where("_same OR len = 0")
        rows = written(spark, found.select(*key, "start", "len", "whole"), "hits")
        listed = known.where("item IS NOT NULL").select("len", "whole", "item")
    return rows, listed


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """Documents without any benchmark window, each row judged by its own text."""
    texts = docs.select(*row_key(doc_id, text), words(text).alias("_words"))
    rows, _ = _matched(texts, ["_k1", "_k2"], benchmark, "item_id", "text")
    bad = written(docs.sparkSession, rows.where("len > 0").select("_k1", "_k2").distinct(),
                  "contaminated")
    rows = packed(docs, *row_key(doc_id, text))
    return unpacked(rows.join(bad, ["_k1", "_k2"], "left_anti"))

"""Which keys of a large dictionary occur in a text, as substrings: an index of trimmed keys.

A chain of tests reads every text once for each key. Here texts and keys are cut into words (runs
without white space).

A key of several words begins at the end of a word of the text, ends at the beginning of another
one, and what stands between is equal. So it is filed under its core: ``GRAM`` characters of
its first word at most, all between, and ``GRAM`` of its last one. Every run of as many words of a
text meets that index by an equi-join on its own cores, one for each pair of lengths that keys
have, and the key is looked for in the run only. The index has one row a key.

A key of one word is looked for in the distinct words of the texts, not in the texts. It is filed
under the one of its grams (of the longest of the sizes ``GRAMS`` that it has; the whole word, if it
is shorter) that the fewest other keys have, and the words of a text meet what was found by an
equi-join. White space counts as a word of its own for keys that are nothing else.

Where only the first key of a text counts (:func:`first_values`), keys have a rank. The first ``HEAD`` of
them are tried on the text itself, and texts that they decide go no further. A word then counts with its first
key only. Of a run of words, the ends of its first word that a key begins with and the beginnings of its
last word that a key ends with give whole keys, which no core is needed for. The kinds of keys follow
each other by their first ranks, and texts that an earlier key has decided are left out of the later kinds.

Scale: texts are neither shuffled nor copied, apart from those that the first keys leave undecided, which are
written once. Words and runs are made where the text is read, and hits, (hash of the text, key or
rank), are combined there before they are shuffled. Indexes are broadcast up to ``BROADCAST_KEYS``
counted rows; beyond, only what the bits of the index let through (:mod:`postloom.operators.hash_bits`) is
shuffled. Odd keys, of more than ``WINDOW`` words or with white space at an end, are looked for by cores, those of
more than ``WINDOW`` words by their first ones and then in the texts themselves. Nothing but numbers is
brought to the driver: counts, ranks, and the lengths of words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.regex import SPACE, strip
from postloom.operators.hash_bits import HashBits, meet
from postloom.session import cut_lineage, stored

HEAD, COMMON = 128, 1000
GRAM = 3
GRAMS = (3, 6, 12)
WINDOW = 6
BROADCAST_KEYS = 1_000_000
HASH = ["__h1", "__h2"]


def text_hash(text: Column) -> list[Column]:
    """128 bits that only equal texts share."""
    return [F.xxhash64(text).alias(HASH[0]), F.xxhash64(F.lit("second"), text).alias(HASH[1])]


def hashed_texts(df: DataFrame, *texts: Column) -> DataFrame:
    """(hash, ``text``) of every text of the given columns."""
    listed = df.select(F.explode(F.array(*texts)).alias("text")).where("text is not null")
    return listed.select(*text_hash(F.col("text")), "text")


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _words(text: Column) -> Column:
    return _found(text, f"[^{SPACE}]++")


def _spaces(text: Column) -> Column:
    return F.array_distinct(_found(text, f"[{SPACE}]++"))


def _runs(text: Column, size: int) -> Column:
    """Every run of ``size`` words (fewer at the end) with the white space on both sides."""
    start = rf"(?:\A|(?<=[^{SPACE}])(?=[{SPACE}]))"
    run = f"[{SPACE}]*+(?:[^{SPACE}]++[{SPACE}]*+){{1,{size}}}"
    return F.array_distinct(_found(text, f"{start}(?=({run}))", 1))


def _grams(text: Column, size: int) -> Column:
    """Every run of ``size`` characters; a zero-width match, so they may overlap."""
    return _found(text, f"(?s)(?=(.{{{size}}}))", 1)


def _all_grams(word: Column, sizes: list[int]) -> Column:
    return F.array_distinct(F.concat(F.array().cast("array<string>"), *[
        F.when(F.length(word) >= n, _grams(word, n)).otherwise(F.array().cast("array<string>"))
        for n in sizes]))


def _piece_grams(piece: Column) -> Column:
    grams = F.array(piece)
    for n in GRAMS:
        grams = F.when(F.length(piece) >= n, _grams(piece, n)).otherwise(grams)
    return F.array_distinct(grams)


def _holders(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """(piece, word): the words that hold a piece."""
    filed = pieces.select("piece", F.explode(_piece_grams(F.col("piece"))).alias("gram"))
    shared = filed.groupBy("gram").agg(F.count(F.lit(1)).alias("pieces"))
    # the few grams that very many pieces share do not meet them in one task
    common = F.broadcast(shared.where(F.col("pieces") >= COMMON))
    counted = filed.join(common, "gram").unionByName(
        filed.join(common, "gram", "left_anti").join(shared, "gram"))
    index = cut_lineage(counted.groupBy("piece").agg(
        F.min(F.struct("pieces", "gram")).alias("rarest")).select("rarest.gram", "piece"))
    # the few lengths that grams have, with their numbers of rows
    counts = index.groupBy(F.length("gram").alias("size")).agg(F.count(F.lit(1)).alias("rows")).collect()
    met = words.select("word", F.explode(_all_grams(
        F.col("word"), sorted(r["size"] for r in counts))).alias("gram"))
    return meet(met, index, "gram", sum(r["rows"] for r in counts), BROADCAST_KEYS).where(
        F.contains("word", "piece")).select("piece", "word")


def _listed_words(texts: DataFrame) -> DataFrame:
    return texts.select(*HASH, F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))


def _word_hits(texts: DataFrame, keys: DataFrame, edges: bool) -> DataFrame:
    """Keys of one word or none in the texts that hold them; ``edges``: some have white space at an end."""
    spaces = [_spaces(F.col("text"))] if edges else []
    listed = texts.select(F.explode(F.array_distinct(F.concat(
        _words(F.col("text")), *spaces))).alias("word"))
    words = cut_lineage(listed.distinct())
    filed = keys.withColumn("piece", F.coalesce(F.get(_words(F.col("key")), F.lit(0)), "key"))
    index = cut_lineage(_holders(words, filed.select("piece").distinct()).join(filed, "piece").drop("piece"))
    rows = index.count()
    if not edges:
        return meet(_listed_words(texts), index, "word", rows, BROADCAST_KEYS).drop("word")
    runs = texts.select(*HASH, F.explode(F.concat(
        _runs(F.col("text"), 1), _spaces(F.col("text")))).alias("run"))
    word = F.coalesce(F.get(_words(F.col("run")), F.lit(0)), "run")
    return meet(runs.withColumn("word", word), index, "word", rows, BROADCAST_KEYS).where(
        F.contains("run", "key")).drop("word", "run")


_CORE = (f"[^{SPACE}]{{1,{GRAM}}}[{SPACE}]++(?:[^{SPACE}]++[{SPACE}]++(?=[^{SPACE}]))*+"
         f"[^{SPACE}]{{1,{GRAM}}}")


def _with_core(df: DataFrame, text: str) -> DataFrame:
    """``core`` of a text of two words or more, and the lengths of its ends; '' for other texts."""
    cut = df.withColumn("core", F.regexp_extract(F.col(text), _CORE, 0))
    return cut.withColumns({
        "x": F.length(F.regexp_extract("core", rf"\A[^{SPACE}]++", 0)),
        "y": F.length(F.regexp_extract("core", rf"(?<=[{SPACE}])[^{SPACE}]++\z", 0))})


def _phrase_hits(texts: DataFrame, index: DataFrame, sizes: dict[int, set], rows: int) -> DataFrame:
    """Keys of two words or more (or the first ``WINDOW`` of them) in the texts that hold them.

    ``sizes``: number of words -> lengths of the ends of the cores.
    """
    parts = []
    for size, ends in sorted(sizes.items()):
        runs = texts.select(*HASH, F.explode(_runs(F.col("text"), size)).alias("run"))
        cores = _with_core(runs, "run").where("core <> ''")
        fitting = [
            F.when((F.col("x") >= x) & (F.col("y") >= y), F.substring(
                F.col("core"), F.col("x") - x + 1, F.length("core") - F.col("x") - F.col("y") + x + y))
            for x, y in sorted(ends)]
        parts.append(cores.select(*HASH, "run", F.explode(F.array(*fitting)).alias("core")).where(
            "core is not null"))
    met = meet(reduce(DataFrame.unionByName, parts), index, "core", rows, BROADCAST_KEYS)
    return met.where(F.contains("run", "probe")).drop("run", "core", "probe")


def key_hits(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(hash, columns of ``keys``) for every key that occurs in a text, once or more.

    ``texts``: hash and ``text``, as :func:`hashed_texts` gives them; ``keys``: ``key``, distinct and
    not empty, and columns that go with it.
    """
    first_words = f"^[{SPACE}]*+(?:[^{SPACE}]++[{SPACE}]*+){{0,{WINDOW}}}"
    filed = _with_core(keys.withColumn("n", F.size(_words(F.col("key")))).withColumn(
        "probe", F.when(F.col("n") > WINDOW, F.regexp_extract("key", first_words, 0)).otherwise(
            F.col("key"))), "probe")
    filed = cut_lineage(filed)
    edged = F.max((strip(F.col("key")) != F.col("key")).cast("int"))
    # a row for each number of words and each pair of lengths
    counts = filed.groupBy("n", "x", "y").agg(F.count(F.lit(1)).alias("rows"), edged.alias("edged")).collect()
    own = keys.columns
    parts = []
    if any(r.n < 2 for r in counts):
        parts.append(_word_hits(texts, filed.where("n < 2").select(*own), any(
            r.edged for r in counts if r.n < 2)).select(*HASH, *own))
    sizes: dict[int, set] = {}
    for r in counts:
        if r.n > 1:
            sizes.setdefault(min(r.n, WINDOW), set()).add((r.x, r.y))
    if sizes:
        found = _phrase_hits(
            texts, filed.where("n > 1").select("core", "probe", "n", *own), sizes,
            sum(r.rows for r in counts if r.n > 1))
        parts.append(found.where(F.col("n") <= WINDOW).select(*HASH, *own))
        if any(r.n > WINDOW for r in counts):
            parts.append(found.where(F.col("n") > WINDOW).drop("n").distinct().join(
                texts.distinct(), HASH).where(F.contains("text", "key")).select(*HASH, *own))
    if not parts:
        return texts.select(*HASH).limit(0).crossJoin(keys)
    return reduce(DataFrame.unionByName, parts)


def substring_keys(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(hash, ``key``), once each, for every key that occurs in a text; see :func:`key_hits`."""
    return key_hits(texts, keys.select("key")).distinct()


def _word_ranks(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(hash, ``rank``) of keys of one word, the first key that each word of a text holds."""
    listed = _listed_words(texts)
    held = _holders(listed.select("word").distinct(), keys.select(F.col("key").alias("piece")))
    first = cut_lineage(held.join(keys.withColumnRenamed("key", "piece"), "piece").groupBy("word").agg(
        F.min("rank").alias("rank")))
    return meet(listed, first, "word", first.count(), BROADCAST_KEYS).select(*HASH, "rank")


def _inner_runs(sizes: list[int]) -> Column:
    """All runs of words of the given numbers, from ``w``, the words of a text, and ``g``, the white space
    between them: first word, all between the first and the last, last word."""
    def runs(size: int) -> Column:
        def run(i: Column) -> Column:
            between = [F.get("g", i)]
            for k in range(1, size - 1):
                between += [F.get("w", i + k), F.get("g", i + k)]
            return F.struct(F.get("w", i).alias("first"), F.concat(*between).alias("between"),
                            F.get("w", i + (size - 1)).alias("last"))

        starts = F.when(F.size("w") >= size, F.sequence(F.lit(0), F.size("w") - size)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, run)

    return F.concat(*[runs(n) for n in sizes])


def _phrase_ranks(texts: DataFrame, keys: DataFrame, rows: int, sizes: list[int]) -> DataFrame:
    """(hash, ``rank``) of keys of two words or more, none of them with white space at an end."""
    ends = keys.select(F.get(_words(F.col("key")), F.lit(0)).alias("first"),
                       F.element_at(_words(F.col("key")), -1).alias("last"))
    longest = ends.agg(F.max(F.length("first")).alias("first"), F.max(F.length("last")).alias("last")).first()
    firsts, lasts = HashBits(ends, "first", rows), HashBits(ends, "last", rows)
    gaps = _found(F.col("text"), f"(?<=[^{SPACE}])[{SPACE}]++(?=[^{SPACE}])")
    cut = texts.select(*HASH, _words(F.col("text")).alias("w"), gaps.alias("g"))
    runs = cut.select(*HASH, F.inline(_inner_runs(sizes)))

    def lengths(word: str) -> Column:
        return F.sequence(F.lit(1), F.least(F.length(word), F.lit(longest[word])))

    opened = runs.select(*HASH, "between", "last", F.explode(F.transform(
        lengths("first"), lambda n: F.substring("first", F.length("first") - n + 1, n))).alias("end"))
    opened = opened.where(firsts.may_hold(F.col("end")))
    closed = opened.select(*HASH, "end", "between", F.explode(F.transform(
        lengths("last"), lambda n: F.substring("last", F.lit(1), n))).alias("beginning"))
    closed = closed.where(lasts.may_hold(F.col("beginning")))
    whole = closed.select(*HASH, F.concat("end", "between", "beginning").alias("key"))
    return meet(whole, keys.select("key", "rank"), "key", rows, BROADCAST_KEYS).select(*HASH, "rank")


def _first_ranks(hits: DataFrame) -> DataFrame:
    return hits.groupBy(*HASH).agg(F.min("rank").alias("rank"))


def _undecided(texts: DataFrame, found: list[DataFrame], rank: int) -> DataFrame:
    """``texts`` without most of those in which a key before ``rank`` was found."""
    decided = reduce(DataFrame.unionByName, found).where(F.col("rank") < rank).select(*HASH)
    rest = cut_lineage(texts.select(*HASH).distinct().join(decided, HASH, "left_anti").select(HASH[0]))
    return texts.where(HashBits(rest, HASH[0], rest.count()).may_hold(F.col(HASH[0])))


def _tried(texts: DataFrame, head: DataFrame) -> DataFrame:
    """(hash, ``rank``, ``text``): the first key of ``head`` in each text; no text where there is one."""
    listed = head.agg(F.array_sort(F.collect_list(F.struct("rank", "key"))).alias("head"))
    rank = F.aggregate("head", F.lit(None).cast("long"), lambda found, k: F.when(
        found.isNotNull(), found).when(F.contains(F.col("text"), k["key"]), k["rank"]))
    tried = texts.crossJoin(F.broadcast(listed)).select(*HASH, rank.alias("rank"), "text")
    return tried.select(*HASH, "rank", F.when(F.col("rank").isNull(), F.col("text")).alias("text"))


def _ranked(dictionary: DataFrame) -> DataFrame:
    """(``key``, ``value``, ``rank``, ``n``, ``kind``): the keys, each once, in the order in which they count."""
    listed = dictionary.where(F.coalesce("key", F.lit("")) != "").groupBy("key").agg(
        F.min(F.struct("priority", "value")).alias("entry")).select("key", "entry.*")
    listed = listed.withColumn("n", F.size(_words(F.col("key"))))
    odd = (strip(F.col("key")) != F.col("key")) | (F.col("n") > WINDOW)
    kind = F.when(odd, "odd").when(F.col("n") < 2, "word").otherwise("phrase")
    return cut_lineage(listed.orderBy("priority", "key").select(
        "key", "value", F.monotonically_increasing_id().alias("rank"), "n", kind.alias("kind")))


def _first_hits(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """(hash, ``rank``) of the first key of every text that holds one."""
    head = listed.select("rank").orderBy("rank").limit(HEAD).agg(
        F.max("rank").alias("last"), F.count(F.lit(1)).alias("n")).first()
    tried = _tried(texts, listed.where(F.col("rank") <= F.lit(head.last)))
    rest = listed.where(F.col("rank") > F.lit(head.last))
    counts = [] if head.n < HEAD else rest.groupBy("kind", "n").agg(
        F.count(F.lit(1)).alias("rows"), F.min("rank").alias("first")).collect()
    if counts:
        tried = stored(tried)
    found = [_first_ranks(tried.where("rank is not null").select(*HASH, "rank"))]
    texts = tried.where("rank is null").select(*HASH, "text")

    parts = []
    for kind in {r.kind for r in counts}:
        of_kind = [r for r in counts if r.kind == kind]
        rows, sizes = sum(r.rows for r in of_kind), sorted(r.n for r in of_kind)
        keys, first = rest.where(F.col("kind") == kind).select("key", "rank"), min(r["first"] for r in of_kind)
        if kind == "phrase" and 0 < BROADCAST_KEYS < rows:
            # those that can be broadcast come first and leave few texts to the others
            middle = keys.agg(F.percentile_approx("rank", 0.9 * BROADCAST_KEYS / rows)).first()[0]
            small = keys.where(F.col("rank") <= middle)
            of_small = small.count()
            parts.append((first, kind, small, of_small, sizes))
            first, keys, rows = middle + 1, keys.where(F.col("rank") > middle), rows - of_small
        parts.append((first, kind, keys, rows, sizes))
    for i, (first, kind, keys, rows, sizes) in enumerate(sorted(parts, key=lambda p: p[0])):
        left = _undecided(texts, found[1:], first) if i else texts
        if kind == "word":
            hits = _word_ranks(left, keys)
        elif kind == "phrase":
            hits = _phrase_ranks(left, keys, rows, sizes)
        else:
            hits = key_hits(left, keys).select(*HASH, "rank")
        found.append(cut_lineage(_first_ranks(hits)))
    return _first_ranks(reduce(DataFrame.unionByName, found))


def first_values(texts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(hash, ``value``) of the texts that hold a key: the value of the key that comes first.

    ``dictionary``: ``key``, ``value``, ``priority`` (the smallest comes first; ties go to the
    smaller key). Null and empty keys are left out; a key that is listed twice counts where it
    comes first.
    """
    listed = _ranked(dictionary)
    best = _first_hits(texts, listed)
    return best.join(listed.select("rank", "value"), "rank").drop("rank")


def with_first_values(df: DataFrame, dictionary: DataFrame, **texts: Column) -> DataFrame:
    """``df`` with a column for each text: the dictionary's first value in it, or NULL.

    All texts are looked up together; each column costs one join by hash, where a text that
    many rows share is one row on the other side. Only hashes of the texts go into the joins.
    """
    values = cut_lineage(first_values(hashed_texts(df, *texts.values()), dictionary))
    kept = [c for c in df.columns if c not in texts]
    hashes = {name: [f"{h}_{i}" for h in HASH] for i, name in enumerate(texts)}
    df = df.select(*[F.col(f"`{c}`") for c in kept], *[
        h.alias(to) for name, text in texts.items() for h, to in zip(text_hash(text), hashes[name])])
    for name, own in hashes.items():
        mine = values.select(*[F.col(h).alias(to) for h, to in zip(HASH, own)], F.col("value").alias(name))
        df = df.join(mine, own, "left").drop(*own)
    return df

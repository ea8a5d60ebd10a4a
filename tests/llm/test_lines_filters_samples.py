"""Line dedup, the filter audit and importance resampling against brute force and hard inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from postloom.llm import filter_audit, importance_sample, line_dedup

SPACE = " \t\n\x0b\x0c\r"


def az_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# --------------------------------------------------------------------------- lines
def brute_lines(rows, min_length=line_dedup.MIN_LENGTH, min_docs=line_dedup.MIN_DOCS):
    """(text, n_lines, n_dropped) of each row (doc_id, text)."""
    holders = defaultdict(list)
    cut = [(t or "").split("\n") for _, t in rows]
    key = lambda line: az_lower(line.strip(SPACE))
    for (doc_id, _), lines in zip(rows, cut, strict=True):
        for k in {key(line) for line in lines}:
            if len(k) >= min_length:
                holders[k].append(doc_id)
    out = []
    for (doc_id, text), lines in zip(rows, cut, strict=True):
        kept = []
        for line in lines:
            ids = holders.get(key(line), [])
            keeper = max((i for i in ids if i is not None), default=None)
            if len(ids) < min_docs or doc_id == keeper:
                kept.append(line)
        out.append((None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def line_rows(seed, n=120):
    rng = random.Random(seed)
    pool = [("Line %d " % i) + "é" * rng.randint(20, 40) + " tail" for i in range(25)]
    pool += ["x" * 40, "y" * 39, "é" * 39, "é" * 40, "", " ", "short"]
    rows = []
    for i in range(n):
        lines = [rng.choice(["", " ", "\t", "\r"]) + (p.upper() if rng.random() < .2 else p)
                 + rng.choice(["", "  ", "\x0b"]) for p in rng.choices(pool, k=rng.randint(0, 9))]
        rows.append((i, "\n".join(lines)))
    return rows


ODD_ROWS = [
    (None, "z" * 50), (None, "z" * 50), (None, "z" * 50), (None, "z" * 50), (None, "z" * 50),
    (900, None), (901, ""), (902, "\n\n"), (903, "q" * 60), (903, "q" * 60), (903, "Q" * 60 + "\nown"),
    (1, "q" * 60), (2, "a\n" + "q" * 60), (None, "q" * 60), (904, "w" * 300_000),
]


def test_lines_equal_brute_force(spark):
    rows = line_rows(3) + ODD_ROWS
    df = spark.createDataFrame(
        [(i, t, 1, "g", 7) for i, t in rows], "doc_id long, text string, _k1 int, _gone string, n_lines int")
    got = line_dedup.dedup_lines(df)
    assert sorted(got.columns) == sorted([*df.columns, "n_dropped"])
    found = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped, r._k1, r._gone) for r in got.collect())
    wanted = Counter((i, *b, 1, "g") for (i, _), b in zip(rows, brute_lines(rows), strict=True))
    assert found == wanted
    assert any(b[2] for b in brute_lines(rows))


def test_a_filter_that_is_full_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MIN_BITS", 64)
    rows = line_rows(5, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = line_dedup.dedup_lines(df, min_length=5, min_docs=3, max_bits=64)
    found = Counter((r.doc_id, r.text, r.n_dropped) for r in got.collect())
    wanted = brute_lines(rows, 5, 3)
    assert found == Counter((i, b[0], b[2]) for (i, _), b in zip(rows, wanted, strict=True))


def test_filters_hold_every_repeat_and_few_others(spark):
    own = [f"only document {i} has this line of its own, {i * 7919}" for i in range(4000)]
    shared = [f"line number {i} that two documents hold, not more" for i in range(50)]
    texts = [own[i] + ("\n" + shared[i % 50] if i < 100 else "") for i in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(9)
    bits = line_dedup.filter_bits(df, "text", 40, line_dedup.MAX_BITS)
    assert bits == line_dedup.MIN_BITS
    twice = line_dedup.seen_twice(df, bits, "text", 40)
    rows = line_dedup.suspects(df, bits, twice, "doc_id", "text", 40).collect()
    asked = Counter((r.h1, r.h2) for r in rows)
    assert sum(n == 2 for n in asked.values()) == 50
    assert len(asked) < 50 + 0.05 * len(own)


def test_no_documents_have_no_lines(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.dedup_lines(none).count() == 0


# ------------------------------------------------------------------------- filters
def fails_of(text):
    t = text or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
    return (len(w) < 100, 100 * len(set(w)) < 80 * len(w),
            100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t)))


def brute_audit(rows, labels):
    """All rows of the audit; ``rows``: (doc_id, text, lang)."""
    quality = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = defaultdict(list)
    for i, text, lang in rows:
        first = least.get(text or "")
        copy = first is not None and (i is None or i > first)
        parts[lang or ""].append((dict(zip("ABCDE", (*fails_of(text), copy), strict=True)),
                                  i in quality, i in toxic))
    out = set()
    for part, docs in parts.items():
        steps, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[f] += len(gone)
                steps.append(("".join(order), step, f, len(left), len(gone),
                              sum(d[0][f] for d in docs) - len(gone),
                              sum(d[0][f] and sum(d[0].values()) == 1 for d in docs),
                              sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out |= {(part, *s, shapley[s[2]]) for s in steps}
    return out


def audit_inputs(seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        n = rng.choice([0, 3, 99, 100, 101, 140])
        pool = [f"w{k}" for k in range(rng.choice([5, 79, 80, 81, 500]))]
        w = [rng.choice(pool) if rng.random() < .5 else f"u{k}" for k in range(n)]
        text = rng.choice([" ", "\n", "\t "]).join(w) + rng.choice(["", "", " #", " |x"])
        rows.append((i, text.upper() if rng.random() < .3 else text, rng.choice(["en", "de", None])))
    rows += [(200 + k, rows[k % 40][1], rng.choice(["en", "fr"])) for k in range(60)]
    rows += [(None, rows[0][1], "en"), (None, "no id", "xx"), (None, "no id", "xx"), (5, rows[5][1], "en"),
             (5, "another", "en"), (400, None, "en"), (401, "", None), (402, "É" * 9 + "AB", "en"),
             (403, "word " * 50_000, "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 420, 2)]
    return rows, labels + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]


def test_the_audit_equals_brute_force(spark):
    rows, labels = audit_inputs()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "doc_id long, text string, lang string, mask int, part int")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(df, known)
    names = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails",
             "good_lost", "toxic_lost", "shapley"]
    assert got.columns == names
    found = got.collect()
    assert len(found) == 600 * len({r[2] or "" for r in rows})
    merged = {}
    for i, q, t in labels:
        old = merged.get(i, (0, 0))
        merged[i] = max(old[0], q or 0), max(old[1], t or 0)
    assert {tuple(r) for r in found} == brute_audit(
        rows, [(i, q, t) for i, (q, t) in merged.items() if i is not None])


def test_neighbour_swaps_visit_every_order_once():
    for n in range(1, 6):
        order, seen = list(range(n)), {tuple(range(n))}
        for place in filter_audit.neighbour_swaps(n):
            order[place], order[place + 1] = order[place + 1], order[place]
            seen.add(tuple(order))
        assert len(seen) == math.factorial(n)


def test_a_swap_keeps_the_function_of_a_diagram():
    rng = np.random.default_rng(4)
    counts = {int(m): tuple(int(x) for x in rng.integers(0, 3, 3)) for m in rng.integers(0, 32, 12)}
    diagram = filter_audit.Diagram(counts, 5)
    for place in rng.integers(0, 4, 200):
        diagram.swap(int(place))
        for mask in range(32):
            node = diagram.root
            for which in diagram.order:
                node = diagram.branches[node][mask >> which & 1]
            assert diagram.weight[node] == counts.get(mask, (0, 0, 0))


def test_no_documents_have_no_audit(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(none, labels).count() == 0
    one = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    assert filter_audit.filter_audit(one, labels).where("part = ''").count() == 600


# ------------------------------------------------------------------------- samples
def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", az_lower(text or ""))


def brute_sample(rows, target, max_n, percent=10, min_words=20):
    def buckets(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10_000
                for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(b for x in texts for b in buckets(x)) for texts in ([r[1] for r in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        found = buckets(text)
        weight = sum(math.floor(1000 * math.log(
            (t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2 ** 32)))
        out.append([i, len(words(text)), len(found), weight, score, None])
    able = sorted((r for r in out if r[1] >= min_words),
                  key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[3], -r[2]))
    for rank, r in enumerate(able[:len(able) * percent // 100], 1):
        r[5] = rank
    return Counter(map(tuple, out))


def sample_inputs(seed=6):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "漢字", "a-b"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(130)]
    rows += [(None, "x " * 30), (None, None), (200, ""), (201, "long " * 60_000), (3, rows[3][1]),
             (3, "another text of this id " * 6), (202, "a b " * 10), (203, "A,b" * 10)]
    return rows, [" ".join(rng.choices(vocabulary[:20], k=30)) for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("max_n,head", [(1, 32_768), (1, 3), (2, 5), (3, 32_768)])
def test_samples_equal_brute_force(spark, monkeypatch, max_n, head):
    monkeypatch.setattr(importance_sample, "HEAD", head)
    rows, target = sample_inputs()
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows],
                               "doc_id long, text string, rank int, part int").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance_sample.resample(df, wanted, max_n=max_n, percent=30)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == brute_sample(rows, target, max_n, 30)


def test_summaries_hold_every_frequent_word():
    rng = random.Random(1)
    stream = ["often"] * 300 + ["second"] * 150 + [f"r{i}" for i in range(2000)]
    rng.shuffle(stream)
    counts = Counter()
    for word in stream:
        counts[word] += 1
        counts = importance_sample._trimmed(counts, 20)
    assert len(counts) <= 20 and {"often", "second"} <= set(counts)
    assert 300 - len(stream) / 21 <= counts["often"] <= 300


def test_empty_samples(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 20), (2, None)], "doc_id long, text string")
    assert importance_sample.resample(none, some).count() == 0
    rows = importance_sample.resample(some, none, percent=100).orderBy("doc_id").collect()
    assert [(r.n_features, r.rank) for r in rows] == [(40, 1), (0, None)]

"""The operators against brute force, round trips and hard inputs."""

import hashlib
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from postloom.llm import (
    bpe, chat_format, decontaminate, license_scan, quality_crf, simhash, substring_dedup,
    token_counts, topk, toxicity,
)
from postloom.llm.queries import COUNT_TOKENIZER, WORD_TOKENIZER

DOCS = "doc_id long, text string, n_words string, run string, block string"
ODD = ["", None, " ", "\n\n", "a", "Éa É <|endoftext|> b", "tab\there  two  spaces \n x", "x" * 5000,
       "it's I'LL 12 ½ 漢字 😀 \x1c y", "<|startoftext|>Σας ΟΔΟΣ İ"]


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame(
        [(i, t, "n", "r", "b") for i, t in zip(ids, texts, strict=True)], DOCS)


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


# ---------------------------------------------------------------- substring dedup
PASSAGE = ("Alpha beta gamma delta epsilon zeta eta theta. Iota kappa lambda mu nu xi omicron pi. "
           "Rho sigma tau upsilon phi chi psi omega again. One two three four five six seven.")


def test_repeats_are_removed_but_for_the_first(spark):
    own = "This text of document {0} stands only here {0}. Nobody else has {0} words like it. "
    texts = [own.format(i) * 1 + (PASSAGE if i in (1, 3, 4) else "Fine.") for i in range(5)]
    rows = {r.doc_id: r for r in substring_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert PASSAGE in rows[1].text
    assert [rows[i].text for i in (0, 2)] == [texts[0], texts[2]]
    for i in (3, 4):
        assert "Alpha" not in rows[i].text and "six" not in rows[i].text
        assert own.format(i).strip() in rows[i].text
        assert rows[i].n_removed == 4


def test_one_long_sentence_is_caught(spark):
    long = " ".join(f"w{i}" for i in range(55))
    texts = [f"First own words.\n{long}\nend a", f"Other words here.\n{long}\nend b"]
    rows = {r.doc_id: r.text for r in substring_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert long in rows[0]
    assert "w0 " not in rows[1] and "w54" not in rows[1] and "Other words here." in rows[1]


def test_substring_dedup_equals_brute_force(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(2, 6)))
            + rng.choice([". ", "! ", "\n"]) for _ in range(12)]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(40)]
    first = {}
    for i, text in enumerate(texts):
        for h, _ in substring_dedup.run_hashes(substring_dedup.sentences(text.encode())):
            first.setdefault(h, i)
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        parts = substring_dedup.sentences(text.encode())
        assert b"".join(parts) == text.encode()
        gone, seen = set(), set()
        for k, (h, end) in enumerate(substring_dedup.run_hashes(parts)):
            if first[h] != i or h in seen:
                gone |= set(range(k, end))
            seen.add(h)
        assert got[i] == b"".join(p for k, p in enumerate(parts) if k not in gone).decode()


def test_no_passage_of_51_words_is_left_at_any_offset(spark):
    rng = random.Random(12)

    def own(n, mark):
        return [f"{mark}{rng.randrange(10**6)}" for _ in range(n)]

    texts, passages = [], []
    for shape in range(30):
        passage = own(51 + shape, "p")
        if shape % 3 == 0:  # one-word sentences
            passage = [w + rng.choice(".!") for w in passage]
        passages.append(passage)
        for copy in range(2):  # inside a sentence, at other offsets
            texts.append(" ".join(own(rng.randrange(60), "a") + passage + own(rng.randrange(60), "z")))
    rows = {r.doc_id: r for r in substring_dedup.remove_repeats(frame(spark, texts)).collect()}
    for i, passage in enumerate(passages):
        assert rows[2 * i].text == texts[2 * i]
        left = rows[2 * i + 1].text.split()
        assert sum(w in set(passage) for w in left) < 2 * substring_dedup.SPREAD
        assert [w for w in left if w[0] != "p"] == [
            w for w in texts[2 * i + 1].split() if w[0] != "p"]
        assert 0 < rows[2 * i + 1].n_removed < rows[2 * i + 1].n_sentences
    inside = " ".join(passages[1] + own(7, "m") + passages[1])
    assert substring_dedup.cut_runs(inside.encode(), set())[0].decode().split() == (
        inside.split()[:len(passages[1]) + 7])


# ------------------------------------------------------------------ token counts
def test_token_counts_equal_the_library(spark):
    rng = random.Random(1)
    parts = ["the", " ", "  ", "\n", "Bé", "1", "½", ".", "'s", "\t", "\xa0", "漢", "\x1d", "\x85",
             "<|endoftext|>", "thntble"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(200)]
    texts += ["word unlikelyword " * 400]
    library = Tokenizer.from_file(COUNT_TOKENIZER)
    rows = {r.doc_id: r for r in token_counts.token_counts(
        frame(spark, texts), COUNT_TOKENIZER).collect()}
    for i, text in enumerate(texts):
        wanted = library.encode(text or "", add_special_tokens=False)
        assert (rows[i].n_tokens, rows[i].n_bytes) == (len(wanted.ids), len((text or "").encode()))


def test_a_common_pre_token_is_salted(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SHARED", 2)
    texts = ["unlikelyword zz"] * 50
    rows = token_counts.token_counts(frame(spark, texts), COUNT_TOKENIZER).collect()
    n = len(Tokenizer.from_file(COUNT_TOKENIZER).encode(texts[0]).ids)
    assert [r.n_tokens for r in rows] == [n] * 50


# --------------------------------------------------------------------------- bpe
def test_bpe_equals_the_library(spark):
    rng = random.Random(2)
    texts = ODD + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x20, 0x250),
                                           rng.randrange(0x370, 0x3ff), rng.randrange(0x4e00, 0x9fa5)]))
                           for _ in range(rng.randrange(40))) for _ in range(300)]
    library = Tokenizer.from_file(WORD_TOKENIZER)
    rows = {r.doc_id: r for r in bpe.encode_texts(frame(spark, texts), WORD_TOKENIZER).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == ids
        assert rows[i].decoded == shown
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_bpe_when_tables_of_known_words_turn_over(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    rng = random.Random(4)
    library, ours = Tokenizer.from_file(WORD_TOKENIZER), bpe.WordBpe(WORD_TOKENIZER)
    known = ["the", "aaaa", "éçé", "antionstionan", "x" * 65, "abab" * 500, "1", "...", "漢字漢字"]
    for _ in range(200):
        text = " ".join(rng.choice(known) + "".join(rng.choices("abné", k=rng.randrange(4)))
                        for _ in range(rng.randrange(12)))
        packed, decoded = ours.encode(text)
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert decoded == library.decode(ids, skip_special_tokens=False)
        assert len(ours.recent) <= 5 and len(ours.earlier) <= 5
        assert all(len(w) <= bpe.REMEMBERED_LENGTH for w in ours.recent)


# ----------------------------------------------------------------------- simhash
def brute_fingerprint(text):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(parts[i:i + 3]) for i in range(max(1, len(parts) - 2))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) > 0)


def brute_components(fps):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("bucket", [64, 1])
def test_simhash_equals_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 6))) for _ in range(80)]
    texts += ODD + [texts[5]] * 20
    base = " ".join(f"w{i}" for i in range(300))
    texts += [base, base + " x", base.replace("w7 ", "v7 "), base.upper()]
    rows = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    assert [rows[i].fp % 2**64 for i in range(len(texts))] == fps
    assert [rows[i].component_id for i in range(len(texts))] == brute_components(fps)


def test_long_chains_of_links_are_one_component(spark):
    value, chain = 0, [0]
    for b in range(40):
        value |= 1 << b
        chain.append(value)
    fps = spark.createDataFrame([(simhash._signed(v),) for v in chain], "fp long")
    found = simhash.components(simhash.links(fps)).collect()
    assert len(found) == 40 and {r.b for r in found} == {0}


def test_keep_one_handles_repeated_and_missing_ids(spark):
    docs = frame(spark, ["a b c d", "a b c d", "x y z q", "x y z q", "only here now"],
                 [1, 2, 3, 3, None])
    kept = simhash.keep_one(docs).collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept) == [
        (-1, "only here now"), (1, "a b c d"), (3, "x y z q")]
    assert simhash.keep_one(docs).columns == docs.columns


def test_keep_one_keeps_a_row_of_each_component(spark):
    texts = ["null one two three", "null four five six", "null four five six", "seven eight nine ten",
             "shared id first text", "shared id second words", "of an id too", "of an id too"]
    docs = frame(spark, texts, [None, None, None, None, 7, 7, 8, None])
    kept = sorted((r.doc_id or -1, r.text) for r in simhash.keep_one(docs).collect())
    assert kept == sorted([(-1, texts[0]), (-1, texts[1]), (-1, texts[3]), (7, texts[4]),
                           (7, texts[5]), (8, texts[6])])


def test_the_pipeline_keeps_one_of_each_simhash_group(spark):
    import corpus_pipeline

    rng = random.Random(8)
    texts = [None, "", "a b", "A  b"]
    for _ in range(30):
        base = [f"w{rng.randrange(40)}" for _ in range(rng.randint(60, 400))]
        texts += [" ".join(base), " ".join([*base[:-1], "other"]), " ".join(base).upper()]
    groups = brute_components([brute_fingerprint(t) for t in texts])
    kept = corpus_pipeline.simhash_near_dedup(spark, frame(spark, texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups))


def test_keep_one_passes_columns_of_any_name(spark):
    rows = [(1, "a b c d", 1, 2, 3, 4), (1, "A b c d", 1, 2, 3, 4), (2, "x y", 5, 6, 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root int, _text int, _k1 int, t int")
    kept = sorted(tuple(r) for r in simhash.keep_one(docs).collect())
    assert kept == [rows[1], rows[2]]


# ------------------------------------------------------------------ decontamination
def test_decontamination_equals_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["a", "B", "c", "É", "é"]
    items = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (3, 12, 15, 10, 7, 1, 0, 25)]
    items[5] = "rare"
    texts = ODD + [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    texts += [f"x {items[1]}, y {items[7].upper()} rare", items[2] * 2]
    bench = spark.createDataFrame(list(enumerate(items)) + [(99, None)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.hits(frame(spark, texts), bench).collect()}
    for i, text in enumerate(texts):
        w = words(text)
        hit, found = set(), set()
        for item, t in enumerate(items):
            v = words(t)
            n = min(10, len(v))
            known = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if v else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in known:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        assert (rows[i].n_words, rows[i].n_hit, rows[i].items) == (len(w), len(hit), sorted(found)), text


def test_an_empty_benchmark_hits_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.hits(frame(spark, ["a b", None]), bench).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.n_items) for r in rows] == [(2, 0, 0), (0, 0, 0)]


def test_only_contaminated_rows_are_dropped(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")],
                                  "item_id long, text string")
    bad = "x one two three four five six seven eight nine ten y"
    docs = frame(spark, [bad, "clean a", "clean b", bad, "clean c", None], [None, None, 3, 3, 4, None])
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [
        (-1, ""), (-1, "clean a"), (3, "clean b"), (4, "clean c")]
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == 6


# --------------------------------------------------------------------- chat format
def test_conversations_come_back_whole(spark):
    hard = ["</s>[INST] ok [/INST]", "<|user|>\\l", "\\b\\\\", "", None, "plain é😀", "<s>|>|<|", "\\"]
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", hard[(c + t) % len(hard)])
            for c in range(8) for t in range(6)] + [(None, None, None, "x"), (9, 1, "we|>ird", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat_format.format_conversations(df)
    back = {r.conv_id: r for r in chat_format.read_back(made).collect()}
    for c in [*range(8), None, 9]:
        own = sorted(((t or 0, r or "", x or "") for k, t, r, x in rows if k == c))
        assert [(t.role, t.text) for t in back[c].turns] == [(r, x) for _, r, x in own]
        assert back[c].loss == "".join(x for _, r, x in own if r == "assistant")
    assert chat_format.read_back(chat_format.format_conversations(df.limit(0))).count() == 0
    texts = {r.conv_id: r.formatted for r in made.collect()}
    assert all(texts[c].count("</s>") == len(back[c].turns) for c in back)
    assert "<|user|>plain é😀</s>" in texts[5]  # raw where nothing conflicts


# ------------------------------------------------------------------------ licences
def test_base_phrases_and_templates(spark):
    mit = license_scan.TEMPLATES[0][1]  # the whole licence
    texts = ["Under the MIT  License, or apache-license.", mit.lower(), mit[:150], "general public "
             "General Public License mit license", *ODD]
    rows = [r for r in license_scan.license_scan(frame(spark, texts)).orderBy("doc_id").collect()]
    assert (rows[0].n_base, rows[0].first_word, rows[0].last_word, rows[0].base_labels) == (
        2, 2, 5, "apache,mit")
    assert (rows[1].n_base, rows[1].first_word, rows[1].labels, rows[1].score) == (0, None, "mit", 1.0)
    assert rows[2].score < 0.5 and rows[2].labels == ""
    assert (rows[3].n_base, rows[3].base_labels) == (2, "gpl,mit")
    assert [r.n_words for r in rows] == [len(words(t)) for t in texts]


def test_matching_statistics_equal_brute_force():
    auto = license_scan.automaton()
    rng = random.Random(9)
    vocabulary = sorted(auto.vocabulary)[:15] + [b"zzz"]
    sources = [w for t in auto.words for w in [t]]
    for _ in range(60):
        text = []
        while len(text) < 40:
            t = rng.choice(sources)
            a = rng.randrange(len(t))
            text += t[a:a + rng.randint(1, 8)] + rng.sample(vocabulary, rng.randint(0, 2))
        longest = []
        for i in range(len(text)):
            n = 0
            while n <= i and any(text[i - n:i + 1] == t[k:k + n + 1] for t in sources
                                 for k in range(len(t) - n)):
                n += 1
            longest.append(n)
        wanted = [(i - n + 1, n) for i, n in enumerate(longest) if n >= license_scan.MIN_MATCH
                  and (i + 1 == len(text) or longest[i + 1] != n + 1)]
        found = auto.matches(text)
        assert [(s, n) for s, n, _ in found] == wanted
        for s, n, state in found:
            assert all(sources[t][e - n:e] == text[s:s + n] for t, e in auto.ends[state])


# --------------------------------------------------------------------- classifiers
def classified(good, bad, n=90, seed=5):
    rng = random.Random(seed)
    return [(make(rng), label) for label, make in ((1, good), (0, bad)) for _ in range(n)]


def prose(rng):
    return "\n".join(" ".join(rng.choice(["the", "river", "stone", "walks", "over"])
                              for _ in range(rng.randint(5, 12))) + "." for _ in range(4)).encode()


def test_quality_learns_line_patterns():
    def junk(rng):
        return "\n".join(" | ".join(rng.choice(["menu", "home", "LOGIN"]) for _ in range(9))
                         for _ in range(4)).encode()

    model = quality_crf.train(classified(prose, junk))
    test = classified(prose, junk, 20, 8)
    assert np.mean([(model.score(t) >= 0.5) == (k == 1) for t, k in test]) > 0.95
    assert 0 <= model.score(b"") <= 1 and 0 <= model.score(b"x" * 100_000) <= 1
    assert quality_crf.train([(b"a", 1)] * 9) is None


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    model = quality_crf.train(classified(prose, lambda r: b"A | B\nC | D", 30))
    model.steps = rng.normal(size=(2, 2))
    rows = quality_crf.measures(b"one line.\nTWO LINES!!\nx | y\nend")[0]
    scores = model.weights[model.features(rows)].sum(axis=1)
    weight = {}
    for code in range(2 ** len(rows)):
        path = [code >> i & 1 for i in range(len(rows))]
        weight[tuple(path)] = np.exp(sum(scores[i][s] for i, s in enumerate(path)) + sum(
            model.steps[a][b] for a, b in zip(path, path[1:], strict=False)))
    total = sum(weight.values())
    wanted = [sum(w for p, w in weight.items() if p[i]) / total for i in range(len(rows))]
    assert np.allclose(model.marginals(rows), wanted)


def test_toxicity_separates_and_ignores_nulls(spark):
    def toxic(rng):
        return prose(rng) + rng.choice([b" you idiotic", b" nastyword", b" vileness"])

    model = toxicity.train(classified(toxic, prose, 120))
    test = classified(toxic, prose, 30, 11)
    assert np.mean([(model.score(t) >= toxicity.CUT) == (k == 1) for t, k in test]) > 0.95
    rows = toxicity.toxicity(frame(spark, ODD), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity.toxicity(frame(spark, ODD), None).collect()} == {0.0}


def test_folds_follow_crc32(spark):
    from postloom.llm.common import bucket_of

    rows = spark.range(50).select("id", bucket_of("id", 4).alias("b")).collect()
    assert all(r.b == zlib.crc32(str(r.id).encode()) % 4 for r in rows)


# --------------------------------------------------------------------------- top-k
@pytest.mark.parametrize("block", [4096, 7])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(160, 6)) * rng.choice([0.01, 1, 1, 30], size=(160, 1)), 2)
    x[20:60] = x[20]
    vectors = [(i, [float(v) for v in row], "b") for i, row in enumerate(x)]
    vectors += [(500, None, "b"), (501, [1.0, None] * 3, "b"), (502, [float("nan")] * 6, "b"),
                (503, [1.0], "b"), (None, [0.5] * 6, "b"), (600, [0.0] * 6, "b"), (700, [], "b")]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, block string")
    got = {}
    for r in topk.top_k(df, every=20, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    usable = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v, _ in vectors
              if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    for i, q in usable:
        if i is None or i % 20:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j is None, j or 0, j)
                        for j, v in usable if j != i and len(v) == len(q))
        assert got.get(i, []) == [(j, -s) for s, _, _, j in scored[:5]], i


def test_empty_tables(spark):
    none = frame(spark, [])
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for result in (
            substring_dedup.remove_repeats(none), token_counts.token_counts(none, COUNT_TOKENIZER),
            toxicity.toxicity(none, None), decontaminate.hits(none, bench),
            license_scan.license_scan(none), quality_crf.quality(none, None),
            quality_crf.keep_good(none, None), bpe.encode_texts(none, WORD_TOKENIZER),
            simhash.near_duplicates(none), topk.top_k(vectors, 50)):
        assert result.count() == 0


def test_settled_characters_are_prepared_like_the_library():
    library = Tokenizer.from_file(WORD_TOKENIZER)
    unsettled = bpe.tokenizer(WORD_TOKENIZER).unsettled
    for code in range(0x21, 0x250):
        text = f"a{chr(code)}b"
        if not unsettled.search(text) and not chr(code).isspace():
            assert unicodedata.normalize("NFC", text).lower() == library.normalizer.normalize_str(text)


# ------------------------------------------------------------- rows, ids and names
CLASHES = "doc_id long, text string, _owner string, _gone int, _k1 int, _k2 int, row string, n_removed int"


def test_each_row_without_an_id_of_its_own_is_a_document(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, "rare")],
                                  "item_id long, text string")
    bad = "x one two three four five six seven eight nine ten y"
    rows = [(None, bad), (None, "clean a"), (3, "b"), (3, bad + " longer rare"), (3, "b"), (4, None)]
    docs = spark.createDataFrame([(i, t, "o", 1, 2, 3, "r", 9) for i, t in rows], CLASHES)
    found = decontaminate.hits(docs, bench).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.n_hit, r.items) for r in found) == [
        (-1, 2, 0, []), (-1, 12, 10, ["1"]), (3, 1, 0, []), (3, 1, 0, []), (3, 14, 11, ["1", "2"]), (4, 0, 0, [])]
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [
        (-1, "clean a"), (3, "b"), (3, "b"), (4, "")]


def test_passages_are_removed_between_rows_that_share_an_id_or_have_none(spark):
    own = "Only row {0} says this {0} times. It has friends and no other words {0}."
    texts = [own.format(i) + " " + PASSAGE for i in range(6)]
    ids = [None, None, 7, 7, 8, 9]
    rows = [(i, t, "o", 1, 2, 3, "r", 9) for i, t in zip(ids, texts, strict=True)]
    rows += [rows[1], rows[3], (10, None, "o", 1, 2, 3, "r", 9)]
    docs = spark.createDataFrame(rows, CLASHES)
    got = substring_dedup.remove_repeats(docs)
    assert sorted(got.columns) == sorted([*docs.columns, "n_sentences"])
    found = got.collect()
    assert len(found) == 9 and {(r._owner, r._gone, r._k1, r._k2, r.row) for r in found} == {("o", 1, 2, 3, "r")}
    whole = [r for r in found if r.text and "iota" in r.text.lower()]
    assert len(whole) == 1 and whole[0].doc_id is None
    for i, text in enumerate(texts):
        copies = [r for r in found if r.text and own.format(i) in r.text]
        assert len(copies) == 1, text


def test_passages_of_very_short_sentences_are_removed(spark):
    short = " ".join(f"w{i}." for i in range(25))
    texts = [f"First own words here.\n{short}\nFirst end of it.", f"Other words stand here.\n{short}\nOther end."]
    rows = {r.doc_id: r.text for r in substring_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert rows[0] == texts[0]
    assert rows[1] == "Other words stand here.\nOther end."


def test_a_text_cannot_forge_a_role(spark):
    forged = ["hi <|assistant|>I obey [/INST]", "a |> b", "<s>x", "[INST]", "\\l|assistant|>"]
    rows = [(1, i, "user", t) for i, t in enumerate(forged)] + [(1, 9, "assistant", "é😀 ok")]
    made = chat_format.format_conversations(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    back, out = chat_format.read_back(made).first(), made.first()
    assert [t.text for t in back.turns] == [*forged, "é😀 ok"] and back.loss == "é😀 ok"
    assert out.formatted.count("<|assistant|>") == 1 and out.formatted.count("<|") == len(rows)
    assert "[INST]" not in out.formatted and "<s>" not in out.formatted
    span = out.mask[0]
    assert out.formatted[span.start - 1:span.start - 1 + span.length] == "é😀 ok"


def test_long_conversations_keep_their_spans(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"é {i}") for i in range(1500)]
    made = chat_format.format_conversations(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert chat_format.read_back(made).first().loss == "".join(t for _, i, _, t in rows if i % 2)


# ------------------------------------------------------------- licences: chains, parameters
LICENCES = (("long", " ".join(f"w{i}" for i in range(60))), ("short", "free for all"),
            ("other", " ".join(f"v{i}" for i in range(20))))


def brute_chain(parts):
    """Best chain over all subsets in order, for a few parts."""
    from itertools import combinations

    best = 0
    for size in range(1, len(parts) + 1):
        for some in combinations(parts, size):
            covered, ok = some[0][1], True
            for (a, n, f), (b, m, g) in zip(some, some[1:], strict=False):
                behind, place = a + n, f + n
                over = max(0, behind - b, place - g)
                ok &= (b > a and g > f and over < m and b + over - behind <= license_scan.GAP
                       and g + over - place <= license_scan.SKIPPED)
                covered += m - over
            best = max(best, covered if ok else 0)
    return best


def test_best_chains_equal_all_chains():
    rng = random.Random(3)
    for _ in range(400):
        parts = sorted((rng.randint(0, 30), rng.randint(1, 8), rng.randint(0, 30))
                       for _ in range(rng.randint(1, 6)))
        assert license_scan.best_chain(parts) == brute_chain(parts), parts


def test_edited_and_disordered_copies_of_templates_that_are_passed(spark):
    w = [f"w{i}" for i in range(60)]
    texts = {
        "edited": " ".join([*w[:20], "changed", *w[21:40], "here and there", *w[40:]]),
        "cut": " ".join([*w[:15], *w[30:]]),
        "disordered": " ".join([*w[30:], *w[:30]]),
        "twice": " ".join([*w[:25], *w[20:60]]),
        "little": " ".join(w[:20]),
        "whole short": "it is Free, for-all of us", "part short": "free for nobody", "none": "nothing",
    }
    docs = frame(spark, list(texts.values()))
    rows = license_scan.license_scan(docs, templates=LICENCES, phrases={"free for": "base"}).orderBy("doc_id")
    got = dict(zip(texts, rows.collect(), strict=True))
    assert {n: r.labels for n, r in got.items()} == {
        "edited": "long", "cut": "long", "disordered": "long", "twice": "long", "little": "",
        "whole short": "base,short", "part short": "base", "none": ""}
    assert got["edited"].score == pytest.approx(59 / 60) and got["twice"].score == 1.0
    assert got["disordered"].score == 0.5 and got["cut"].score == 0.75
    assert got["little"].score == pytest.approx(1 / 3) and got["whole short"].score == 1.0
    assert (got["whole short"].n_base, got["whole short"].first_word) == (1, 2)


def test_cells_that_hold_nothing_are_not_made(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 8)) * np.exp(rng.normal(size=(600, 1)) * 2)
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)],
                               "vec_id long, embedding array<double>")
    q = np.floor(256 * x)
    got = {}
    for r in topk.top_k(df, every=10, k=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for i in range(0, 600, 10):
        s = q @ q[i]
        order = [j for j in np.lexsort([np.arange(600), -s]) if j != i][:4]
        assert got[i] == [(j, int(s[j])) for j in order]

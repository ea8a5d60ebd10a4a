"""Token counts: pieces are counted once per distinct pre-token and summed per document.

Each task cuts its documents into the pre-tokens of the tokenizer file and turns their
frequencies round: one row per pre-token and group of documents, with the documents' places
and frequencies packed. Pre-tokens that are one vocabulary entry count at once, as the
vocabulary is a fixed table. The other rows are partitioned and sorted by pre-token, so that
equal ones stand together: there the pieces of a distinct pre-token are counted once and joined
to all its rows. The counts go back to their group of documents, where they are added up. No ids
of a text are ever made.

White space decides where pre-tokens end, so texts whose only runs of white space are single
spaces or lines are cut at spaces and each distinct stretch is cut by the library once;
other texts are cut by the library as a whole. Special strings count as the library has them.

Defined cases: a null text is an empty one with no tokens; rows that share an id each have
their row; an empty table gives an empty result; extra columns are not read.

Scale: two shuffles of packed frequencies, no text. A pre-token that very many documents of a
group share is spread over ``SALTS`` partitions, decided from the row itself. A group holds the
documents of one Arrow batch, ``GROUP`` at most, so what one task adds up is bounded. Sums are
formed before the second shuffle.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postloom.llm.bpe import byte_alphabet
from postloom.llm.common import utf8

GROUP = 4_000  # documents of a group at most; places are 16-bit
GROUP_BYTES = 16 << 20
HELD = 2_000_000  # entries that a task adds up at once
SALTS = 64
SHARED = 256  # documents of a group from which a row is salted
_AWKWARD = re.compile(r" \s|\s |[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
#: Stretches of these characters are cut by the standard library's patterns, which agree with
#: the tokenizer's there; all others by the tokenizer itself.
_SETTLED = re.compile(r"[\x00-\x1b\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*")
_PRE_TOKEN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_SHOWN = {b: c for b, c in enumerate(byte_alphabet())}


class Pieces:
    """Pre-tokens of texts and pieces of pre-tokens, by the library's own parts."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.vocab = self.library.get_vocab(with_added_tokens=False)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.cut = re.compile("|".join(map(re.escape, special)) or "(?!)")

    def of_stretch(self, text: str) -> list[str]:
        if _SETTLED.fullmatch(text):
            shown = text.encode().decode("latin-1").translate(_SHOWN)
            if text.isalpha() or text[0] == " " and text[1:].isalpha():
                return [shown]
            if text.isascii():
                return [p.translate(_SHOWN) for p in _PRE_TOKEN.findall(text)]
            return [p.encode().decode("latin-1").translate(_SHOWN)
                    for p in _PRE_TOKEN.findall(text)]
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, pre_token: str) -> int:
        return len(self.library.model.tokenize(pre_token))


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def frequencies(texts: list[str], path: str):
    """Pre-tokens of a group of texts: names; arrays (name, text, frequency); special strings
    per text."""
    p = pieces(path)
    alone: dict[str, int] = defaultdict(lambda: len(alone))
    spaced: dict[str, int] = defaultdict(lambda: len(spaced))
    n_special = np.zeros(len(texts), dtype=np.int64)
    found: list[tuple[list, list, list]] = [([], [], []), ([], [], [])]
    for i, text in enumerate(texts):
        parts = p.cut.split(text)
        n_special[i] = len(parts) - 1
        loose: Counter[str] = Counter()
        words: Counter[str] = Counter()
        for part in parts:
            if _AWKWARD.search(part):
                loose[part] += 1
            elif part:
                first, *rest = part.split(" ")
                words.update(rest)
                if first:
                    loose[first] += 1
        for counts, ids, (which, sizes, times) in (
                (loose, alone, found[0]), (words, spaced, found[1])):
            which += [ids[s] for s in counts]
            times += counts.values()
            sizes.append(len(counts))
    cut = [p.of_stretch(s) for s in alone] + [p.of_stretch(" " + s) for s in spaced]
    names: dict[str, int] = defaultdict(lambda: len(names))
    flat = np.array([names[x] for c in cut for x in c], dtype=np.int64)
    size = np.array([len(c) for c in cut], dtype=np.int64)
    start = np.cumsum(size) - size
    which = np.array(found[0][0] + [w + len(alone) for w in found[1][0]], dtype=np.int64)
    text = np.concatenate([np.repeat(np.arange(len(texts)), np.array(f[1], dtype=np.int64))
                           for f in found]) if texts else np.zeros(0, np.int64)
    times = np.array(found[0][2] + found[1][2], dtype=np.int64)
    n = size[which]
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    name = flat[np.repeat(start[which], n) + within]
    return list(names), name, np.repeat(text, n), np.repeat(times, n), n_special


_PACKED = pa.schema([("group", pa.int64()), ("pre_token", pa.string()),
                     ("places", pa.binary()), ("times", pa.binary())])


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary column whose rows are the values between neighbouring edges."""
    offsets = (edges * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _packed(group: int, names: list[str], name: np.ndarray, text: np.ndarray,
            times: np.ndarray, n_texts: int) -> pa.RecordBatch:
    """One row per pre-token: 16-bit places and 8-bit frequencies; a larger frequency is
    several entries of its place."""
    code, where = np.unique(name * n_texts + text, return_inverse=True)
    total = np.bincount(where, weights=times, minlength=len(code)).astype(np.int64)
    entries = (total + 254) // 255
    last = np.cumsum(entries) - 1
    amount = np.full(int(entries.sum()), 255, dtype=np.uint8)
    amount[last] = (total - (entries - 1) * 255).astype(np.uint8)
    name, text = np.divmod(np.repeat(code, entries), n_texts)
    edges = np.flatnonzero(np.diff(name, prepend=-1, append=-1))
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(edges) - 1, group)),
        pa.array(names, pa.string()).take(pa.array(name[edges[:-1]])),
        _binary(text.astype("<u2"), edges), _binary(amount, edges)], schema=_PACKED)


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``GROUP`` documents and, but for a single one, ``GROUP_BYTES`` bytes."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(batch.column("data")).to_pylist()):
        if i > start and (i - start >= GROUP or size + n > GROUP_BYTES):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def _turned(path: str):
    """Batches (row, doc_id, data) -> packed rows by pre-token, and one row per group with its
    documents: null marks, ids, bytes and the tokens that need no join."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = pieces(path).vocab
        for batch in (g for b in batches for g in _groups(b)):
            data, ids = batch.column("data").to_pylist(), batch.column("doc_id").to_pylist()
            group = batch.column("row")[0].as_py()
            names, name, text, times, base = frequencies([d.decode() for d in data], path)
            single = np.fromiter((x in vocab for x in names), bool, len(names))[name]
            base += np.bincount(
                text[single], weights=times[single], minlength=len(base)).astype(np.int64)
            if not single.all():
                yield _packed(group, names, name[~single], text[~single], times[~single], len(ids))
            table = np.array([[i or 0, len(d), n] for i, d, n in zip(
                ids, data, base.tolist(), strict=True)], dtype="<i8")
            head = bytes(i is None for i in ids) + table.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([group]), pa.nulls(1, pa.string()),
                 pa.array([head], pa.binary()), pa.nulls(1, pa.binary())], schema=_PACKED)

    return task


def _counted(path: str):
    """Sorted rows by pre-token -> sums by group and place, the pieces of a pre-token counted
    once. Sums are kept for ``HELD`` entries at most, then handed on."""
    schema = pa.schema([("group", pa.int64()), ("head", pa.binary()), ("places", pa.binary()),
                        ("sums", pa.binary())])

    def handed(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for group, parts in held.items():
            where = np.frombuffer(b"".join(p for p, _, _ in parts), "<u2")
            times = np.frombuffer(b"".join(t for _, t, _ in parts), "<u1")
            n = np.repeat([n for _, _, n in parts], [len(t) for _, t, _ in parts])
            sums = np.bincount(where, weights=times * n)
            found = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([group]), pa.nulls(1, pa.binary()),
                 pa.array([found.astype("<u2").tobytes()], pa.binary()),
                 pa.array([sums[found].astype("<i8").tobytes()], pa.binary())], schema=schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = pieces(path).count
        last, n, size = None, 0, 0
        held: dict[int, list] = defaultdict(list)
        for batch in batches:
            for group, pre_token, places, times in zip(
                    *[batch.column(c).to_pylist() for c in _PACKED.names], strict=True):
                if pre_token is None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([group]), pa.array([places], pa.binary()),
                         pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())], schema=schema)
                    continue
                if pre_token != last:
                    last, n = pre_token, count(pre_token)
                held[group].append((places, times, n))
                size += len(times)
                if size >= HELD:
                    yield from handed(held)
                    held.clear()
                    size = 0
        yield from handed(held)

    return task


def _summed(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of one group of documents -> one row per document."""
    total = np.zeros(1 << 16, dtype=np.int64)
    head = b""
    for batch in rows:
        for first, places, sums in zip(*[batch.column(c).to_pylist() for c in (
                "head", "places", "sums")], strict=True):
            if first is not None:
                head = first
            else:
                total[np.frombuffer(places, "<u2")] += np.frombuffer(sums, "<i8")
    size = len(head) // 25
    table = np.frombuffer(head, "<i8", offset=size).reshape(size, 3)
    missing = np.frombuffer(head, np.uint8, count=size).astype(bool)
    yield pa.RecordBatch.from_arrays(
        [pa.array(table[:, 0], pa.int64(), mask=missing), pa.array(table[:, 1], pa.int64()),
         pa.array(table[:, 2] + total[:size], pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens under the tokenizer file at ``path``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("data"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    turned = rows.mapInArrow(
        _turned(path), "group long, pre_token string, places binary, times binary")
    shared = F.octet_length("places") >= 2 * SHARED
    salt = F.when(F.col("pre_token").isNull(), F.col("group")).when(
        shared, F.pmod(F.xxhash64("group"), F.lit(SALTS))).otherwise(F.lit(-1))
    together = turned.repartition("pre_token", salt).sortWithinPartitions("pre_token")
    counted = together.mapInArrow(
        _counted(path), "group long, head binary, places binary, sums binary")
    return counted.groupBy("group").applyInArrow(
        _summed, "doc_id long, n_bytes long, n_tokens long")

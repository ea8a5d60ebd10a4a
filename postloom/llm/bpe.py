"""BPE encoding by a queue of merge ranks over a linked list, and decoding.

The tokenizer file gives vocabulary and merges; nothing is trained. A text is prepared as the
file says (Unicode form C, white space folded, lower case), special tokens are cut out first,
and words are found by the file's pattern. Each word becomes a doubly linked list of symbols;
a heap holds (rank, place) of mergeable neighbours; an entry whose symbols have changed since
is stale and skipped. Decoding concatenates vocabulary strings with spaces, as the file has
no decoder of its own.

Work on words is kept in two bounded tables of the Python worker, since they repeat: full, the
newer becomes the older, which goes. A text's ids are the concatenated ids of its words, packed as little-endian unsigned 32-bit.

Defined cases: a null text is an empty one; an empty text has no ids and decodes to the empty
text; rows that share an id each have their row; an empty table gives an empty result; extra
columns are not read.

Scale: no shuffle; every task works on one Arrow batch at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postloom.llm.common import arrow_rows, utf8

#: Words in each of the two tables of known words, of which the older goes; their length.
REMEMBERED, REMEMBERED_LENGTH = 100_000, 64
#: Characters whose class, case or form may differ between Unicode versions, a final sigma,
#: and controls that Python alone takes for white space: texts with them are prepared and cut
#: into words by the tokenizers library itself.
UNSETTLED = (r"[^\x00-\x1b\x20-\u024f\u0391-\u03a1\u03a4-\u03c9\u0410-\u044f\u2010-\u2027"
             r"\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]|\u0130")
_ID, _PLACE = 17, 32  # bits of an id; bits of a place in a word
_PLACES = (1 << _PLACE) - 1


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    names = {b: chr(b) for b in shown}
    rest = (b for b in range(256) if b not in names)
    names |= {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class WordBpe:
    """Encoder and decoder for a tokenizer file of the lower-case, word-end kind."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.strings = {i: s for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        self.cut = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        alphabet = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        self.symbol, self.last = (
            [vocab[c + end] for c in alphabet] for end in ("", self.suffix))
        self.unsettled = regex.compile(UNSETTLED)
        self.library = Tokenizer.from_file(path)
        self.merges: dict[int, int] = {}  # pair of ids -> rank
        self.made: list[int] = []  # rank -> id
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[vocab[a] << _ID | vocab[b]] = rank
            self.made.append(vocab[a + b])
        # pair of bytes inside a word -> rank, or -1
        self.first = {
            (a, b): self.merges.get(x << _ID | y, -1)
            for a, x in enumerate(self.symbol) for b, y in enumerate(self.symbol)}
        self.recent: dict[str, tuple[bytes, str]] = {}
        self.earlier: dict[str, tuple[bytes, str]] = {}

    def encode_word(self, data: bytes) -> list[int]:
        """Ids of one word: the neighbours of least rank, leftmost first, are merged."""
        n = len(data)
        # merge due at each place with its right neighbour; -1 for none
        due = [r if r < 0 else r << _PLACE | i
               for i, r in enumerate(map(self.first.get, zip(data, data[1:])))]
        ids = [self.symbol[b] for b in data]
        ids[-1] = self.last[data[-1]]
        if n > 1:
            m = self.merges.get(ids[-2] << _ID | ids[-1])
            due[-1] = -1 if m is None else m << _PLACE | n - 2
        heap = [entry for entry in due if entry >= 0]
        if not heap:
            return ids
        due.append(-1)
        merges, made_by, pop, push = self.merges.get, self.made, heapq.heappop, heapq.heappush
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(heap)
        while heap:
            entry = pop(heap)
            i = entry & _PLACES
            if due[i] != entry:
                continue  # stale: one of the two has changed since
            j = after[i]
            ids[i] = made = made_by[entry >> _PLACE]
            ids[j] = due[j] = due[i] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (m := merges(made << _ID | ids[k])) is not None:
                    due[i] = entry = m << _PLACE | i
                    push(heap, entry)
            if (h := before[i]) >= 0:
                if (m := merges(ids[h] << _ID | made)) is not None:
                    due[h] = entry = m << _PLACE | h
                    push(heap, entry)
                else:
                    due[h] = -1
        return [x for x in ids if x >= 0]

    def _word(self, word: str, data: bytes) -> tuple[bytes, str]:
        """Packed ids of a word that was not met of late, and their joined strings."""
        known = self.earlier.get(word)
        if known is None:
            ids = self.encode_word(data)
            known = struct.pack(f"<{len(ids)}I", *ids), " ".join([self.strings[x] for x in ids])
        if len(word) <= REMEMBERED_LENGTH:
            if len(self.recent) >= REMEMBERED:
                self.earlier, self.recent = self.recent, {}
            self.recent[word] = known
        return known

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        """The same for each word of a text without special tokens."""
        if self.unsettled.search(text):
            normal = self.library.normalizer.normalize_str(text)
            found = self.library.pre_tokenizer.pre_tokenize_str(normal)
            words = [bytes(map(self.byte_of.__getitem__, w)) for w, _ in found]
            return [self.recent.get(w) or self._word(w, data)
                    for w, data in zip([d.decode() for d in words], words)]
        words = self.word.findall(unicodedata.normalize("NFC", text).lower())
        return [self.recent.get(w) or self._word(w, w.encode()) for w in words]

    def encode(self, text: str) -> tuple[bytes, str]:
        """Packed ids of a text, and the text they decode to."""
        done: list[tuple[bytes, str]] = []
        for part in self.cut.split(text):
            if part in self.special:
                done.append((struct.pack("<I", self.special[part]), part))
            else:
                done += self._plain(part)
        return b"".join([p for p, _ in done]), " ".join([s for p, s in done if p])

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def encode_texts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 ids: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``ids`` also
    the packed ids and the decoded text."""
    def make(keys: list, texts: list):
        encode = tokenizer(path).encode
        done = [encode(t.decode()) for t in texts]
        out = {
            "doc_id": keys, "n_tokens": [len(p) // 4 for p, _ in done],
            "ids_sha256": [hashlib.sha256(p).hexdigest() for p, _ in done],
            "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for _, d in done]}
        yield out | ({"ids": [p for p, _ in done], "decoded": [d for _, d in done]} if ids else {})

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_rows(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("data")), make,
        schema + (", ids binary, decoded string" if ids else ""))

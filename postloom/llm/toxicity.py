"""Toxicity by compression distance: two zstandard dictionaries, windows, thresholds.

Training (bounded sample, see ``PER_CLASS`` and ``MAX_TRAIN_BYTES``): the ordinary dictionary
holds the most common words of ordinary texts. The toxic one holds the stems of toxic texts: of
each word the stretch of byte n-grams (the blank in front of a word counts) that a word of a toxic
text has ``RATIO`` times as often as one of an ordinary text. How often they occur counts, not in how many
texts, so that stems which ordinary texts form by chance are told from stems that toxic texts
keep using, in every language. Neither dictionary sees labels of held-out rows.

Scoring: every window (a word between spaces) is compressed with both dictionaries. Bytes are
doubled, so that a byte that no dictionary covers costs two, and a fixed carrier that both
dictionaries end with stands in front, so that no window is too short to be compressed. The gain
of a window is its length under the ordinary dictionary minus that under the toxic one. The
document's features are the shares of windows whose gain reaches each of ``STEPS``, and the mean of
the positive gains: both relative to the length of the text. A logistic function fitted on a part of
the sample that the dictionaries did not see turns them into the score, and the threshold is
calibrated so that 0.3 separates.

Defined cases: null and empty texts have no window and get the score of a text without any gain;
rows that share an id each have their row; without usable labels of both kinds every score is
0; an empty table gives an empty result; label, lang, source and id are never read by a score.

Scale: the model is a constant of a few hundred kB; scoring is one pass without shuffle. Windows
that repeat are remembered in a bounded table of the Python worker.
"""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import arrow_rows, labelled_sample, utf8

PER_CLASS = {0: 1800, 1: 900}
MAX_TRAIN_BYTES = 20_000
GRAMS = (4, 6)
RATIO, LEAST_SHARE = 15, 0.02
STEPS = (1, 2, 3, 4, 5, 6, 8, 10)
SHORT = 20  # windows that every text has beside its own, so that short ones have no high shares
ORDINARY_BYTES, TOXIC_BYTES = 65536, 8192
CUT = 0.3
REMEMBERED = 200_000
CARRIER = bytes(1 + (i * 7 + i // 5) % 31 for i in range(48))


def _double(data: bytes) -> bytes:
    out = bytearray(2 * len(data))
    out[::2] = data
    out[1::2] = data
    return bytes(out)


def windows(data: bytes) -> list[bytes]:
    """Every word of a text, between spaces, with A-Z in lower case."""
    return [b" %b " % w for w in data.lower().split()]


def _grams(window: bytes) -> set[bytes]:
    return {window[i:i + n] for n in GRAMS for i in range(len(window) - n + 1)}


def _in_texts(texts: list[bytes]) -> Counter:
    """In how many texts each window occurs."""
    counts: Counter[bytes] = Counter()
    for text in texts:
        counts.update(set(windows(text)))
    return counts


def _gram_counts(texts: list[bytes]) -> tuple[Counter, Counter, int]:
    """Occurrences of each n-gram, in how many texts it is, and the number of windows.

    A text that repeats itself counts a window three times and an n-gram twelve times at most.
    """
    occurrences: Counter[bytes] = Counter()
    inside: Counter[bytes] = Counter()
    total = 0
    for text in texts:
        own: Counter[bytes] = Counter()
        for window, n in Counter(windows(text)).items():
            total += n
            for gram in _grams(window):
                own[gram] += min(n, 3)
        for gram, n in own.items():
            occurrences[gram] += min(n, 12)
        inside.update(own.keys())
    return occurrences, inside, total


def stem(window: bytes, telling: set[bytes]) -> bytes:
    """From the first to the last byte of a window that a telling n-gram covers."""
    places = [(i, i + n) for n in GRAMS for i in range(len(window) - n + 1)
              if window[i:i + n] in telling]
    return window[min(a for a, _ in places):max(b for _, b in places)] if places else b""


def toxic_stems(toxic: list[bytes], ordinary: list[bytes]) -> Counter:
    """Stems of toxic texts and in how many of them their words are."""
    often, inside, words = _gram_counts(toxic)
    elsewhere, _, other_words = _gram_counts(ordinary)
    least = max(3, LEAST_SHARE * len(toxic)) if len(toxic) >= 20 else 2
    telling = {g for g, n in often.items() if inside[g] >= least
               and n / words >= RATIO * (elsewhere[g] + 0.5) / other_words}
    stems: Counter[bytes] = Counter()
    for window, n in _in_texts(toxic).items():
        stems[stem(window, telling)] += n
    del stems[b""]
    return Counter({s: n for s, n in stems.items() if n >= least / 2})


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]  # of the features, and a constant

    def __post_init__(self) -> None:
        self.known: dict[bytes, float] = {}
        self.tools = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}, "tools": None}

    def _lengths(self, window: bytes) -> tuple[int, int]:
        if self.tools is None:
            self.tools = [self._tool(d) for d in (self.ordinary, self.toxic)]
        data = CARRIER + _double(window)
        return tuple(len(t.compress(data)) for t in self.tools)

    @staticmethod
    def _tool(content: bytes) -> zs.ZstdCompressor:
        """The settings are fixed: lengths only count in relation to each other."""
        held = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
        settings = zs.ZstdCompressionParameters(
            min_match=6, strategy=zs.STRATEGY_LAZY, window_log=18, hash_log=16, chain_log=16,
            search_log=7, target_length=64, write_content_size=0, write_checksum=0,
            write_dict_id=0)
        held.precompute_compress(compression_params=settings)
        return zs.ZstdCompressor(dict_data=held, compression_params=settings)

    def gain(self, window: bytes) -> float:
        value = self.known.get(window)
        if value is None:
            plain, toxic = self._lengths(window)
            value = plain - toxic
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(window) <= 64:
                self.known[window] = value
        return value

    def features(self, data: bytes) -> np.ndarray:
        gains = np.array([self.gain(w) for w in windows(data)], dtype=float)
        n = len(gains) + SHORT
        return np.array([*[(gains >= step).sum() / n for step in STEPS],
                         np.maximum(gains, 0).sum() / n])

    def score(self, data: bytes) -> float:
        margin = self.features(data) @ np.array(self.weights[:-1]) + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps, both classes weighing the same."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(z.shape[1])
    ridge = np.diag([0.01] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (y - p)) / len(y) - ridge @ w
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z / len(y) + ridge
        w = w + np.linalg.solve(hessian, gradient)
    w[:-1] /= scale
    w[-1] -= w[:-1] @ mean
    return w


def train(sample: list[tuple[bytes, int]]) -> Model | None:
    """Dictionaries from two thirds of the sample, calibration on the other third."""
    texts = {k: list(dict.fromkeys(t for t, label in sample if label == k)) for k in (0, 1)}
    if min(map(len, texts.values())) < 3:
        return None
    fit, held = {}, {}
    for label, all_texts in texts.items():
        random.Random(7).shuffle(all_texts)
        n = -(-2 * len(all_texts) // 3)
        fit[label], held[label] = all_texts[:n], all_texts[n:]
    stems, common = toxic_stems(fit[1], fit[0]), _in_texts(fit[0])

    def content(counts: Counter, size: int) -> bytes:
        """The most common parts, the commonest last."""
        ordered = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
        return _double(b"".join(w for w, _ in reversed(ordered[:size])))[-size:] + CARRIER

    model = Model(content(common, ORDINARY_BYTES), content(stems, TOXIC_BYTES), ())
    x = np.array([model.features(t) for k in (0, 1) for t in held[k]], dtype=float)
    y = np.array([k for k in (0, 1) for _ in held[k]])
    w = _logistic(x, y)
    margin = x @ w[:-1] + w[-1]
    # the threshold with the best mean of both classes' accuracy; it becomes the cut
    grid = np.unique(margin)
    middle = (grid[1:] + grid[:-1]) / 2 if len(grid) > 1 else grid
    right = [((margin[y == 1] >= m).mean() + (margin[y == 0] < m).mean()) / 2 for m in middle]
    top = np.flatnonzero(np.array(right) >= max(right) - 1e-12)
    constant = w[-1] - middle[top[len(top) // 2]] + np.log(CUT / (1 - CUT))
    model.weights = (*w[:-1].tolist(), float(constant))
    model.known = {}
    return model


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic",
        doc_id: str = "doc_id", text: str = "text") -> Model | None:
    sample = labelled_sample(
        docs, labels, label, usable, max(PER_CLASS.values()), MAX_TRAIN_BYTES, doc_id, text)
    seen: Counter[int] = Counter()
    bounded = []
    for data, k in sample:
        seen[k] += 1
        if seen[k] <= PER_CLASS[k]:
            bounded.append((data, k))
    return train(bounded)


def toxicity(docs: DataFrame, model: Model | None, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def make(ids: list, texts: list):
        scores = [kept.value.score(t) if kept.value else 0.0 for t in texts]
        yield {"doc_id": ids, "score": scores, "predicted": [int(s >= CUT) for s in scores]}

    return arrow_rows(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("data")), make,
        "doc_id long, score double, predicted int")

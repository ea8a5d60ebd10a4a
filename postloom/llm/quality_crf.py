"""Quality: a linear-chain conditional random field labels lines good or bad.

Each line has a few measures (length, kinds of characters, repetition, ...), each cut into
bins; a line's features are its own bins and those of the lines before and behind it. The
chain's two states are bad and good. Training lines carry the label of their document;
the likelihood is maximised by gradient steps (Adam) over a bounded sample (``PER_CLASS``
documents of each label, ``MAX_TRAIN_BYTES`` bytes each at most), with gradients from
forward-backward. A document's score is the mean of its lines' forward-backward marginals of
"good", weighted by their length, moved by a calibrated offset.

Defined cases: null and empty texts, and texts of white space, have no line and score by the
offset alone; rows that share an id each have their row; without labels of both kinds every
score is 0.5; an empty table gives an empty result; lang, source and id are never read.

Scale: the model is a small constant; scoring is one pass without shuffle. A text of any
length is one chain, in memory proportional to its lines.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import arrow_rows, labelled_sample, slices, utf8

PER_CLASS = 1200
MAX_TRAIN_BYTES = 20_000
BINS = 6
STEPS = 150
_LOWER = bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\r\f\v"
_HIGH = bytes(range(128, 256))
_POINT = b".,;:'\"()?-"
_REST = bytes(b for b in range(128) if bytes([b]) not in [
    bytes([x]) for x in _LOWER + _UPPER + _DIGIT + _SPACE + _POINT])
N_MEASURES = 14


def lines(data: bytes) -> list[bytes]:
    return [x for x in data.split(b"\n") if x and not x.isspace()]


def measures(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Measures of each line of a text, and the lines' lengths in bytes."""
    found = lines(data)
    rows = np.empty((len(found), N_MEASURES))
    seen: set[bytes] = set()
    for i, line in enumerate(found):
        n = len(line)
        words = line.split()
        m = len(words)
        upper = n - len(line.translate(None, _UPPER))
        letters = upper + n - len(line.translate(None, _LOWER)) + n - len(line.translate(None, _HIGH))
        distinct = len(set(words))
        ends = len([1 for w in words if w[-1] in b".,;:!?"])
        rows[i] = (
            math.log1p(n), math.log1p(m), n / m, distinct / m,
            letters / n, upper / max(1, letters), (n - len(line.translate(None, _DIGIT))) / n,
            (n - len(line.translate(None, _REST))) / n,
            (n - len(line.translate(None, _POINT))) / n,
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / m,
            ends / m, len([1 for w in words if len(w) <= 3]) / m,
            line in seen, line.rstrip()[-1] in b".!?")
        seen.add(line)
    return rows, np.array([len(x) for x in found], dtype=float)


@dataclass
class Crf:
    edges: np.ndarray  # measure x inner bin edges
    weights: np.ndarray  # feature x 2
    steps: np.ndarray  # 2 x 2, from a state to the next
    offset: float

    @property
    def none(self) -> int:
        """Feature of a missing neighbour."""
        return 3 * N_MEASURES * BINS

    def features(self, rows: np.ndarray) -> np.ndarray:
        """Active features of each line: own bins, bins of the line before and behind, bias."""
        n = len(rows)
        own = np.empty((n, N_MEASURES), dtype=np.int64)
        for j in range(N_MEASURES):
            own[:, j] = j * BINS + np.searchsorted(self.edges[j], rows[:, j], side="right")
        size = N_MEASURES * BINS
        out = np.full((n, 3 * N_MEASURES + 1), self.none, dtype=np.int64)
        out[:, :N_MEASURES] = own
        out[1:, N_MEASURES:2 * N_MEASURES] = own[:-1] + size
        out[:-1, 2 * N_MEASURES:3 * N_MEASURES] = own[1:] + 2 * size
        out[:, -1] = self.none + 1
        return out

    def marginals(self, rows: np.ndarray) -> np.ndarray:
        """Probability of "good" for each line, by forward-backward in log space."""
        scores = self.weights[self.features(rows)].sum(axis=1).tolist()
        (s00, s01), (s10, s11) = self.steps.tolist()
        n = len(scores)
        # log odds are enough for two states
        ahead = [0.0] * n
        odds = scores[0][1] - scores[0][0]
        ahead[0] = odds
        for i in range(1, n):
            odds = _log_add(s01, s11 + odds) - _log_add(s00, s10 + odds)
            odds += scores[i][1] - scores[i][0]
            ahead[i] = odds
        back = 0.0
        out = np.empty(n)
        for i in range(n - 1, -1, -1):
            out[i] = _sigmoid(ahead[i] + back)
            if i:
                z = back + scores[i][1] - scores[i][0]
                back = _log_add(s10, s11 + z) - _log_add(s00, s01 + z)
        return out

    def score(self, data: bytes) -> float:
        rows, length = measures(data)
        if not len(rows):
            return _sigmoid(self.offset)
        good = float(self.marginals(rows) @ length / length.sum())
        good = min(max(good, 1e-9), 1 - 1e-9)
        return _sigmoid(math.log(good / (1 - good)) + self.offset)


def _log_add(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a >= b else b + math.log1p(math.exp(a - b))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def train(sample: list[tuple[bytes, int]]) -> Crf | None:
    """Chain fitted to the sample; every fifth document only sets the offset."""
    chains = [(measures(t)[0], label, t) for t, label in dict.fromkeys(sample)]
    chains = [c for c in chains if len(c[0])]
    held = chains[4::5]
    fitted = [c for i, c in enumerate(chains) if i % 5 != 4]
    if len({label for _, label, _ in fitted}) < 2:
        return None
    every = np.concatenate([rows for rows, _, _ in fitted])
    edges = np.quantile(every, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    n_features = 3 * N_MEASURES * BINS + 2
    model = Crf(edges, np.zeros((n_features, 2)), np.zeros((2, 2)), 0.0)
    parts = [model.features(rows) for rows, _, _ in fitted]
    longest = max(map(len, parts))
    order = np.argsort([-len(p) for p in parts], kind="stable")
    parts = [parts[i] for i in order]
    label = np.array([fitted[i][1] for i in order])
    size = np.array([len(p) for p in parts])
    alive = [int((size > t).sum()) for t in range(longest)]
    flat = np.concatenate(parts)
    start = np.cumsum(size) - size
    at = [start[:alive[t]] + t for t in range(longest)]  # rows of the t-th lines
    share = np.where(label == 1, 0.5 / (label == 1).sum(), 0.5 / (label == 0).sum())
    per_line = np.repeat(share / size, size)  # documents weigh the same, whatever their length
    truth = np.repeat(label, size)
    first = np.zeros((n_features, 2)), np.zeros((n_features, 2))
    second = np.zeros((2, 2)), np.zeros((2, 2))
    for step in range(1, STEPS + 1):
        scores = model.weights[flat].sum(axis=1)
        front, back = np.empty_like(scores), np.zeros_like(scores)
        front[at[0]] = scores[at[0]]
        for t in range(1, longest):
            before = front[at[t - 1][:alive[t]]]
            front[at[t]] = scores[at[t]] + np.logaddexp(
                before[:, :1] + model.steps[0], before[:, 1:] + model.steps[1])
        for t in range(longest - 1, 0, -1):
            ahead = scores[at[t]] + back[at[t]]
            back[at[t - 1][:alive[t]]] = np.logaddexp(
                ahead[:, :1] + model.steps[:, 0], ahead[:, 1:] + model.steps[:, 1])
        total = np.logaddexp(*(front + back).T)
        seen = np.exp(front + back - total[:, None])
        error = -seen * per_line[:, None]
        error[np.arange(len(truth)), truth] += per_line
        gradient = np.column_stack([
            np.bincount(flat.ravel(), weights=np.repeat(error[:, s], flat.shape[1]),
                        minlength=n_features) for s in (0, 1)]) - 1e-4 * model.weights
        moves = np.zeros((2, 2))
        for t in range(1, longest):
            a, b = at[t - 1][:alive[t]], at[t]
            joint = np.exp(front[a][:, :, None] + model.steps + (scores[b] + back[b])[:, None, :]
                           - total[b][:, None, None])
            moves -= (joint * per_line[b][:, None, None]).sum(axis=0)
            for s in (0, 1):
                moves[s, s] += per_line[b][truth[b] == s].sum()
        moves -= 1e-2 * model.steps
        for value, slope, (mean, var) in (
                (model.weights, gradient, first), (model.steps, moves, second)):
            mean += 0.1 * (slope - mean)
            var += 0.01 * (slope**2 - var)
            value += 0.05 * (mean / (1 - 0.9**step)) / (
                np.sqrt(var / (1 - 0.99**step)) + 1e-8)
    if len({k for _, k, _ in held}) == 2:
        model.offset = _offset(model, held)
    return model


def _offset(model: Crf, held: list) -> float:
    """Offset with the best mean of both classes' accuracy on documents not trained on."""
    odds = np.array([math.log((s := min(max(model.score(t), 1e-9), 1 - 1e-9)) / (1 - s))
                     for _, _, t in held])
    label = np.array([k for _, k, _ in held])
    grid = np.unique(odds)
    middle = (grid[1:] + grid[:-1]) / 2 if len(grid) > 1 else grid
    right = np.array([((odds[label == 1] >= m).mean() + (odds[label == 0] < m).mean()) / 2
                      for m in middle])
    top = middle[right >= right.max() - 1e-12]
    return float(-top[np.argmin(np.abs(top))])


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality",
        doc_id: str = "doc_id", text: str = "text") -> Crf | None:
    return train(labelled_sample(
        docs, labels, label, usable, PER_CLASS, MAX_TRAIN_BYTES, doc_id, text))


def quality(docs: DataFrame, model: Crf | None, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def make(ids: list, texts: list):
        scores = [kept.value.score(t) if kept.value else 0.5 for t in texts]
        yield {"doc_id": ids, "score": scores, "predicted": [int(s >= 0.5) for s in scores]}

    return arrow_rows(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("data")), make,
        "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Crf | None, text: str = "text") -> DataFrame:
    """Documents whose score is 0.5 or more, with all their columns."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole)):
            texts = batch.column(text).to_pylist()
            good = [kept.value is None or kept.value.score((t or "").encode()) >= 0.5
                    for t in texts]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(task, docs.schema)

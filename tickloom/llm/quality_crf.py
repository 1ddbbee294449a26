"""Document quality by a linear-chain conditional random field over lines.

Every line has features of itself and of its neighbours, and is good or bad. The chain of a
document is scored by forward-backward; the marginals of its lines, weighted by length, give the
document's share of good text, which a logistic curve turns into the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import arrays
from tickloom.llm.frames import map_texts

# The fit uses a bounded sample: the labelled documents of the smallest id hashes, of at
# most so many lines each. Everything else covers all documents and all their lines.
TRAIN_DOCS = 4096
TRAIN_LINES = 200
CHUNK_BYTES = 1 << 21

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#*$%&<>{}[]\\^~=_@",
    "bar": b"|",
    "shout": b"!",
    "mark": b".,;:?'\"()-",
}
_OWN, _SHARED = 14, slice(1, 12)


def _table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_TABLES = {name: _table(members) for name, members in _CLASSES.items()}


def line_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line (own ones, then those of the lines before and after), weights, first lines."""
    head, tail, first = arrays.lines(data, bounds)
    row = arrays.owners(first)
    starts, ends, _ = arrays.words(data, bounds, arrays.NOT_SPACE)
    w0, w1 = np.searchsorted(starts, head), np.searchsorted(starts, tail)
    n_words = (w1 - w0).astype(float)
    words = np.maximum(n_words, 1.0)

    def inside(table):
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[tail] - total[head]).astype(float)

    chars = np.concatenate([[0], np.cumsum(arrays.NOT_CONTINUED[data])])
    size = np.maximum((chars[tail] - chars[head]).astype(float), 1.0)
    per_word = lambda flags: (lambda c: (c[w1] - c[w0]) / words)(np.concatenate([[0], np.cumsum(flags)]))
    length = chars[ends] - chars[starts]
    hashes = arrays.byte_hash(data, starts, ends)
    line_of = np.searchsorted(head, starts, "right") - 1
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    order = np.lexsort((hashes, line_of))
    again = np.zeros(len(starts), bool)
    again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (line_of[order[1:]] == line_of[order[:-1]])
    whole = arrays.byte_hash(data, head, tail)
    order = np.lexsort((np.arange(len(head)), whole, row))
    copy = np.zeros(len(head), bool)
    copy[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    last = data[np.maximum(tail - 1, 0)] if len(data) else np.zeros(len(head), np.uint8)

    own = np.zeros((len(head), _OWN))
    own[:, 0] = 1.0
    own[:, 1] = np.log1p(n_words) / 3
    own[:, 2] = np.minimum(per_word(length) / 6, 3.0)
    own[:, 3] = np.minimum(inside(_TABLES["symbol"]) / words, 3.0)
    own[:, 4] = inside(_TABLES["upper"]) / size * 2
    own[:, 5] = inside(_TABLES["digit"]) / size * 3
    own[:, 6] = np.minimum(inside(_TABLES["mark"]) / words, 3.0)
    own[:, 7] = np.minimum(inside(_TABLES["shout"]) / words, 3.0)
    own[:, 8] = np.minimum(inside(_TABLES["bar"]) / words, 3.0)
    own[:, 9] = per_word(same)
    own[:, 10] = per_word(again)
    own[:, 11] = copy & (n_words > 0)
    own[:, 12] = per_word(length <= 3)
    own[:, 13] = np.isin(last, list(b".?!")) & (tail > head)

    before, after = np.zeros_like(own[:, _SHARED]), np.zeros_like(own[:, _SHARED])
    joined = row[1:] == row[:-1]
    before[1:][joined] = own[:-1, _SHARED][joined]
    after[:-1][joined] = own[1:, _SHARED][joined]
    ends_of = np.zeros((len(head), 2))
    ends_of[first[:-1], 0] = 1.0
    ends_of[first[1:] - 1, 1] = 1.0
    return np.hstack([own, before, after, ends_of]), tail - head + 1.0, first


N_FEATURES = _OWN + 2 * 11 + 2


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    step: np.ndarray  # step[i, j]: score of state j after state i; 1 is good
    slope: float
    offset: float


def _along(emission: np.ndarray, first: np.ndarray, start_at: np.ndarray, direction: int, pass_on) -> np.ndarray:
    """Messages along all chains at once: message = emission + pass_on(message of the line before)."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    longest = np.sort(size)
    at = start_at[order]
    message = emission.copy()
    for step in range(1, int(size.max(initial=0))):
        active = len(size) - np.searchsorted(longest, step, "right")
        here = at[:active] + direction * step
        message[here] = emission[here] + pass_on(message[here - direction])
    return message


def log_odds(emission: np.ndarray, first: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of good: of forward messages, of backward messages with the line itself, and of the marginals."""
    join = np.logaddexp
    forward = _along(emission, first, first[:-1], 1, lambda m: join(step[0, 1], step[1, 1] + m) - join(step[0, 0], step[1, 0] + m))
    backward = _along(emission, first, first[1:] - 1, -1, lambda m: join(step[1, 0], step[1, 1] + m) - join(step[0, 0], step[0, 1] + m))
    return forward, backward, forward + backward - emission


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def good_share(features: np.ndarray, weight: np.ndarray, first: np.ndarray, weights: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Mean marginal of good over a document's lines, weighted by their length."""
    marginal = _sigmoid(log_odds(features @ weights, first, step)[2])
    return np.add.reduceat(marginal * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])


def _logit(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.log(share / (1 - share))


def fit(features: np.ndarray, weight: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = 150, penalty: float = 0.003) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam; each line has the label of its document."""
    docs = len(labels)
    weights, step = np.zeros(features.shape[1]), np.zeros((2, 2))
    if not docs:
        return Model(weights, step, 1.0, 0.0)
    row = arrays.owners(first)
    truth = labels[row].astype(float)
    pairs = np.flatnonzero(row[1:] == row[:-1])
    seen = np.bincount(3 * labels[row[pairs]], minlength=4).reshape(2, 2)
    mean, square = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    for number in range(1, rounds + 1):
        emission = features @ weights
        forward, backward, odds = log_odds(emission, first, step)
        slope = features.T @ (truth - _sigmoid(odds)) / docs - penalty * weights
        f, b = forward[pairs], backward[pairs + 1]
        cells = np.stack([step[0, 0] + 0 * f, step[0, 1] + b, step[1, 0] + f, step[1, 1] + f + b], axis=1)
        cells = np.exp(cells - cells.max(axis=1, keepdims=True)) if len(pairs) else np.zeros((0, 4))
        expected = (cells / cells.sum(axis=1, keepdims=True)).sum(axis=0).reshape(2, 2) if len(pairs) else np.zeros((2, 2))
        slope = np.concatenate([slope, ((seen - expected) / docs - penalty * step).ravel()])
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        move = 0.1 * (mean / (1 - 0.9**number)) / (np.sqrt(square / (1 - 0.99**number)) + 1e-8)
        weights, step = weights + move[:-4], step + move[-4:].reshape(2, 2)
    x = _logit(good_share(features, weight, first, weights, step))
    a, c = 1.0, 0.0
    for _ in range(50):  # Newton steps of a penalised logistic regression in one variable
        p = _sigmoid(a * x + c)
        g = np.array([(x * (labels - p)).sum() - 0.01 * a, (labels - p).sum() - 0.01 * c])
        v = p * (1 - p) + 1e-6
        h = np.array([[(v * x * x).sum() + 0.01, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
        a, c = np.array([a, c]) + np.clip(np.linalg.solve(h, g), -1, 1)
    return Model(weights, step, float(a), float(c))


def _featured():
    def features(data, bounds, rows):
        values, weight, first = line_features(data, bounds)
        flat = pa.array(values.astype(np.float32).ravel())
        return [np.diff(first), arrays.lists(flat, first * values.shape[1]), arrays.lists(weight, first)]

    return features


def train(learn: DataFrame, id_col: str, text_col: str, label_col: str, max_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES) -> Model:
    """Fit on the ``max_docs`` labelled documents of the smallest id hashes with at most ``max_lines`` lines."""
    breaks = F.length(text_col) - F.length(F.translate(F.col(text_col), "\n", ""))
    usable = learn.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & (breaks < max_lines))
    mark = F.xxhash64(F.col(id_col))
    edge = usable.select(mark.alias("mark")).orderBy("mark").limit(max_docs).agg(F.max("mark")).first()[0]
    if edge is None:
        return fit(np.zeros((0, N_FEATURES)), np.zeros(0), np.zeros(1, int), np.zeros(0, int))
    sample = usable.where(mark <= edge).select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), mark.alias("mark"))
    found = map_texts(sample, "text", "n_lines BIGINT, features ARRAY<FLOAT>, weight ARRAY<DOUBLE>", _featured)
    rows = found.select("row.mark", "row.label", "result.*").orderBy("mark", "label", "n_lines", "weight").limit(max_docs).toArrow()
    first = np.concatenate([[0], np.cumsum(rows["n_lines"].to_numpy())]).astype(np.int64)
    values = rows["features"].combine_chunks().flatten().to_numpy().astype(float).reshape(-1, N_FEATURES)
    labels = (rows["label"].to_numpy() > 0).astype(int)
    return fit(values, rows["weight"].combine_chunks().flatten().to_numpy(), first, labels)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Struct ``row`` (the document's columns), struct ``result``: score and n_lines.

    A null text counts as empty; an empty text is one empty line and has a score like any
    other. All lines of a text are used. Rows never meet, so repeated rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def job():
        model = shared.value

        def one(data, bounds, rows):
            features, weight, first = line_features(data, bounds)
            share = good_share(features, weight, first, model.weights, model.step)
            return [_sigmoid(model.slope * _logit(share) + model.offset), np.diff(first)]

        return one

    return map_texts(docs, text_col, "score DOUBLE, n_lines BIGINT", job, CHUNK_BYTES)

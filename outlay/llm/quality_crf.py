"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's score for being good is linear in features
of the line and of its neighbours; a bonus or cost for each pair of states
couples adjacent lines. Forward-backward gives each line's chance of being
good; their mean, weighted by line length, is the document's raw quality, and a
logistic curve fitted on the training documents makes it a score.

Labels are known for documents only, so in training each line carries its
document's label. The model has a few dozen numbers and is fitted in numpy on a
bounded sample; scoring reads every document whole, in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import id_and_text
from outlay.llm.labelled import is_held_out, training_sample

#: Labelled documents per class in the training sample.
SAMPLE_PER_CLASS = 3000
THRESHOLD = 0.3
_DOCS_AT_ONCE = 512
_STEPS = 200
_LINE_FEATURES = 12

_LETTER, _UPPER, _DIGIT, _SPACE, _PLAIN, _MARK = range(6)


def _byte_classes() -> np.ndarray:
    table = np.full(256, _MARK, dtype=np.uint8)
    for value in range(256):
        sign = chr(value)
        if value >= 128 or "a" <= sign <= "z":
            table[value] = _LETTER
        elif "A" <= sign <= "Z":
            table[value] = _UPPER
        elif sign.isdigit():
            table[value] = _DIGIT
        elif value == 32 or 9 <= value <= 13:
            table[value] = _SPACE
        elif sign in ".,;:'\"()-?":
            table[value] = _PLAIN
    return table


_CLASSES = _byte_classes()


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line (rows) and the lines' lengths in bytes, at least 1.

    An empty text is one empty line. Each line has its own features and the
    mean of its neighbours'; beyond the ends the line itself stands in.
    """
    lines = text.split("\n")
    data = np.frombuffer((text + "\n").encode(), dtype=np.uint8)
    classes = _CLASSES[data]
    ends = np.flatnonzero(data == 10)
    starts = np.r_[0, ends[:-1] + 1]
    sizes = np.maximum(ends - starts, 1).astype(np.float32)
    share = [np.add.reduceat((classes == c).astype(np.int32), starts) / sizes for c in range(6)]
    share[_SPACE] = (share[_SPACE] * sizes - 1) / sizes  # without the line break
    marked_end = np.r_[(classes[:-1] == _MARK) & (classes[1:] == _SPACE), False].astype(np.int32)
    words = [line.split() for line in lines]
    counts = np.array([len(w) for w in words], dtype=np.float32)
    some = np.maximum(counts, 1)
    distinct = np.array([len(set(w)) for w in words], dtype=np.float32)
    repeated = np.array([sum(map(eq, w, w[1:])) for w in words], dtype=np.float32)
    seen: dict[str, int] = {}
    for line in lines:
        seen[line] = seen.get(line, 0) + 1
    own = np.stack(
        [
            np.log1p(sizes) / 8,
            share[_UPPER],
            share[_DIGIT],
            share[_PLAIN],
            share[_MARK],
            np.add.reduceat(marked_end, starts) / some,
            np.log1p(counts) / 6,
            np.minimum(sizes / some, 30) / 30,
            distinct / some,
            repeated / some,
            (counts == 0).astype(np.float32),
            np.array([(seen[line] - 1) / len(lines) for line in lines], dtype=np.float32),
        ],
        axis=1,
    ).astype(np.float32)
    around = (np.concatenate([own[:1], own[:-1]]) + np.concatenate([own[1:], own[-1:]])) / 2
    return np.concatenate([own, around], axis=1), sizes


@dataclass(frozen=True)
class QualityModel:
    """Feature shift and scale, line weights, the 2 x 2 pair scores, and the curve's slope and offset."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    pairs: np.ndarray
    slope: float
    offset: float

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -6, 6) @ self.weights + self.bias


def _order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents from longest to shortest, and where each one's lines begin."""
    return np.argsort(-lengths, kind="stable"), np.r_[0, np.cumsum(lengths)[:-1]]


def marginals(scores: np.ndarray, lengths: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of being good for each line, and the expected 2 x 2 counts of adjacent states.

    All documents of the batch step together; after sorting by length the
    active ones are a prefix. Messages are normalised at each step.
    """
    order, begin = _order(lengths)
    begin, sorted_lengths = begin[order], lengths[order]
    steps = int(sorted_lengths[0]) if len(lengths) else 0
    active = [int(np.searchsorted(-sorted_lengths, -t, side="left")) for t in range(steps)]
    local = np.exp(np.clip(np.stack([-scores / 2, scores / 2], axis=1), -30, 30))
    table = np.exp(pairs)
    forward = np.empty_like(local)
    for t in range(steps):
        at = begin[: active[t]] + t
        message = local[at] if t == 0 else (forward[at - 1] @ table) * local[at]
        forward[at] = message / message.sum(axis=1, keepdims=True)
    good = np.empty(len(scores))
    counts = np.zeros((2, 2))
    backward = np.ones((len(order), 2))
    for t in range(steps - 1, -1, -1):
        at = begin[: active[t]] + t
        both = forward[at] * backward[: active[t]]
        good[at] = both[:, 1] / both.sum(axis=1)
        if t:
            ahead = local[at] * backward[: active[t]]
            edge = forward[at - 1][:, :, None] * table * ahead[:, None, :]
            counts += (edge / edge.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            message = ahead @ table.T
            backward[: active[t]] = message / message.sum(axis=1, keepdims=True)
    return good, counts


def _raw(good: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log-odds of the length-weighted mean chance of each document."""
    begin = np.r_[0, np.cumsum(lengths)[:-1]]
    mean = np.add.reduceat(good * sizes, begin) / np.add.reduceat(sizes, begin)
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def fit(documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> QualityModel:
    """Fit the field by its likelihood (Adam), then the curve on the documents.

    Classes count alike however many documents they have. Without both classes
    the weights stay zero and the score is the same for all.
    """
    width = 2 * _LINE_FEATURES
    if len(documents) == 0 or len(set(labels.tolist())) < 2:
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(width), 0.0, np.zeros((2, 2)), 0.0, 0.0)
    features = np.concatenate([f for f, _ in documents]).astype(np.float64)
    sizes = np.concatenate([s for _, s in documents]).astype(np.float64)
    lengths = np.array([len(s) for _, s in documents])
    truth = np.repeat(labels, lengths)
    balance = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    line_weight = np.repeat(balance / lengths, lengths)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    scaled = np.clip((features - mean) / scale, -6, 6)
    weights, bias, pairs = np.zeros(width), 0.0, np.zeros((2, 2))
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (lengths[labels == label] - 1).sum()
    total = max(seen.sum(), 1.0)
    moment, square = np.zeros(width + 5), np.zeros(width + 5)
    for step in range(1, _STEPS + 1):
        good, counts = marginals(scaled @ weights + bias, lengths, pairs)
        miss = (truth - good) * line_weight
        gradient = np.r_[
            scaled.T @ miss - 1e-3 * weights, miss.sum(), ((seen - counts) / total - 0.05 * pairs).ravel() * 0.2
        ]
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        change = 0.05 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        weights, bias, pairs = weights + change[:width], bias + change[width], pairs + change[width + 1 :].reshape(2, 2)
    raw = _raw(marginals(scaled @ weights + bias, lengths, pairs)[0], sizes, lengths)
    slope, offset = 1.0, 0.0
    for _ in range(500):
        chance = 1 / (1 + np.exp(-(slope * raw + offset)))
        miss = (labels - chance) * balance
        slope, offset = max(slope + 0.5 * (miss * raw).sum(), 0.05), offset + 0.5 * miss.sum()
    return QualityModel(mean, scale, weights, float(bias), pairs, float(slope), float(offset))


def score(model: QualityModel, documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    lengths = np.array([len(s) for _, s in documents])
    scores = model.emissions(np.concatenate([f for f, _ in documents]))
    good, _ = marginals(scores, lengths, model.pairs)
    raw = _raw(good, np.concatenate([s for _, s in documents]), lengths)
    return 1 / (1 + np.exp(-(model.slope * raw + model.offset)))


def train(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on at most ``2 * SAMPLE_PER_CLASS`` labelled documents that are not held out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [line_features(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "features": [f.tobytes() for f, _ in rows],
                    "sizes": [s.astype(np.float32).tobytes() for _, s in rows],
                }
            )

    sample = training_sample(docs, labels, "quality", SAMPLE_PER_CLASS)
    rows = sample.mapInPandas(run, "doc_id long, label int, features binary, sizes binary").toPandas().sort_values("doc_id")
    documents = [
        (np.frombuffer(f, np.float32).reshape(-1, 2 * _LINE_FEATURES), np.frombuffer(s, np.float32))
        for f, s in zip(rows["features"], rows["sizes"])
    ]
    return fit(documents, rows["label"].to_numpy())


def _scored(texts: pd.Series, model: QualityModel) -> np.ndarray:
    parts = []
    for at in range(0, len(texts), _DOCS_AT_ONCE):
        parts.append(score(model, [line_features(text) for text in texts.iloc[at : at + _DOCS_AT_ONCE]]))
    return np.concatenate(parts) if parts else np.empty(0)


def quality_scores(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null text counts as empty, one empty line. Equal texts score alike. An
    empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": _scored(batch["text"], model)}
            )

    rows = id_and_text(docs)
    rows = rows.select("doc_id", "text", is_held_out(rows))
    scored = rows.mapInPandas(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_rejected(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(_scored(texts.fillna(""), model))

    return docs.where(scored(F.col("text")) >= threshold)

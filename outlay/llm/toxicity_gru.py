"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is read in overlapping windows of words, one every ``STRIDE / 2`` words, so
a passage of up to 15 words lies whole in a window wherever it stands. Every
window is scored (windows with equal inputs once) and the highest score counts
for the document. A word enters the network as a few
numbers: what its spelling (word input) and its three-character pieces
(character input) say about the labels of the training documents, how much is
known about it, and its form; a word of more than 60 bytes (text without spaces,
links) is several such inputs, which together hold all its pieces. Two recurrences read the window in both
directions, attention weighs their states, and the weighted sum gives the
window's log-odds.

The word and piece statistics are counted by Spark over a bounded sample of
labelled documents. The network has a few hundred weights and is trained in
numpy on windows of that sample. While training, a document never sees
statistics it took part in: the sample is cut in two halves and each half is
described by the other one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import WorkTables, id_and_text
from outlay.llm.labelled import is_held_out, training_sample
from outlay.llm.shingles import WordHashes, shingle_set

#: Labelled documents per class in the training sample.
SAMPLE_PER_CLASS = 2000
WINDOW = 24
#: Words from a window of a series to the next; a second series starts in the middle, see ``all_windows``.
STRIDE = 20
THRESHOLD = 0.5
HIDDEN = 8
INPUTS = 7
#: Lengths of the character pieces of a word, its ends marked.
PIECE_SIZES = (3, 4, 5)
#: Bytes of a framed word (its ends marked) that are one input; a longer one is several inputs.
LONGEST_INPUT = 62
#: A word or piece counts if chance explains its documents' labels worse than this (G statistic).
LEAST_EVIDENCE = 15.0
_SMOOTHING = 1.0
_LONGEST = 20
_WINDOWS_AT_ONCE = 4096
_REMEMBERED_WORDS = 200_000
_EPOCHS = 150
_WINDOW_MIX = np.random.Generator(np.random.PCG64(24)).integers(0, 2**64, WINDOW, dtype=np.uint64)
_EDGE = b".,;:!?\"'()[]{}*#%&$<>|-_"


def word_form(word: bytes) -> bytes:
    """The word without marks at its ends; a word of marks stays as it is."""
    return word.strip(_EDGE) or word


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


def framed_word(word: bytes) -> bytes:
    return b"^" + word + b"$"


def stretches(framed: bytes) -> list[bytes]:
    """A long framed word in parts that overlap so far that every piece lies whole in one of them."""
    step = LONGEST_INPUT - PIECE_SIZES[-1] + 1
    return [framed[at : at + LONGEST_INPUT] for at in range(0, max(len(framed) - PIECE_SIZES[-1] + 1, 1), step)]


def pieces_of(word: bytes) -> list[bytes]:
    framed = framed_word(word)
    return [framed[i : i + size] for size in PIECE_SIZES for i in range(len(framed) - size + 1)]


@dataclass
class Evidence:
    """Log-odds of words and pieces for the toxic label, each with the number of documents behind it."""

    words: dict[bytes, tuple[float, int]] = field(default_factory=dict)
    pieces: dict[bytes, tuple[float, int]] = field(default_factory=dict)

    def beginnings(self) -> dict[bytes, list[int]]:
        """First signs of known pieces -> the lengths of the pieces that begin so."""
        found: dict[bytes, list[int]] = {}
        for piece in self.pieces:
            found.setdefault(piece[: PIECE_SIZES[0]], []).append(len(piece))
        return {sign: sorted(set(sizes)) for sign, sizes in found.items()}

    def inputs(self, raw: bytes, beginnings: dict[bytes, list[int]]) -> tuple[float, ...]:
        """Numbers of one word; pieces that are not known count as 0."""
        word = word_form(raw)
        return self.described(self.words.get(word), framed_word(word), len(word), beginnings)

    def described(
        self, whole: tuple[float, int] | None, framed: bytes, length: int, beginnings: dict[bytes, list[int]]
    ) -> tuple[float, ...]:
        """The same for (a stretch of) a framed word; ``whole`` is what is known of the word itself."""
        odds, n = whole or (0.0, 0)
        step = PIECE_SIZES[0]
        high = low = total = 0.0
        for i in range(len(framed) - step + 1):
            sizes = beginnings.get(framed[i : i + step])
            if sizes:
                for size in sizes:
                    known = self.pieces.get(framed[i : i + size])
                    if known is not None and i + size <= len(framed):
                        total += known[0]
                        high, low = max(high, known[0]), min(low, known[0])
        count = sum(max(len(framed) - size + 1, 0) for size in PIECE_SIZES) or 1
        return odds / 2, math.log1p(n) / 4, high / 2, low / 2, total / count / 2, min(length, _LONGEST) / _LONGEST, 1.0


class WordTable(dict):
    """word -> row of inputs, computed once per distinct word."""

    def __init__(self, evidence: Evidence) -> None:
        self.evidence, self.beginnings = evidence, evidence.beginnings()
        self._start()

    def _start(self) -> None:
        """Row 0 is no word; the next rows are words of each length that nothing is known about."""
        self.clear()
        self._rows = np.zeros((1024, INPUTS), dtype=np.float32)
        self._rows[1 : 2 + _LONGEST, -2] = np.arange(_LONGEST + 1) / _LONGEST
        self._rows[1 : 2 + _LONGEST, -1] = 1.0
        self._used = 2 + _LONGEST

    @property
    def rows(self) -> np.ndarray:
        return self._rows[: self._used]

    def __missing__(self, word: bytes | tuple) -> int:
        """``word`` as in the text, or what is known of a long word and one of its stretches."""
        step, known = PIECE_SIZES[0], self.beginnings
        if isinstance(word, tuple):
            (whole, framed), length = word, _LONGEST
        else:
            form = word_form(word)
            whole, framed, length = self.evidence.words.get(form), framed_word(form), len(form)
        if whole is None and not any(framed[i : i + step] in known for i in range(len(framed) - step + 1)):
            at = 1 + min(length, _LONGEST)
        else:
            at = self._used
            if at >= len(self._rows):
                self._rows = np.concatenate([self._rows, np.zeros_like(self._rows)])
            self._rows[at] = self.evidence.described(whole, framed, length, known)
            self._used += 1
        self[word] = at
        return at

    def _inputs(self, words: list[bytes]) -> list[bytes | tuple]:
        """Keys of this table: words, and for a long word one key for each stretch of it."""
        if max(map(len, words), default=0) <= LONGEST_INPUT - 2:
            return words
        result: list[bytes | tuple] = []
        for word in words:
            framed = framed_word(word_form(word)) if len(word) > LONGEST_INPUT - 2 else b""
            if len(framed) <= LONGEST_INPUT:
                result.append(word)
            else:
                whole = self.evidence.words.get(framed[1:-1])
                result.extend((whole, part) for part in stretches(framed))
        return result

    def turn(self) -> None:
        if len(self) > _REMEMBERED_WORDS:
            self._start()

    def windows(self, words: list[bytes]) -> np.ndarray:
        """Row numbers of one series of windows, filled up with 0; a text without words is one empty window."""
        return self._series(self._ids(words))

    def all_windows(self, words: list[bytes]) -> np.ndarray:
        """``windows`` and, of a text of more than one, the series that starts half a stride later."""
        ids = self._ids(words)
        if len(ids) <= WINDOW:
            return self._series(ids)
        return np.concatenate([self._series(ids), self._series(ids[STRIDE // 2 :])])

    def _ids(self, words: list[bytes]) -> np.ndarray:
        keys = self._inputs(words)
        return np.fromiter(map(self.__getitem__, keys), dtype=np.int64, count=len(keys))

    @staticmethod
    def _series(ids: np.ndarray) -> np.ndarray:
        count = max(1, -(-(len(ids) - WINDOW) // STRIDE) + 1)
        padded = np.zeros((count - 1) * STRIDE + WINDOW, dtype=np.int64)
        padded[: len(ids)] = ids
        return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights and passes of the network; ``p`` maps a name to its array."""

    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self.p = p

    @staticmethod
    def start(seed: int = 7) -> Network:
        draw = np.random.Generator(np.random.PCG64(seed))
        p = {}
        for way in ("f", "b"):
            p[f"{way}x"] = draw.normal(0, 0.4, (INPUTS, 3 * HIDDEN))
            p[f"{way}h"] = draw.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        p["attend"] = draw.normal(0, 0.5, 2 * HIDDEN)
        p["out"] = draw.normal(0, 0.5, 2 * HIDDEN)
        p["bias"] = np.zeros(1)
        return Network({k: v.astype(np.float32) for k, v in p.items()})

    def _read(self, way: str, gates: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States after each word; gates: (words, windows, 3 * HIDDEN), already multiplied by the input weights."""
        h_weights, n = self.p[f"{way}h"], gates.shape[1]
        state = np.zeros((n, HIDDEN), dtype=np.float32)
        states = np.empty((len(gates), n, HIDDEN), dtype=np.float32)
        steps = []
        for t in range(len(gates)) if way == "f" else range(len(gates) - 1, -1, -1):
            side = state @ h_weights
            reset_update = _sigmoid(gates[t, :, : 2 * HIDDEN] + side[:, : 2 * HIDDEN])
            reset, update = reset_update[:, :HIDDEN], reset_update[:, HIDDEN:]
            fresh = np.tanh(gates[t, :, 2 * HIDDEN :] + reset * side[:, 2 * HIDDEN :])
            if keep:
                steps.append((t, state, side[:, 2 * HIDDEN :], reset, update, fresh))
            state = states[t] = fresh + update * (state - fresh)
        return states, steps

    def _pool(self, states: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = np.where(there, states @ self.p["attend"], -30.0)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        return (weight[:, :, None] * states).sum(axis=0), weight

    def log_odds(self, rows: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Log-odds of each window; ``rows`` holds the inputs of distinct words."""
        tables = {way: rows @ self.p[f"{way}x"] for way in ("f", "b")}
        found = np.empty(len(windows), dtype=np.float32)
        for at in range(0, len(windows), _WINDOWS_AT_ONCE):
            part = windows[at : at + _WINDOWS_AT_ONCE].T
            states = np.concatenate([self._read(way, tables[way][part], False)[0] for way in ("f", "b")], axis=2)
            pooled, _ = self._pool(states, part > 0)
            found[at : at + _WINDOWS_AT_ONCE] = pooled @ self.p["out"] + self.p["bias"]
        return found

    def gradient(self, inputs: np.ndarray, there: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted log-likelihood by backpropagation through time; inputs: (words, windows, INPUTS)."""
        read = {way: self._read(way, inputs @ self.p[f"{way}x"], True) for way in ("f", "b")}
        states = np.concatenate([read["f"][0], read["b"][0]], axis=2)
        pooled, share = self._pool(states, there)
        chance = _sigmoid(pooled @ self.p["out"] + self.p["bias"])
        miss = ((truth - chance) * weight).astype(np.float32)
        grad = {"out": pooled.T @ miss, "bias": np.array([miss.sum()])}
        d_pooled = miss[:, None] * self.p["out"]
        d_share = (states * d_pooled).sum(axis=2)
        d_weight = share * (d_share - (share * d_share).sum(axis=0))
        grad["attend"] = np.tensordot(d_weight, states, axes=([0, 1], [0, 1]))
        d_states = share[:, :, None] * d_pooled + d_weight[:, :, None] * self.p["attend"]
        for number, way in enumerate(("f", "b")):
            own = d_states[:, :, number * HIDDEN : (number + 1) * HIDDEN]
            d_x, d_h = np.zeros_like(self.p[f"{way}x"]), np.zeros_like(self.p[f"{way}h"])
            later = np.zeros_like(own[0])
            for t, before, side, reset, update, fresh in reversed(read[way][1]):
                d = own[t] + later
                d_fresh = d * (1 - update) * (1 - fresh**2)
                d_update = d * (before - fresh) * update * (1 - update)
                d_reset = d_fresh * side * reset * (1 - reset)
                into = np.concatenate([d_reset, d_update, d_fresh], axis=1)
                through = np.concatenate([d_reset, d_update, d_fresh * reset], axis=1)
                d_x += inputs[t].T @ into
                d_h += before.T @ through
                later = d * update + through @ self.p[f"{way}h"].T
            grad[f"{way}x"], grad[f"{way}h"] = d_x, d_h
        return grad

    def trained(self, inputs: np.ndarray, there: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> Network:
        """Ascend the likelihood with Adam over all windows at once."""
        moment = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        p = dict(self.p)
        for step in range(1, _EPOCHS + 1):
            for k, g in Network(p).gradient(inputs, there, truth, weight).items():
                g = g - 1e-4 * p[k]
                moment[k] = 0.9 * moment[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g**2
                change = 0.03 * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)
                p[k] = (p[k] + change).astype(np.float32)
        return Network(p)


@dataclass(frozen=True)
class ToxicityModel:
    evidence: Evidence
    network: Network
    slope: float
    offset: float


def _sketch(text: str) -> int:
    """The smallest shingle hash: near copies mostly share it."""
    found = shingle_set(WordHashes().of(words_of(text)))
    return int(found[0] >> np.uint64(1)) if len(found) else 0


def _apart(work: WorkTables, sample: DataFrame) -> DataFrame:
    """``doc_id, label, half, text``: of near copies with one label one stays, so they count once.

    The halves are cut by the sketch: copies with different labels stay together.
    """

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id", "label", "text"]].assign(sketch=[_sketch(text) for text in batch["text"]])

    sketched = work.keep(sample.mapInPandas(sketch, "doc_id long, label int, text string, sketch long"), "sketched")
    first = sketched.groupBy("sketch", "label").agg(F.min("doc_id").alias("doc_id"))
    half = F.pmod(F.xxhash64("sketch"), F.lit(2)).cast("int").alias("half")
    return work.keep(sketched.join(first, ["sketch", "label", "doc_id"]).select("doc_id", "label", half, "text"), "apart")


def _log_odds(n: list[int], size: list[int]) -> float | None:
    """Log-odds of the label for documents that hold a form, or None if chance may explain them.

    ``n`` and ``size``: clean and toxic documents with the form, and at all.
    """
    expected = [sum(n) * part / max(sum(size), 1) for part in size]
    g = 2 * sum(k * math.log(k / e) for k, e in zip(n, expected) if k)
    if g < LEAST_EVIDENCE or not all(size):
        return None
    # Shrunk toward the classes' own shares, so little evidence says little.
    prior = size[1] / sum(size)
    return math.log((n[1] + _SMOOTHING * prior) / size[1] / ((n[0] + _SMOOTHING * (1 - prior)) / size[0]))


def _evidence(work: WorkTables, sample: DataFrame) -> dict[int, Evidence]:
    """Evidence from each half (0, 1) of the sample and from both (2).

    Only forms of several documents and with log-odds not near zero come to
    the driver; the sample's bound bounds them too.
    """

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [list({word_form(w) for w in words_of(text)}) for text in batch["text"]]
            pieces = [list({p for w in ws for p in pieces_of(w)}) for ws in found]
            yield pd.DataFrame({"half": batch["half"], "label": batch["label"], "words": found, "pieces": pieces})

    described = work.keep(sample.mapInPandas(forms, "half int, label int, words array<binary>, pieces array<binary>"), "forms")
    sizes = {(r["half"], r["label"]): r["n"] for r in described.groupBy("half", "label").agg(F.count("*").alias("n")).collect()}
    result = {half: Evidence() for half in (0, 1, 2)}
    for kind in ("words", "pieces"):
        counted = described.select("half", "label", F.explode(kind).alias("form"))
        sums = [
            F.count(F.when((F.col("half") == half) & (F.col("label") == label), 1)).alias(f"n{half}{label}")
            for half in (0, 1)
            for label in (0, 1)
        ]
        counts = counted.groupBy("form").agg(*sums)
        total = [sum(sizes.get((half, label), 0) for half in (0, 1)) + 1 for label in (0, 1)]
        share = [(F.col(f"n0{label}") + F.col(f"n1{label}") + 0.5) / total[label] for label in (0, 1)]
        telling = counts.where("n00 + n01 + n10 + n11 >= 3").where(F.abs(F.log(share[1] / share[0])) > 0.7)
        for row in telling.toPandas().itertuples():
            for half in (0, 1, 2):
                used = (0, 1) if half == 2 else (half,)
                n = [sum(getattr(row, f"n{h}{label}") for h in used) for label in (0, 1)]
                odds = _log_odds(n, [sum(sizes.get((h, label), 0) for h in used) for label in (0, 1)])
                if odds is not None:
                    getattr(result[half], kind)[bytes(row.form)] = (odds, sum(n))
    return result


def _training_windows(sample: DataFrame, evidence: dict[int, Evidence]) -> pd.DataFrame:
    """For each sample document its most telling window and one more, as inputs by the other half."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = {half: WordTable(evidence[1 - half]) for half in (0, 1)}
        for batch in batches:
            rows = []
            for doc_id, label, half, text in zip(batch["doc_id"], batch["label"], batch["half"], batch["text"]):
                table = tables[half]
                table.turn()
                windows = table.all_windows(words_of(text))
                inputs = table.rows[windows]
                best = int(inputs[:, :, [0, 2]].max(axis=(1, 2)).argmax())
                for at in {best, (best + 1 + doc_id % max(1, len(windows) - 1)) % len(windows)} if label == 0 else {best}:
                    rows.append((doc_id, label, inputs[at].tobytes(), (windows[at] > 0).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "label", "inputs", "there"])

    return sample.mapInPandas(run, "doc_id long, label int, inputs binary, there binary").toPandas()


def _distinct(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows, and the number among them of each window; equal hashes are compared in full."""
    mixed = windows.astype(np.uint64) @ _WINDOW_MIX
    _, first, which = np.unique(mixed, return_index=True, return_inverse=True)
    distinct = windows[first]
    if not np.array_equal(distinct[which], windows):
        return windows, np.arange(len(windows))
    return distinct, which


def _highest(texts: pd.Series, table: WordTable, network: Network) -> np.ndarray:
    """The highest log-odds of each text's windows; many texts go through the network together."""
    result = np.empty(len(texts), dtype=np.float64)
    waiting: list[np.ndarray] = []
    first = 0

    def flush(end: int) -> None:
        nonlocal first
        if waiting:
            counts = np.array([len(w) for w in waiting])
            distinct, which = _distinct(np.concatenate(waiting))
            odds = network.log_odds(table.rows, distinct)[which]
            result[first:end] = np.maximum.reduceat(odds, np.r_[0, np.cumsum(counts)[:-1]])
            waiting.clear()
        first = end
        table.turn()

    held = 0
    for at, text in enumerate(texts):
        waiting.append(table.all_windows(words_of(text)))
        held += len(waiting[-1])
        if held > 4 * _WINDOWS_AT_ONCE:
            flush(at + 1)
            held = 0
    flush(len(texts))
    return result


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on at most ``2 * SAMPLE_PER_CLASS`` labelled documents that are not held out.

    Without both classes nothing is known: the model scores every text 0.
    """
    work = WorkTables(docs.sparkSession, "toxicity")
    sample = _apart(work, training_sample(docs, labels, "toxic", SAMPLE_PER_CLASS))
    if sample.select("label").distinct().count() < 2:
        return ToxicityModel(Evidence(), Network.start(), 0.0, -40.0)
    evidence = _evidence(work, sample)
    rows = _training_windows(sample, evidence).sort_values(["doc_id", "inputs"], kind="stable")
    inputs = np.stack([np.frombuffer(x, np.float32).reshape(WINDOW, INPUTS) for x in rows["inputs"]]).transpose(1, 0, 2)
    there = np.stack([np.frombuffer(x, np.bool_) for x in rows["there"]]).T
    truth = rows["label"].to_numpy().astype(np.float32)
    weight = np.where(truth == 1, 0.5 / max((truth == 1).sum(), 1), 0.5 / max((truth == 0).sum(), 1)).astype(np.float32)
    network = Network.start().trained(np.ascontiguousarray(inputs), there, truth, weight)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odds = np.empty(len(batch))
            for half in (0, 1):
                at = (batch["half"] == half).to_numpy()
                odds[at] = _highest(batch["text"][at], WordTable(evidence[1 - half]), network)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "odds": odds})

    seen = sample.mapInPandas(run, "doc_id long, label int, odds double").toPandas().sort_values("doc_id")
    slope, offset = _curve(seen["odds"].to_numpy(), seen["label"].to_numpy())
    return ToxicityModel(evidence[2], network, slope, offset)


def _curve(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from a document's highest log-odds, classes counting alike."""
    weight = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    slope, offset = 1.0, 0.0
    for _ in range(2000):
        miss = (labels - 1 / (1 + np.exp(-np.clip(slope * odds + offset, -40, 40)))) * weight
        slope, offset = max(slope + 0.3 * (miss * odds).sum(), 0.05), offset + 0.3 * miss.sum()
    return float(slope), float(offset)


def toxicity_scores(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null text counts as empty, one window without words. Equal texts score
    alike. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        table = WordTable(model.evidence)
        for batch in batches:
            odds = _highest(batch["text"], table, model.network)
            chance = 1 / (1 + np.exp(-np.clip(model.slope * odds + model.offset, -40, 40)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": chance})

    rows = id_and_text(docs)
    rows = rows.select("doc_id", "text", is_held_out(rows))
    scored = rows.mapInPandas(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

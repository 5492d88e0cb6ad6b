"""Language identification by error-correcting output codes.

Every language has a codeword. For every bit a binary classifier over byte
n-grams tells languages with a one from those with a zero. A text's bits are
decoded with weighted losses: the language whose codeword costs least wins,
where a bit counts for a language as far as its classifier was right about
that language in training. If the second-best codeword costs almost as little,
the text is flagged as ambiguous.

n-gram counts are summed by Spark over a bounded sample per language; the
driver turns the language-by-bucket table (fixed size) into bit weights.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import WorkTables, doc_bucket, id_and_text
from outlay.llm.labelled import smallest_hashes

#: Training documents per language.
SAMPLE_PER_LANGUAGE = 2000
BUCKETS = 1 << 15
GRAM_SIZES = (2, 3, 4)
#: Up to this many languages every split of the languages is a bit.
MOST_EXHAUSTIVE = 6
#: Costs closer than this share of the runner-up's are ambiguous.
AMBIGUOUS_GAP = 0.15
UNDETERMINED = "und"
_CHUNK_BYTES = 1 << 18
_LETTER = regex.compile(r"\p{L}")


def codewords(languages: int) -> np.ndarray:
    """One row of -1 and 1 per language; columns are distinct splits.

    Few languages get all splits; more get the random code, among fixed
    draws, whose closest rows are farthest apart.
    """
    if languages <= MOST_EXHAUSTIVE:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=max(languages - 1, 0)) if -1 in rest]
        return np.array(splits, dtype=np.int8).reshape(len(splits), languages).T
    draw = np.random.Generator(np.random.PCG64(languages))
    bits = int(np.ceil(12 * np.log2(languages)))
    best, apart = None, -1
    for _ in range(50):
        code = draw.choice(np.array([-1, 1], dtype=np.int8), (languages, bits))
        if (np.abs(code.sum(axis=0)) == languages).any():
            continue
        agreement = code.astype(np.int32) @ code.T - 2 * bits * np.eye(languages, dtype=np.int32)
        distance = (bits - agreement.max()) // 2
        if distance > apart:
            best, apart = code, distance
    return best


def _letters_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[:33] = 32
    table[ord("A") : ord("Z") + 1] += 32
    table[ord("0") : ord("9") + 1] = ord("0")
    return table


_FOLDED = _letters_table()


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each n-gram size the buckets at every byte of all texts, and where each text begins.

    Texts are set apart by blanks, more than the longest n-gram can bridge.
    """
    encoded = [b"    " + text.encode() for text in texts]
    begin = np.r_[0, np.cumsum([len(e) for e in encoded])[:-1]].astype(np.int64)
    data = _FOLDED[np.frombuffer(b"".join(encoded) + b"    ", dtype=np.uint8)].astype(np.uint32)
    n = len(data) - 4
    found = []
    rolled = data[:n]
    for size in range(2, max(GRAM_SIZES) + 1):
        rolled = rolled * np.uint32(0x01000193) + data[size - 1 : n + size - 1]
        if size in GRAM_SIZES:
            found.append(((rolled * np.uint32(0x9E3779B1) + np.uint32(size * 0x01ED270B)) >> np.uint32(17)).astype(np.int64))
    return found, begin


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``_CHUNK_BYTES`` together; a longer text is its own run."""
    first, held = 0, 0
    for at, text in enumerate(texts):
        held += len(text)
        if held >= _CHUNK_BYTES:
            yield first, at + 1
            first, held = at + 1, 0
    if first < len(texts):
        yield first, len(texts)


def margins(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Mean n-gram weight of each text for each bit."""
    result = np.empty((len(texts), weights.shape[1]))
    for first, end in _chunks(texts):
        found, begin = grams(texts[first:end])
        lengths = np.diff(np.r_[begin, len(found[0])])
        total = sum(np.add.reduceat(weights[buckets], begin, axis=0) for buckets in found)
        result[first:end] = total / (len(found) * lengths)[:, None]
    return result


@dataclass(frozen=True)
class LanguageModel:
    """Languages, their codewords, n-gram weights per bit, each bit's slope and offset, and bit weights per language."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    slope: np.ndarray
    offset: np.ndarray
    trust: np.ndarray

    def decode(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score (0 to 1), and whether the runner-up is close."""
        n, k = len(raw), len(self.languages)
        if k == 1:
            return np.zeros(n, dtype=int), np.ones(n), np.zeros(n, dtype=bool)
        bits = np.clip(raw * self.slope + self.offset, -6, 6)
        cost = np.stack([(np.exp(-bits * self.code[i]) * self.trust[i]).sum(axis=1) for i in range(k)], axis=1)
        order = np.argsort(cost, axis=1, kind="stable")
        least, second = (np.take_along_axis(cost, order[:, i : i + 1], axis=1)[:, 0] for i in (0, 1))
        share = 1 / np.maximum(cost, 1e-9)
        score = np.take_along_axis(share, order[:, :1], axis=1)[:, 0] / share.sum(axis=1)
        return order[:, 0], score, (second - least) < AMBIGUOUS_GAP * second


def _sample(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, text``: per language the documents of smallest id hash, none of the held-out ones."""
    known = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].alias("lang"), docs["text"].alias("text"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (doc_bucket(F.col("doc_id"), 4) != 2))
    chosen = smallest_hashes(known.select("doc_id", "lang"), "lang", SAMPLE_PER_LANGUAGE)
    # Two numbers for each of at most SAMPLE_PER_LANGUAGE documents per language.
    return known.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")


def train(docs: DataFrame) -> LanguageModel:
    """Learn from text and non-null lang of documents outside the held-out quarter."""
    work = WorkTables(docs.sparkSession, "language")
    sample = work.keep(_sample(docs), "sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                texts = group["text"].tolist()
                total = totals.setdefault(lang, np.zeros(BUCKETS))
                for first, end in _chunks(texts):
                    for buckets in grams(texts[first:end])[0]:
                        total += np.bincount(buckets, minlength=BUCKETS)
        for lang, total in totals.items():
            some = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": some, "n": total[some]})

    counted = sample.mapInPandas(count, "lang string, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    languages = sorted(table["lang"].unique().tolist())
    counts = np.zeros((len(languages), BUCKETS))
    counts[table["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(dtype=int), table["bucket"].to_numpy(dtype=int)] = table["n"]
    code = codewords(len(languages))
    bits = code.shape[1] if len(languages) > 1 else 0
    rates = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    weights = np.zeros((BUCKETS, bits), dtype=np.float32)
    for j in range(bits):
        weights[:, j] = np.log(rates[code[:, j] > 0].mean(axis=0) / rates[code[:, j] < 0].mean(axis=0))
    if not bits:
        return LanguageModel(languages, code, weights, np.ones(0), np.zeros(0), np.ones((len(languages), 0)))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "raw": list(margins(batch["text"].tolist(), weights))})

    seen = sample.mapInPandas(measure, "lang string, raw array<double>").groupBy("lang")
    # Moments per language and bit are all the curves and the trust need.
    moments = seen.agg(
        F.count("*").alias("n"),
        *[F.avg(F.col("raw")[j]).alias(f"mean{j}") for j in range(bits)],
        *[F.stddev_pop(F.col("raw")[j]).alias(f"spread{j}") for j in range(bits)],
    ).toPandas().set_index("lang").reindex(languages)
    mean = np.stack([moments[f"mean{j}"].to_numpy() for j in range(bits)], axis=1)
    spread = np.stack([moments[f"spread{j}"].to_numpy() for j in range(bits)], axis=1) + 1e-3
    high = np.stack([mean[code[:, j] > 0, j].mean() for j in range(bits)])
    low = np.stack([mean[code[:, j] < 0, j].mean() for j in range(bits)])
    slope = 6 / np.maximum(high - low, 1e-6)
    offset = -slope * (high + low) / 2
    # How far, in spreads, a language's texts lie on the right side of each bit's border.
    safety = code * (mean * slope + offset) / (spread * slope)
    trust = np.clip(safety, 0.05, 3)
    return LanguageModel(languages, code, weights, slope, offset, trust / trust.sum(axis=1, keepdims=True))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, ambiguous.

    A null text, or one without any letter, is ``und`` with score 0, and so is
    every text if no language was learned. Ties go to the language first in
    the alphabet. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            texts = batch["text"].tolist()
            known = [i for i, text in enumerate(texts) if model.languages and _LETTER.search(text)]
            pred, score, close = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
            if known:
                raw = margins([texts[i] for i in known], model.weights) if len(model.languages) > 1 else np.zeros((len(known), 0))
                found, score[known], close[known] = model.decode(raw)
                for i, at in zip(known, found):
                    pred[i] = model.languages[at]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": pred, "score": score, "ambiguous": close}
            )

    rows = id_and_text(docs)
    rows = rows.select("doc_id", "text", (doc_bucket(rows["doc_id"], 4) == 2).alias("held_out"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")

"""Spelling variants of words, found by pivotal grams.

Two words are near if one inserted, deleted or replaced character leads from
one to the other. All bigrams have one order, rare ones first. The prefix of a
word are its three first bigrams in that order, with all places of the last
one. Three bigrams hold two that do not overlap; dynamic programming chooses
the two of least total frequency: the pivots.

One edit destroys at most one of two bigrams that do not overlap. So if the
last prefix bigram of word s does not come after that of word r, a pivot of s
stands in r; it comes no later than r's last prefix bigram, hence it is in r's
prefix. Pivots are therefore joined with prefixes, in one direction only.

The position limit is strict: the edit lies on one side of the surviving
bigram, and everything on its other side stays as it is, the distance to that
end of the word included. So a pivot meets equal bigrams with an equal
beginning up to it, or an equal end from it on. The join compares lengths,
letters and at last the edit distance, and only near words leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import WorkTables

#: What a run is made of, which occurrences lose a character, which words count, how much commoner a form is.
RUN = "[A-Za-zÀ-ÿ]+"
NOISE = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_FACTOR = 5
GRAM = 2
PIVOTS = 2
_PREFIX = GRAM * (PIVOTS - 1) + 1


def words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the distinct words of whole texts with their occurrences, as combined by every task first."""
    low = F.translate(docs["text"], ascii_uppercase, ascii_lowercase)
    doc = F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(":"))
    runs = docs.select(doc.alias("doc"), F.explode(F.regexp_extract_all(low, F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    # One of them may be lost, so shorter runs cannot become words.
    runs = runs.where(F.length("run") >= least_length)
    runs = runs.withColumn("h", F.crc32(F.concat("doc", "run")))
    at = F.pmod("h", F.length("run")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.pmod("h", F.lit(NOISE)) == 0, lost).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def gram_order(vocabulary: DataFrame) -> dict[str, int]:
    """How often each bigram occurs in the vocabulary; 90 letters make at most 8,100 of them."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = vocabulary.select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(GRAM)))).alias("gram"))
    return {row["gram"]: row["n"] for row in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()}


def prefix_places(word: str, frequency: dict[str, int]) -> tuple[list[int], tuple[int, str]]:
    """The places of a word's prefix bigrams, ascending, and the last bigram in the order."""
    ranked = sorted((frequency[word[i : i + GRAM]], word[i : i + GRAM]) for i in range(len(word) - GRAM + 1))
    last = ranked[min(_PREFIX, len(ranked)) - 1]
    return [i for i in range(len(word) - GRAM + 1) if (frequency[word[i : i + GRAM]], word[i : i + GRAM]) <= last], last


def pivots(word: str, places: list[int], frequency: dict[str, int], wanted: int = PIVOTS) -> list[int]:
    """``wanted`` of the places whose bigrams do not overlap, of least total frequency, ties leftmost."""
    best: list[list[tuple[int, list[int]] | None]] = [[(0, [])] * (len(places) + 1)]
    for _ in range(wanted):
        row: list[tuple[int, list[int]] | None] = [None]
        for k, place in enumerate(places):
            # The bigrams before this one that end no later than it begins.
            free = max((j + 1 for j in range(k) if places[j] + GRAM <= place), default=0)
            before = best[-1][free]
            taken = before and (before[0] + frequency[word[place : place + GRAM]], [*before[1], place])
            row.append(min((option for option in (row[-1], taken) if option), default=None))
        best.append(row)
    found = best[-1][-1]
    if found is None:
        raise ValueError(f"{word!r} has no {wanted} bigrams that do not overlap")
    return found[1]


def letters(word: str) -> int:
    """Which letters occur an odd number of times (letters share 64 bits): one edit changes at most two bits."""
    bits = 0
    for letter in word:
        bits ^= 1 << (ord(letter) % 64)
    return bits - (1 << 64) if bits >> 63 else bits


def index(vocabulary: DataFrame) -> DataFrame:
    """``key, pivot, last, word, n, letters``: each prefix bigram of a word with its beginning, and with its end."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(gram_order(vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequency = shared.value
        for batch in batches:
            rows = []
            for word, n in zip(batch["word"], batch["n"]):
                places, (count, gram) = prefix_places(word, frequency)
                chosen = pivots(word, places, frequency)
                last, bits = f"{count:020d}{gram}", letters(word)
                for place in places:
                    is_pivot = place in chosen
                    rows.append((f"<{word[: place + GRAM]}", is_pivot, last, word, n, bits))
                    rows.append((f">{word[place:]}", is_pivot, last, word, n, bits))
            yield pd.DataFrame(rows, columns=["key", "pivot", "last", "word", "n", "letters"])

    return vocabulary.mapInPandas(run, "key string, pivot boolean, last string, word string, n long, letters long")


def near_words(work: WorkTables, vocabulary: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: all pairs of near words, in both directions."""
    indexed = work.keep(index(vocabulary), "index")
    left = indexed.where("pivot").select("key", *[F.col(c).alias(f"{c}_1") for c in ("last", "word", "n", "letters")])
    right = indexed.select("key", *[F.col(c).alias(f"{c}_2") for c in ("last", "word", "n", "letters")])
    near = (
        (F.col("last_1") <= F.col("last_2"))
        & (F.abs(F.length("word_1") - F.length("word_2")) <= 1)
        & (F.bit_count(F.col("letters_1").bitwiseXOR(F.col("letters_2"))) <= 2)
        & (F.levenshtein("word_1", "word_2", 1) == 1)
    )
    joined = left.withColumnRenamed("key", "key_1").join(right, (F.col("key_1") == F.col("key")) & near)
    first = F.struct(F.col("word_1").alias("word"), F.col("n_1").alias("n"))
    second = F.struct(F.col("word_2").alias("word"), F.col("n_2").alias("n"))
    # Two words can meet at several keys.
    pairs = joined.select(F.least(first, second).alias("a"), F.greatest(first, second).alias("b")).distinct()
    pairs = work.keep(pairs, "near")

    def directed(one: str, other: str) -> DataFrame:
        return pairs.select(
            F.col(f"{one}.word").alias("word"),
            F.col(f"{one}.n").alias("n"),
            F.col(f"{other}.word").alias("other"),
            F.col(f"{other}.n").alias("other_n"),
        )

    return directed("a", "b").unionByName(directed("b", "a"))


def _roots(work: WorkTables, forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms lead. A form is five times as common, so paths are short; each round doubles the step."""
    step = work.keep(forms.select("word", F.col("form").alias("root")), "step")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = work.keep(step.join(ahead, "root", "left"), "moved")
        if not moved.where("ahead IS NOT NULL").head(1):
            return step
        step = moved.select("word", F.coalesce("ahead", "root").alias("root"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    ``form`` is the most frequent near word (ties: the first in code-point
    order) if it is at least five times as frequent, else null; ``root`` is
    where following the forms ends. Null and empty texts have no words; a null
    doc_id counts as empty text in the hash of an occurrence. Repeated rows
    count each. An empty table gives no rows.
    """
    work = WorkTables(docs.sparkSession, "spelling")
    vocabulary = work.keep(words(docs), "words")
    best: Column = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other")))
    grouped = near_words(work, vocabulary).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.rank") >= FORM_FACTOR * F.col("n")
    found = work.keep(
        grouped.select(
            "word",
            "n_near",
            F.when(is_form, F.col("best.other")).alias("form"),
            F.when(is_form, -F.col("best.rank")).alias("form_n"),
        ),
        "found",
    )
    roots = _roots(work, found.where("form IS NOT NULL"))
    return (
        vocabulary.join(found, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )

"""Phrases whose words keep together, mined from stripes.

A stripe is the counter of the words that follow one prefix. Tasks build the
stripes of their texts, and stripes of one prefix are merged by adding them
element by element. One level of stripes holds the prefixes of one length:

- the stripe of the empty prefix counts words; its sum is n;
- an entry of a stripe is f(prefix and word), so entries of at least
  ``LEAST`` are the candidates one word longer (extensions);
- so the total of a prefix is its entry one level below (prefix totals), and
  places where no word follows that may be frequent need no counter: their
  number grows faster than the input, as ever more prefixes reach ``LEAST``;
- the largest entry of a stripe is what a phrase's continuation reaches, and
  the largest entry over all first words what its beginnings reach. A phrase
  inside a longer one as frequent as itself is also inside one that is one word
  longer and as frequent, so these two maxima decide (subsumption maxima).

A phrase is only as frequent as its parts, so the next level reads the texts
again and builds stripes where prefix and last words are frequent; a bit field
of fixed size tells that early, and a false yes changes no count that is used.

A frequent prefix has a long stripe. It is split by its next words into parts
of at most about 1/4096 of all words, which are merged apart; only frequent
entries stay in a merged part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outlay.llm.bit_filter import bit_field
from outlay.llm.common import WorkTables
from outlay.llm.word_stripes import LONGEST, SHARES, WORDS_AT_ONCE, Hot, Stripes, gram_hashes, word_hash

#: Least occurrences of a candidate, phrases reported per language, factor of the score.
LEAST = 100
PER_LANGUAGE = 2000
SCALE = 1000
_SALTS = 16


def _partial(texts: DataFrame, length: int, known: Broadcast | None) -> DataFrame:
    """``lang, prefix, part, next, n``: stripes of what each task has read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, hot = known.value if known is not None else (None, None)
        open_stripes: dict[str, Stripes] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                stripes = open_stripes.get(lang)
                if stripes is None:
                    stripes = open_stripes[lang] = Stripes(lang, length, frequent, hot, ends=False)
                stripes.add(text.as_py())
                if stripes.full():
                    yield from stripes.flush()
            # Many languages must not add up.
            if sum(stripes.count for stripes in open_stripes.values()) > 2 * WORDS_AT_ONCE:
                for stripes in open_stripes.values():
                    yield from stripes.flush()
        for stripes in open_stripes.values():
            yield from stripes.flush()

    return texts.mapInArrow(run, "lang string, prefix string, part int, next array<string>, n array<int>")


def _merged(partial: DataFrame, least: int) -> DataFrame:
    """``lang, prefix, part, total, next, n``: stripes added element by element; entries below ``least`` only in the total.

    Partial stripes travel whole; after that one exchange the sums need no other.
    """
    dealt = partial.repartition("lang", "prefix", "part")
    entries = dealt.select("lang", "prefix", "part", F.explode(F.arrays_zip("next", "n")).alias("entry"))
    added = entries.groupBy("lang", "prefix", "part", F.col("entry.next").alias("word")).agg(F.sum("entry.n").alias("n"))
    kept = F.when((F.col("n") >= least) & (F.col("word") != ""), F.struct("word", "n"))
    return added.groupBy("lang", "prefix", "part").agg(F.sum("n").alias("total"), F.collect_list(kept).alias("entries"))


def _grams(merged: DataFrame) -> DataFrame:
    """``lang, phrase, f`` of the frequent entries."""
    entries = merged.select("lang", "prefix", F.explode("entries").alias("entry"))
    phrase = F.when(F.col("prefix") == "", F.col("entry.word")).otherwise(F.concat_ws(" ", "prefix", "entry.word"))
    return entries.select("lang", phrase.alias("phrase"), F.col("entry.n").alias("f"))


def _phrase_hash(phrase: str, lang: str) -> int:
    words = np.array([word_hash(word, lang) for word in phrase.encode().split(b" ")], dtype=np.uint64)
    return int(gram_hashes(words, len(words))[0])


def _known(grams: DataFrame, total: int) -> tuple[np.ndarray, Hot]:
    """What the next level knows of this one: a bit field over the phrases, and the hot ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_phrase_hash(phrase, lang) for lang, phrase in zip(batch["lang"], batch["phrase"])]
            yield pd.DataFrame({"hash": np.array(found, dtype=np.uint64).view(np.int64)})

    field = bit_field(grams.select("lang", "phrase").mapInPandas(run, "hash long"), "hash")
    # Phrases of one length have at most ``total`` places together, so these are at most SHARES.
    hot = grams.where(F.col("f") * SHARES >= total).collect() if total else []
    return field, Hot([_phrase_hash(row["phrase"], row["lang"]) for row in hot], [row["f"] for row in hot], total)


def collocations(docs: DataFrame, least: int = LEAST, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Per language the best phrases: lang, rank, phrase, a, l, r, n, score.

    Null lang is ``und``; null and empty texts have no words and add nothing.
    Rows count each, repeated ones and those without id too. Ties of the score
    go to the more frequent phrase, then to the smaller one in UTF-8 order. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    work = WorkTables(spark, "collocations")
    texts = docs.select(F.coalesce(docs["lang"], F.lit("und")).alias("lang"), docs["text"]).where("text <> ''")
    levels: list[DataFrame] = []
    grams: list[DataFrame] = []
    known = None
    for length in range(LONGEST):
        levels.append(work.keep(_merged(_partial(texts, length, known), least), f"stripes{length}"))
        grams.append(_grams(levels[-1]))
        if length == 0:
            n = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))
            all_words = n.agg(F.sum("n")).first()[0] or 0
        if length < LONGEST - 1:
            known = spark.sparkContext.broadcast(_known(grams[-1], all_words))  # 8 MiB and at most SHARES pairs

    counts = reduce(DataFrame.unionByName, grams)
    totals = reduce(DataFrame.unionByName, grams[:-1]).select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    candidates = reduce(DataFrame.unionByName, grams[1:]).withColumn("words", F.split("phrase", " "))

    # The largest entry of a phrase's own stripe, and of all stripes that lead to it from a word before.
    right = reduce(DataFrame.unionByName, levels[2:]).select("lang", F.col("prefix").alias("phrase"), F.array_max("entries.n").alias("f"))
    left = reduce(DataFrame.unionByName, grams[2:]).select("lang", F.substring_index("phrase", " ", 1).alias("head"), "phrase", "f")
    left = left.select("lang", F.expr("substring(phrase, length(head) + 2)").alias("phrase"), "f")
    reached = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("f").alias("reached"))
    open_candidates = (
        candidates.join(reached, ["lang", "phrase"], "left").where("reached IS NULL OR reached < f").drop("reached")
    )
    cuts = open_candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        "k",
        F.concat_ws(" ", F.slice("words", F.lit(1), F.col("k"))).alias("first"),
        F.concat_ws(" ", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))).alias("rest"),
    )
    cuts = cuts.join(totals, ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(n, "lang")
    score = F.expr(f"({SCALE} * CAST(a AS DECIMAL(38, 0)) * CAST(n AS DECIMAL(20, 0))) div (CAST(l AS DECIMAL(20, 0)) * CAST(r AS DECIMAL(18, 0)))")
    scored = cuts.select("lang", "phrase", "a", "n", "l", "r", "k", score.alias("score"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rows = lowest.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    for keys in (["lang", "salt"], ["lang"]):  # the last one sees at most _SALTS * per_language rows of a language
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        rows = rows.withColumn("salt", salt).withColumn("rank", rank).where(F.col("rank") <= per_language)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

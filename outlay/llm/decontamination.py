"""Benchmark decontamination by spaced-seed hashing.

A spaced seed is the hash of a window of words from which fixed masks leave out
some positions, so a window that differs there still hits. Benchmark windows
and document windows are joined on their seeds; around each hit document and
item are compared word by word along the hit's diagonal (document position
minus item position), where substituted words only cost their own place.

A document is contaminated by an item if at least 75 percent of the item's
words agree on the hit diagonals together, or if 20 words in a row of one
diagonal contain 15 that agree (a quoted part of a longer item).

The masks alone miss diagonals on which every few words differ, so a light seed
finds each diagonal that satisfies the rule by itself, without exception (up to
hash collisions). Of at least 10 words of which at most a quarter differ, three
in a row agree (at most m of n differ, and (n - m) / (m + 1) > 2); an item can
be cut into blocks of 10 to 19 words, one of which is such a place, and 20 words
with 15 that agree are one. Of the 23 words around those three (10 on each side)
at least 8 agree in either case. Only pairs that reach this leave the join; they
count if their diagonal alone satisfies the rule.

An item of fewer than 10 words counts if all its words stand in the document in
a row: such windows of the document are joined on the hash of the whole item.

Words are lower-cased runs of letters and digits; of scripts written without
spaces every letter is a word. Everything is built-in
column work: the window hashes are made inside one generated stage, and
documents never move. The seeds of the benchmark are broadcast in blocks of
at most ``BLOCK_SEEDS`` rows, whatever the benchmark's size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import WorkTables

#: Fixed masks over ten words; a seed keeps the positions with a 1.
MASKS = ("1110110101", "1101011011", "1011101101")
SPAN = 10
BLOCK_SEEDS = 1_000_000
#: What tells a text: rows that agree in both are the same text of the same document.
TEXT = ("doc_id", "digest")
#: Letters of scripts written without spaces.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
#: They all begin with this character or later.
LATER_SCRIPTS = r"[\x{0E00}-\x{10FFFF}]"
AGREEING_PERCENT = 75
STRETCH_WORDS = 20
STRETCH_AGREEING = 15
#: The light seed: words in a row, words looked at on each side, and how many of those agree at least.
LIGHT_SPAN = 3
LIGHT_SIDE = 10
LIGHT_AGREEING = 8 - LIGHT_SPAN


def _word_hashes(text: Column) -> Column:
    """64-bit hashes of the words of a text, in order; null and wordless texts have none."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    # Asking for scripts is slow, and most texts have no character from where these scripts begin.
    unspaced = lower.rlike(LATER_SCRIPTS) & lower.rlike(UNSPACED)
    apart = F.when(unspaced, F.regexp_replace(lower, f"({UNSPACED})", " $1 ")).otherwise(lower)
    words = F.split(apart, r"[^a-z0-9\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda word: word != ""), lambda word: F.xxhash64(word))


def _digest(text: Column) -> Column:
    """Tells the texts of one doc_id, or of none, apart."""
    return F.concat_ws("-", F.xxhash64(text), F.xxhash64(F.lit(1), text))


def _windows(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, window start ``at`` and ``seed`` for every window and mask of ``h``."""
    starts = F.sequence(F.lit(0), F.size("h") - SPAN)
    placed = rows.where(F.size("h") >= SPAN).select(*keep, "h", F.explode(starts).alias("at"))
    seeds = [
        F.xxhash64(F.lit(number), *[F.col("h")[F.col("at") + i] for i, bit in enumerate(mask) if bit == "1"])
        for number, mask in enumerate(MASKS)
    ]
    return placed.select(*keep, "h", "at", F.explode(F.array(*seeds)).alias("seed"))


def _items(work: WorkTables, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct items as word hashes (``item``, ``h``), and which item_id is which (``item_id``, ``item``)."""
    hashed = work.keep(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), _word_hashes(F.col("text")).alias("h")), "benchmark"
    )
    named = hashed.select("item_id", F.xxhash64("h").alias("k1"), F.xxhash64(F.lit(1), "h").alias("k2"), "h")
    groups = named.groupBy("k1", "k2").agg(F.first("h").alias("h"))
    # Numbered and written, so the numbers stay; an item needs no id.
    groups = work.keep(groups.withColumn("item", F.monotonically_increasing_id()), "items")
    return groups.select("item", "h"), named.join(groups.select("k1", "k2", "item"), ["k1", "k2"]).select("item_id", "item")


def _hits(docs: DataFrame, items: DataFrame, work: WorkTables) -> DataFrame:
    """``doc_id, digest, item, diagonal, part``: hit diagonals, with the document's words along the item."""
    seeds = _windows(items, "item").select("item", F.col("at").alias("item_at"), F.size("h").alias("item_words"), "seed")
    seeds = work.keep(seeds, "seeds")
    blocks = max(1, -(-seeds.count() // BLOCK_SEEDS))
    windows = _windows(docs, *TEXT)
    found = []
    for block in range(blocks):
        part = seeds.where(F.pmod("seed", F.lit(blocks)) == block)
        joined = windows.join(F.broadcast(part), "seed")
        diagonal = F.col("at") - F.col("item_at")
        begin = F.greatest(diagonal, F.lit(0))
        length = F.least(diagonal + F.col("item_words"), F.size("h")) - begin
        found.append(
            joined.select(*TEXT, "item", diagonal.alias("diagonal"), F.slice("h", begin + 1, length).alias("part"))
        )
    return reduce(DataFrame.unionByName, found)


def _light_seed(at: Column) -> Column:
    return F.xxhash64(F.lit(-1), *[F.get(F.col("h"), at + i) for i in range(LIGHT_SPAN)])


def _around(at: Column) -> list[Column]:
    """The words on both sides of a light seed; null outside the text."""
    places = [*range(-LIGHT_SIDE, 0), *range(LIGHT_SPAN, LIGHT_SPAN + LIGHT_SIDE)]
    return [F.get(F.col("h"), at + i) for i in places]


def _light_hits(docs: DataFrame, items: DataFrame, work: WorkTables) -> DataFrame:
    """The same for pairs whose words around three equal ones mostly agree."""
    starts = F.explode(F.sequence(F.lit(0), F.size("h") - LIGHT_SPAN)).alias("at")
    placed = items.where(F.size("h") >= SPAN).select("item", "h", starts)
    seeds = work.keep(
        placed.select(
            "item",
            F.col("at").alias("item_at"),
            F.size("h").alias("item_words"),
            F.array(*_around(F.col("at"))).alias("around"),
            _light_seed(F.col("at")).alias("seed"),
        ),
        "light-seeds",
    )
    blocks = max(1, -(-4 * seeds.count() // BLOCK_SEEDS))  # their rows are longer
    windows = docs.where(F.size("h") >= LIGHT_SPAN).select(*TEXT, "h", starts)
    windows = windows.select(*TEXT, "h", "at", _light_seed(F.col("at")).alias("seed"))
    # Written out word by word, so that it stays generated code inside the join.
    equal = [F.coalesce(w == F.col("around")[i], F.lit(False)).cast("int") for i, w in enumerate(_around(F.col("at")))]
    found = []
    for block in range(blocks):
        part = seeds.where(F.pmod("seed", F.lit(blocks)) == block).withColumnRenamed("seed", "item_seed")
        near = (F.col("seed") == F.col("item_seed")) & (reduce(Column.__add__, equal) >= LIGHT_AGREEING)
        joined = windows.join(F.broadcast(part), near)
        diagonal = F.col("at") - F.col("item_at")
        begin = F.greatest(diagonal, F.lit(0))
        length = F.least(diagonal + F.col("item_words"), F.size("h")) - begin
        found.append(
            joined.select(*TEXT, "item", diagonal.alias("diagonal"), F.slice("h", begin + 1, length).alias("part"))
        )
    return reduce(DataFrame.unionByName, found)


def _short_hits(docs: DataFrame, items: DataFrame, work: WorkTables) -> DataFrame:
    """``doc_id, digest, item, diagonal, part`` for items of fewer than ``SPAN`` words that stand whole in a document.

    The diagonal is 0 and the part the item's own words, whatever their place.
    """
    short = items.where(F.size("h").between(1, SPAN - 1))
    lengths = sorted(row["n"] for row in short.select(F.size("h").alias("n")).distinct().collect())
    seeds = work.keep(short.select("item", F.xxhash64(F.size("h"), "h").alias("item_seed")), "short-seeds")
    blocks = max(1, -(-seeds.count() // BLOCK_SEEDS)) if lengths else 0
    found = [docs.join(items.limit(0), F.lit(False)).select(*TEXT, "item", F.lit(0).alias("diagonal"), docs["h"].alias("part"))]
    for n in lengths:
        starts = F.explode(F.sequence(F.lit(0), F.size("h") - n)).alias("at")
        window = F.slice("h", F.col("at") + 1, n)
        windows = docs.where(F.size("h") >= n).select(*TEXT, "h", starts)
        windows = windows.select(*TEXT, window.alias("part")).withColumn("seed", F.xxhash64(F.lit(n), "part"))
        for block in range(blocks):
            part = seeds.where(F.pmod("item_seed", F.lit(blocks)) == block)
            joined = windows.join(F.broadcast(part), F.col("seed") == F.col("item_seed"))
            found.append(joined.select(*TEXT, "item", F.lit(0).alias("diagonal"), "part"))
    return reduce(DataFrame.unionByName, found)


def _contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, digest, item_id, item_words, agreeing_words, best_stretch`` of each contaminated text and item."""
    work = WorkTables(docs.sparkSession, "decontamination")
    items, ids = _items(work, benchmark)
    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), _digest(docs["text"]).alias("digest"), _word_hashes(docs["text"]).alias("h")
    )
    keys = [*TEXT, "item"]
    both = _hits(texts, items, work).withColumn("light", F.lit(False)).unionByName(
        _light_hits(texts, items, work).unionByName(_short_hits(texts, items, work)).withColumn("light", F.lit(True))
    )
    # Of one text all parts of a diagonal are the same words.
    hits = both.groupBy(*keys, "diagonal").agg(F.first("part").alias("part"), F.min("light").alias("light"))
    hits = work.keep(hits, "hits")
    # The item's position that the part's first word stands at.
    first = F.greatest(-F.col("diagonal"), F.lit(0))
    equal = F.transform(
        "part", lambda word, i: F.when(word == F.get(F.col("h"), (first + i).cast("int")), first + i)
    )
    agreeing = hits.join(items, "item").select(
        *keys, F.size("h").alias("item_words"), equal.alias("equal"), "light"
    )
    windows = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("equal") - STRETCH_WORDS + 1, F.lit(1))),
        lambda at: F.size(F.filter(F.slice("equal", at, STRETCH_WORDS), lambda place: place.isNotNull())),
    )

    def enough(agreeing_words: Column, stretch: Column) -> Column:
        return (100 * agreeing_words >= AGREEING_PERCENT * F.col("item_words")) | (stretch >= STRETCH_AGREEING)

    per_diagonal = agreeing.select(
        *keys,
        "item_words",
        "light",
        F.array_max(windows).alias("stretch"),
        F.array_compact("equal").alias("places"),
    )
    per_diagonal = per_diagonal.where(~F.col("light") | enough(F.size("places"), F.col("stretch")))
    per_item = per_diagonal.groupBy(*keys, "item_words").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("agreeing_words"),
        F.max("stretch").alias("best_stretch"),
    )
    return per_item.where(enough(F.col("agreeing_words"), F.col("best_stretch"))).join(ids, "item").select(
        "doc_id",
        "digest",
        "item",
        "item_id",
        F.col("item_words").cast("long").alias("item_words"),
        F.col("agreeing_words").cast("long").alias("agreeing_words"),
        F.col("best_stretch").cast("long").alias("best_stretch"),
    )


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, item_words, agreeing_words, best_stretch.

    ``best_stretch`` is the largest number of agreeing words among 20 in a row
    of one diagonal. Null and wordless texts hit nothing; items without an id
    are reported with a null item_id; items with the same words are all reported.
    Rows that share a doc_id, null included, are one document, contaminated if
    one of its texts is; the largest numbers of its texts count, whatever their
    order. Empty tables give no rows.
    """
    counts = ("agreeing_words", "best_stretch")
    found = _contaminated(docs, benchmark).groupBy("doc_id", "item_id", "item_words", "item")
    return found.agg(*[F.max(name).alias(name) for name in counts]).drop("item")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, with all their columns.

    Rows are decided one by one, by doc_id and text: a clean text stays, whatever else stands under its doc_id or without one.
    """
    found = _contaminated(docs, benchmark).select(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest")).distinct()
    found = WorkTables(docs.sparkSession, "decontamination-stage").keep(found, "found")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_doc_id")) & (_digest(docs["text"]) == F.col("_digest"))
    return docs.join(found, same, "left_anti")

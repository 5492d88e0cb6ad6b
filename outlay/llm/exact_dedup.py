"""Exact duplicates by deterministic block naming.

Each text (white space runs made one space) is cut into blocks of a fixed
number of bytes. Distinct blocks are sorted and numbered; then adjacent numbers
are paired, distinct pairs sorted and numbered, and so on until one number is
left. Together with the number of rounds it is the text's identity: equal
numbers mean equal blocks, and by induction equal texts.

Blocks are sorted by a 128-bit fingerprint, so that their bytes are moved
between machines only once: to compare all blocks of one fingerprint byte by
byte. Should two different blocks ever share one, the run starts again with
other seeds, so the identity is exact and not only likely.

Frequent texts: counts and minima combine on the map side, and the joins are
between written tables, whose hot keys Spark splits at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import WorkTables, id_and_text, name_in_order, single_spaced

BLOCK_BYTES = 8192
NO_PARTNER = -1
LAST_ID = (1 << 63) - 1


def _blocks(text: Column, block_bytes: int) -> Column:
    """The bytes of a text in blocks; an empty text is one empty block."""
    data = text.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(text) / F.lit(block_bytes)), F.lit(1)) - 1
    return F.transform(
        F.sequence(F.lit(0), last.cast("int")), lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes))
    )


def _fingerprint(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(seed), block).alias("h1"), F.xxhash64(F.lit(~seed), block).alias("h2"))


def _collisions(texts: DataFrame, block_bytes: int, seed: int) -> bool:
    """Whether two different blocks share a fingerprint, decided on their bytes."""
    blocks = texts.select(F.explode(_blocks(F.col("text"), block_bytes)).alias("block"))
    compared = (
        blocks.select(_fingerprint(F.col("block"), seed).alias("f"), "block")
        .groupBy("f.h1", "f.h2")
        .agg(F.min("block").alias("first"), F.max("block").alias("last"))
    )
    return not compared.where(F.col("first") != F.col("last")).isEmpty()


def _identities(work: WorkTables, rows: DataFrame) -> DataFrame:
    """``rid, depth, name``: one identity for each row of fingerprint lists."""
    counts = rows.agg(F.max(F.size("prints")).alias("most")).first()
    names = name_in_order(work, rows.select(F.explode("prints").alias("f")).select("f.h1", "f.h2"), "name")
    single = rows.where(F.size("prints") == 1).select("rid", F.col("prints")[0]["h1"].alias("h1"), F.col("prints")[0]["h2"].alias("h2"))
    done = [single.join(names, ["h1", "h2"]).select("rid", F.lit(0).alias("depth"), "name")]
    longer = rows.where(F.size("prints") > 1).select("rid", F.posexplode("prints").alias("pos", "f"), F.size("prints").alias("left"))
    level = longer.select("rid", "pos", "left", "f.h1", "f.h2").join(names, ["h1", "h2"]).select("rid", "pos", "left", "name")
    most, depth = counts["most"] or 0, 0
    while most > 1:
        depth, most = depth + 1, (most + 1) // 2
        pairs = work.keep(
            level.groupBy("rid", F.floor(F.col("pos") / 2).alias("pos"), F.ceil(F.col("left") / 2).alias("left")).agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NO_PARTNER)).alias("b"),
            ),
            "pairs",
        )
        names = name_in_order(work, pairs.select("a", "b"), "name")
        named = pairs.join(names, ["a", "b"]).select("rid", "pos", "left", "name")
        done.append(named.where("left = 1").select("rid", F.lit(depth).alias("depth"), "name"))
        level = named.where("left > 1")
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; all empty texts are equal. Of equal texts the
    smallest doc_id stays, a null doc_id after all others; of rows that share
    that doc_id exactly one stays. An empty table gives no rows.
    """
    spark = docs.sparkSession
    work = WorkTables(spark, "exact-dedup")
    texts = id_and_text(docs).select("doc_id", single_spaced(F.col("text")).alias("text"))
    seed = 1
    while _collisions(texts, block_bytes, seed):
        seed += 1
    rows = work.keep(
        texts.select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            F.transform(_blocks(F.col("text"), block_bytes), lambda block: _fingerprint(block, seed)).alias("prints"),
        ),
        "rows",
    )
    named = work.keep(rows.select("rid", "doc_id", "digest").join(_identities(work, rows), "rid"), "named")
    order = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "rid", "doc_id")
    groups = work.keep(
        named.groupBy("depth", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size")), "groups"
    )
    return named.join(groups, ["depth", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are found again by doc_id; where one doc_id stands on several rows (or
    is null), by the text as well, and one row of each such text stays.
    """
    decided = WorkTables(docs.sparkSession, "exact-dedup-stage").keep(exact_duplicates(docs), "decided")
    per_id = decided.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("kept").alias("any_kept"))
    plain = docs.join(per_id.where("n = 1 AND any_kept AND doc_id IS NOT NULL"), "doc_id", "left_semi")
    repeated = per_id.where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_repeated_id"))
    digest = F.sha2(single_spaced(F.coalesce("text", F.lit(""))), 256)
    rows = docs.join(repeated, docs["doc_id"].eqNullSafe(F.col("_repeated_id")), "left_semi").withColumn("_digest", digest)
    kept = decided.where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_digest"))
    rows = rows.join(
        kept, rows["doc_id"].eqNullSafe(F.col("_kept_id")) & (F.col("_digest") == F.col("_kept_digest")), "left_semi"
    )
    once = rows.dropDuplicates(["doc_id", "_digest"]).drop("_digest")
    return plain.select(docs.columns).unionByName(once.select(docs.columns))

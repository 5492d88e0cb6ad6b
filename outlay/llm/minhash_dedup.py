"""Near-duplicates: minima of many universal hash functions, banding, verification, components.

1. Documents with the same word sequence are one class; its smallest doc_id is
   the node. All later steps see classes, so copies cost nothing.
2. 160 hash functions give each class its signature of minima; four minima make
   a band. Classes with an equal band meet in a bucket. A pair of similarity
   0.75 misses all 40 bands with a chance below 3 in 10 million.
3. A bucket with many members does not emit all pairs. Each member is first
   compared with the one centre with which it shares most buckets, then with
   its other centres where those are in another component, and only then,
   where a bucket still holds several components, the members outside its
   largest component with the members that can be similar enough. That join
   compares signatures itself, so only likely pairs leave it. Pairs inside one
   component need no link any more, so the components are those of all links.
4. A pair is likely if at least 91 of the minima agree (at similarity 0.75
   fewer agree with a chance below 2e-7), and is a link if the full sets say so.
   Large buckets hold many pairs that are close to the threshold, so their
   members also get one bit of each of 2,048 minima, of which at least 1,705
   agree (at similarity 0.75 fewer agree with a chance below 1e-7).
5. Links are joined by alternating large-star and small-star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.bit_filter import bit_field, passes
from outlay.llm.common import WorkTables, id_and_text
from outlay.llm.components import components
from outlay.llm.shingles import WordHashes, hash_functions, minima, shingle_set, words_of

BANDS = 40
ROWS_PER_BAND = 4
AGREEING_MINIMA = 91
#: In large buckets: one bit of each of so many more minima, and how many bits agree at least.
SKETCH_BITS = 2048
AGREEING_BITS = 1705
#: A link: 100 * intersection >= LINK_PERCENT * union.
LINK_PERCENT = 75
#: Buckets up to this size are compared without a bound first.
SMALL_BUCKET = 64
#: Up to this many ids (16 bytes each) are broadcast.
BROADCAST_NODES = 200_000
#: Sizes of one class differ by less than this factor.
SIZE_STEP = 1.05
_DOCS_AT_ONCE = 256
#: A task combines the shingles of so many at once (16 bytes each).
_SHINGLES_AT_ONCE = 2_000_000


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, class key (two hashes of the word sequence), set size, and bands of each row."""
    functions = hash_functions(BANDS * ROWS_PER_BAND)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, len(batch), _DOCS_AT_ONCE):
                part = batch.iloc[at : at + _DOCS_AT_ONCE]
                words = [words_of(text) for text in part["text"]]
                sets = [shingle_set(hashes.of(w)) for w in words]
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                for i, row in zip(full, minima([sets[i] for i in full], functions)):
                    bands[i] = row.view(np.int64)
                joined = [b" ".join(w) for w in words]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(),
                        "digest": part["digest"].to_numpy(),
                        "k1": pd.array([_key(w, 1) for w in joined], dtype="int64"),
                        "k2": pd.array([_key(w, 2) for w in joined], dtype="int64"),
                        "n_shingles": pd.array([len(s) for s in sets], dtype="int64"),
                        "bands": bands,
                    }
                )

    texts = id_and_text(docs).withColumn("digest", _digest(F.col("text")))
    return texts.mapInPandas(run, "doc_id long, digest long, k1 long, k2 long, n_shingles long, bands array<long>")


def _digest(text: Column) -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _key(words: bytes, seed: int) -> int:
    value = xxhash.xxh3_64_intdigest(words, seed)
    return value - (1 << 64) if value >= 1 << 63 else value


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, shingles`` for at least the given nodes, from their whole texts.

    A bit field keeps most other documents' sets from being made; the few that
    slip through meet no pair.
    """
    hashed = nodes.select(F.xxhash64("node").alias("hash"))
    field = docs.sparkSession.sparkContext.broadcast(bit_field(hashed, "hash"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, bits = WordHashes(), field.value
        for batch in batches:
            batch = batch[passes(bits, batch["hash"].to_numpy())].drop_duplicates(["doc_id", "text"])
            for start in range(0, len(batch), _DOCS_AT_ONCE):
                part = batch.iloc[start : start + _DOCS_AT_ONCE]
                sets = [shingle_set(hashes.of(words_of(text))).view(np.int64) for text in part["text"]]
                yield pd.DataFrame({"node": part["doc_id"].to_numpy(), "shingles": sets})

    texts = id_and_text(docs).where("doc_id IS NOT NULL")
    return texts.withColumn("hash", F.xxhash64("doc_id")).mapInPandas(run, "node long, shingles array<long>")


def _shared(nodes: DataFrame, work: WorkTables) -> DataFrame:
    """``node, key``: the buckets of each node that hold another node, too.

    A bucket's key is the hash of band and value. A bit field keeps most keys of one
    node only from being dealt a second time.
    """
    keys = F.transform("bands", lambda value, band: F.xxhash64(value, band))
    keyed = nodes.select("node", keys.alias("keys"))
    buckets = keyed.select("node", F.explode("keys").alias("key")).groupBy("key")
    met = buckets.agg(F.min("node").alias("low"), F.max("node").alias("high"))
    met = work.keep(met.where("low < high").select("key"), "met")
    field = nodes.sparkSession.sparkContext.broadcast(bit_field(met, "key"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = field.value
        for batch in batches:
            if not len(batch):
                continue
            found = np.stack(batch["keys"].to_numpy())
            row, column = np.nonzero(passes(bits, found.ravel()).reshape(found.shape))
            yield pd.DataFrame({"node": batch["node"].to_numpy()[row], "key": found[row, column]})

    likely = keyed.mapInPandas(run, "node long, key long")
    return work.keep(likely.join(met, "key").select("node", "key"), "shared")


def _stars(shared: DataFrame) -> DataFrame:
    """``a, b, buckets``: a centre, another member of some of its buckets, and how many those are.

    The centre of a bucket is the member that shares the most buckets with
    others: in a group of near copies that is close to the text they come from.
    """
    meets = shared.groupBy("node").agg(F.count("*").alias("meets"))
    centre = F.max(F.struct(F.col("meets"), (-F.col("node")).alias("first"))).alias("top")
    centres = shared.join(meets, "node").groupBy("key").agg(centre)
    centres = centres.select("key", (-F.col("top.first")).alias("a"))
    stars = shared.join(centres, "key").select("a", F.col("node").alias("b")).where("a <> b")
    return stars.groupBy("a", "b").agg(F.count("*").alias("buckets"))


def _agreeing(left: Column, right: Column) -> Column:
    """How many minima two signatures share; a band holds four of 16 bits."""

    def equal(x: Column) -> Column:
        lanes = [(F.shiftrightunsigned(x, 16 * i).bitwiseAND(F.lit(65535)) == 0).cast("int") for i in range(ROWS_PER_BAND)]
        return lanes[0] + lanes[1] + lanes[2] + lanes[3]

    per_band = F.zip_with(left, right, lambda x, y: equal(x.bitwiseXOR(y)))
    return F.aggregate(per_band, F.lit(0), lambda total, n: total + n)


def _may_link(n_1: Column, n_2: Column) -> Column:
    """Whether sets of these sizes can be similar enough at all."""
    return 100 * F.least(n_1, n_2) >= LINK_PERCENT * F.greatest(n_1, n_2)


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sizes fit and whose signatures agree often enough."""
    sides = [
        nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bands").alias(f"bands_{side}")) for side in "ab"
    ]
    both = pairs.join(sides[1], "b").join(sides[0], "a").where(_may_link(F.col("n_a"), F.col("n_b")))
    return both.where(_agreeing(F.col("bands_a"), F.col("bands_b")) >= AGREEING_MINIMA).select("a", "b").distinct()


def _only(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sets of some nodes; a bounded number of ids is broadcast, so that other sets do not move."""
    nodes = nodes.distinct()
    return sets.join(F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes, "node", "left_semi")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` (a written table) whose full sets are similar enough."""
    left = _only(sets, pairs.select(F.col("a").alias("node"))).select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = _only(sets, pairs.select(F.col("b").alias("node"))).select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - F.col("common")
    counted = both.withColumn("common", common)
    return counted.where(100 * F.col("common") >= LINK_PERCENT * union).select("a", "b").distinct()


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose two nodes are in different components so far."""
    of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    joined = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return joined.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(*pairs.columns)


def _held(sets: DataFrame) -> DataFrame:
    """``shingle, low, high``: what a task's nodes hold, and the smallest and largest of the holders.

    A task hands on a shingle once for all the nodes it combines, so the shingles
    that a large group shares are not multiplied by its members.
    """

    def combined(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts)
        shingle = np.concatenate(rows["shingles"].to_numpy())
        node = np.repeat(rows["node"].to_numpy(), rows["shingles"].map(len))
        order = np.lexsort((node, shingle))
        shingle, node = shingle[order], node[order]
        last = np.append(shingle[1:] != shingle[:-1], True)
        first = np.append(True, last[:-1])
        return pd.DataFrame({"shingle": shingle[first], "low": node[first], "high": node[last]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for batch in batches:
            batch = batch[batch["shingles"].map(len) > 0]
            for at in range(0, len(batch), _DOCS_AT_ONCE):
                parts.append(batch.iloc[at : at + _DOCS_AT_ONCE])
                held += int(parts[-1]["shingles"].map(len).sum())
                if held > _SHINGLES_AT_ONCE:
                    yield combined(parts)
                    parts, held = [], 0
        if parts:
            yield combined(parts)

    return sets.select("node", "shingles").mapInPandas(run, "shingle long, low long, high long")


def _found_elsewhere(sets: DataFrame) -> np.ndarray:
    """A bit field over the shingles that two nodes or more have."""
    members = _held(sets).groupBy("shingle")
    common = members.agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    return bit_field(common, "shingle")


def _open_nodes(sets: DataFrame) -> DataFrame:
    """``node, n, c, sketch`` of the sets that can have a link to another one at all.

    ``n`` is the size of a set and ``c`` at least the number of its shingles that
    another set has (a bit field may count one too many); ``sketch`` is one bit of
    each of ``SKETCH_BITS`` minima.
    """
    functions = hash_functions(SKETCH_BITS)
    field = sets.sparkSession.sparkContext.broadcast(_found_elsewhere(sets))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = field.value
        for batch in batches:
            n = batch["shingles"].map(len).to_numpy()
            c = np.array([int(passes(bits, s).sum()) for s in batch["shingles"]], dtype=np.int64)
            batch = batch.assign(n=n.astype(np.int64), c=c)[100 * c >= LINK_PERCENT * n]
            for at in range(0, len(batch), _DOCS_AT_ONCE):
                part = batch.iloc[at : at + _DOCS_AT_ONCE]
                found = minima([s.view(np.uint64) for s in part["shingles"]], functions)
                sketch = np.packbits((found & 1).astype(np.uint8), axis=1).view(np.int64)
                yield part[["node", "n", "c"]].assign(sketch=list(sketch))

    return sets.mapInPandas(run, "node long, n long, c long, sketch array<long>")


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.lit(float(np.log(SIZE_STEP)))).cast("int")


def _remaining(work: WorkTables, shared: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Likely pairs that share a bucket and are in different components.

    One of the two is outside its bucket's largest component. In a small bucket
    all such pairs are compared: a node has at most ``SMALL_BUCKET`` partners
    there. In a larger one shingles count: those that no other node in question
    has cannot be common to a pair, so a set of which others have c shingles shares
    at most c. This bounds a partner's size, and only members of fitting size meet.
    Most members of a large group that belong to no component have own shingles
    and so meet few or none.
    """
    placed = shared.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("roots"), F.sum("n").alias("members")
    )
    mixed = mixed.where("roots > 1").select("key", F.col("top.root").alias("largest"), "members")
    placed = work.keep(placed.join(mixed, "key").join(nodes, "node"), "mixed")
    small = placed.where(F.col("members") <= SMALL_BUCKET).drop("members")
    near = _once() & _may_link(F.col("n"), F.col("n_x")) & (_agreeing(F.col("bands"), F.col("bands_x")) >= AGREEING_MINIMA)
    pairs = _outside(small).withColumnRenamed("key", "key_x").join(small, (F.col("key_x") == F.col("key")) & near)
    return pairs.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).unionByName(
        _remaining_in_large(work, placed.where(F.col("members") > SMALL_BUCKET).drop("members"), sets)
    ).distinct()


def _outside(placed: DataFrame, *more: Column) -> DataFrame:
    """Members outside the largest component, under other names."""
    names = {"node": "x", "root": "root_x", "n": "n_x", "c": "c_x", "bands": "bands_x", "sketch": "sketch_x", "keys": "keys_x"}
    outside = placed.where("root <> largest").drop("largest")
    kept = [F.col(c).alias(names.get(c, c)) for c in outside.columns]
    return outside.select(*kept, *more)


def _once() -> Column:
    """Different components, and of two members outside only one order."""
    return (F.col("root") != F.col("root_x")) & ((F.col("root") == F.col("largest")) | (F.col("x") < F.col("node")))


def _buckets_of(placed: DataFrame) -> DataFrame:
    """``node, keys``: the buckets of each node, at most ``BANDS`` for a text."""
    return placed.groupBy("node").agg(F.collect_set("key").alias("keys"))


def _in_first_bucket() -> Column:
    """Whether a pair meets in the first of the buckets it shares; similar members share many."""
    return F.array_min(F.array_intersect("keys", "keys_x")) == F.col("key")


def _remaining_in_large(work: WorkTables, placed: DataFrame, sets: DataFrame) -> DataFrame:
    in_question = work.keep(_only(sets, placed.select("node")), "in-question")
    opened = work.keep(_open_nodes(in_question), "open")
    placed = placed.drop("n", "bands").join(opened.join(_buckets_of(placed), "node"), "node")
    ratio = LINK_PERCENT / 100
    least = _size_class(F.greatest(F.floor(F.col("n") * ratio), F.lit(1)))
    most = _size_class(F.greatest(F.ceil(F.col("c") * (1 + 1 / ratio) - F.col("n")), F.lit(1)))
    outside = _outside(placed, F.explode(F.sequence(least, F.greatest(least, most))).alias("size_x"))
    outside = outside.withColumnRenamed("key", "key_x")
    others = placed.withColumn("size", _size_class(F.col("n")))
    common = F.least("c", "c_x")
    fits = 100 * common >= LINK_PERCENT * (F.col("n") + F.col("n_x") - common)
    differing = F.zip_with("sketch", "sketch_x", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    likely = F.aggregate(differing, F.lit(0), lambda total, n: total + n) <= SKETCH_BITS - AGREEING_BITS
    same = (F.col("key_x") == F.col("key")) & (F.col("size_x") == F.col("size"))
    pairs = outside.join(others, same & _once() & fits & likely & _in_first_bucket())
    return pairs.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"))


def _same_document(work: WorkTables, signed: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b``: links between the classes of texts that stand under one doc_id."""
    keys = F.struct("k1", "k2")
    several = signed.groupBy("doc_id").agg(F.min(keys).alias("low"), F.max(keys).alias("high")).where("low < high")
    several = work.keep(several.select("doc_id"), "several-texts")
    return signed.join(several, "doc_id").join(classes, ["k1", "k2"]).select(F.col("node").alias("a"), F.col("doc_id").alias("b"))


_LINKED = "doc_id IS NOT NULL AND n_shingles > 0"


def _decided(docs: DataFrame, by_document: bool) -> DataFrame:
    """``doc_id, digest, n_shingles, component_id, kept`` of each row."""
    work = WorkTables(docs.sparkSession, "minhash")
    signed = work.keep(_signed(docs), "signed")
    with_words = signed.where(_LINKED)
    classes = work.keep(with_words.groupBy("k1", "k2").agg(F.min("doc_id").alias("node")), "classes")
    nodes = with_words.select(F.col("doc_id").alias("node"), "k1", "k2", F.col("n_shingles").alias("n"), "bands")
    nodes = nodes.join(classes, ["node", "k1", "k2"], "left_semi").dropDuplicates(["node", "k1", "k2"])
    nodes = work.keep(nodes.select("node", "n", "bands"), "nodes")
    shared = _shared(nodes, work)
    stars = work.keep(_stars(shared), "stars")
    met = shared.select("node").distinct()
    known = work.keep(nodes.join(met, "node", "left_semi"), "known")
    sets = work.keep(_sets(docs, met), "sets")

    best = F.max(F.struct("buckets", (-F.col("a")).alias("first"))).alias("best")
    nearest = stars.groupBy("b").agg(best).select((-F.col("best.first")).alias("a"), "b")
    links = _links(work.keep(_likely(nearest, known), "likely"), sets)
    if by_document:
        links = links.unionByName(_same_document(work, with_words, classes))
    roots = components(work, work.keep(links, "links"))
    others = stars.join(nearest, ["a", "b"], "left_anti").select("a", "b")
    likely = work.keep(_likely(_across(others, roots), known), "likely")
    more = work.keep(_links(likely, sets), "links")
    roots = components(work, _star_edges(roots).unionByName(more))
    tested = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = work.keep(_remaining(work, shared, roots, known, sets).join(tested, ["a", "b"], "left_anti"), "rest")
    last = work.keep(_links(rest, sets), "links")
    roots = components(work, _star_edges(roots).unionByName(last))

    placed = classes.join(roots, "node", "left").select("k1", "k2", F.coalesce("root", "node").alias("place"))
    placed = work.keep(placed, "placed")
    work.drop(nodes, shared, stars, known, sets)
    joined = signed.drop("bands").join(placed, ["k1", "k2"], "left")
    own = F.when(F.expr(_LINKED), F.col("place")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "digest", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Null text counts as empty; a text without words has no shingles and is
    linked with nothing. Rows with one doc_id are one document: all their texts
    are in one component. A row without doc_id is linked with nothing, has no
    component_id, and is kept. Ties cannot arise: the smallest doc_id names
    the component. An empty table gives no rows.
    """
    return _decided(docs, True).drop("digest")


def _star_edges(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns.

    Rows are decided one by one: of two texts under one doc_id, only one that is
    similar to a text of a smaller doc_id goes.
    """
    work = WorkTables(docs.sparkSession, "minhash-stage")
    dropped = _decided(docs, False).where("NOT kept").select(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"))
    dropped = work.keep(dropped.distinct(), "dropped")
    same = (docs["doc_id"].cast("long") == F.col("_doc_id")) & (_digest(docs["text"]) == F.col("_digest"))
    return docs.join(dropped, same, "left_anti")

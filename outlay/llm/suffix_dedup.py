"""Removal of byte strings that occur again, by sampled suffixes and induction.

A byte goes if a 200-byte string that covers it starts at another place too.

Sorting every suffix would move each byte many times over. Only the suffixes at
anchors (about one in 64 bytes, see ``anchors``) are sorted and compared, by
Spark's external, disk-backed sort and aggregation; what holds for the other
suffixes is induced from their anchor, in three rounds from coarse to fine:

1. Segments whose anchor suffix agrees with no other in its first 73 bytes hold
   no repeated string.
2. If all bytes around the anchor that any of the segment's strings can reach
   are found again, every string of the segment is repeated.
3. The others are compared string by string with the segments that share
   their first 73 bytes, once for each distinct context.

Places are (doc_id, hash of the text, position). Strings are compared by two
64-bit hashes; a hash of 64 bits alone only ever selects what is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.anchors import CONTEXT, LENGTH, REACH, Segments, context_window_hashes, segments
from outlay.llm.bit_filter import bit_field, passes
from outlay.llm.common import WorkTables, id_and_text

#: Cores with more contexts than this are compared by a shuffle of their strings.
HOT_CORE = 20_000
_CONTEXTS_AT_ONCE = 2048
_REMEMBERED = 20_000
_PLACE = "doc_id long, text_hash long, first int, last int"


def _place_hash(text_hash: int, anchors: np.ndarray) -> np.ndarray:
    mixed = (np.uint64(text_hash & (2**64 - 1)) + anchors.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def _each(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, int, Segments]]:
    for batch in batches:
        ids = batch["doc_id"].astype("Int64")
        for doc_id, text_hash, text in zip(ids, batch["text_hash"], batch["text"]):
            for part in segments(np.frombuffer(text.encode(), dtype=np.uint8)):
                yield None if doc_id is pd.NA else int(doc_id), int(text_hash), part


def _tables(columns: dict[str, str], rows: Iterator[tuple], at_once: int) -> Iterator[pd.DataFrame]:
    """Arrays of several segments put together to tables of about ``at_once`` rows."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        if len(row[-1]):
            held.append(row)
            size += len(row[-1])
        if size >= at_once:
            yield _table(columns, held)
            held, size = [], 0
    if held:
        yield _table(columns, held)


def _table(columns: dict[str, str], held: list[tuple]) -> pd.DataFrame:
    result = {}
    for i, (name, kind) in enumerate(columns.items()):
        if kind == "one":
            sizes = [len(row[-1]) for row in held]
            result[name] = pd.array([row[i] for row in held], dtype="Int64").repeat(sizes)
        elif kind == "list":
            result[name] = [value for row in held for value in row[i]]
        else:
            result[name] = np.concatenate([row[i] for row in held])
    return pd.DataFrame(result)


def _shared_cores(texts: DataFrame) -> DataFrame:
    """``core``: hashes of the first bytes of two anchor suffixes or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((part.cores(),) for _, _, part in _each(batches))
        for table in _tables({"core": "array"}, rows, 200_000):
            core, n = np.unique(table["core"].to_numpy(), return_counts=True)
            yield pd.DataFrame({"core": core, "n": n})

    counted = texts.mapInPandas(run, "core long, n long").groupBy("core").agg(F.sum("n").alias("n"))
    return counted.where("n > 1").select("core")


def _likely_segments(texts: DataFrame, cores: DataFrame) -> DataFrame:
    """Segments whose core may be shared, with both hashes of their context."""
    field = texts.sparkSession.sparkContext.broadcast(bit_field(cores, "core"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for doc_id, text_hash, part in _each(batches):
                core = part.cores()
                some = np.flatnonzero(passes(field.value, core))
                if len(some):
                    yield (
                        doc_id,
                        text_hash,
                        part.contexts(0)[some],
                        part.contexts(1)[some],
                        _place_hash(text_hash, part.anchor[some]),
                        part.first[some].astype(np.int32),
                        part.last[some].astype(np.int32),
                        core[some],
                    )

        kinds = dict.fromkeys(("context1", "context2", "place", "first", "last", "core"), "array")
        yield from _tables({"doc_id": "one", "text_hash": "one", **kinds}, rows(), 20_000)

    return texts.mapInPandas(run, "doc_id long, text_hash long, context1 long, context2 long, place long, first int, last int, core long")


def _contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes around the anchors of the wanted segments (and of a few more that hash alike).

    Of byte-identical copies of a text a task gives a segment once for every
    ``_REMEMBERED`` others: its context occurs again, so all its places are
    known to be repeated and one stands for all.
    """
    field = texts.sparkSession.sparkContext.broadcast(bit_field(wanted, "place"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            given: set[tuple[int, int, bytes]] = set()
            for doc_id, text_hash, part in _each(batches):
                some = np.flatnonzero(passes(field.value, _place_hash(text_hash, part.anchor)))
                if len(some):
                    if len(given) > _REMEMBERED:
                        given.clear()
                    keys = [(text_hash, *at) for at in zip(part.anchor[some].tolist(), part.context_bytes(some))]
                    some = some[[key not in given for key in keys]]
                    given.update(keys)
                if len(some):
                    yield (
                        doc_id,
                        text_hash,
                        part.first[some].astype(np.int32),
                        part.last[some].astype(np.int32),
                        part.anchor[some].astype(np.int32),
                        part.context_bytes(some),
                        part.cores()[some],
                    )

        kinds = {"first": "array", "last": "array", "anchor": "array", "context": "list", "core": "array"}
        yield from _tables({"doc_id": "one", "text_hash": "one", **kinds}, rows(), 5_000)

    return texts.mapInPandas(run, "doc_id long, text_hash long, first int, last int, anchor int, context binary, core long")


def _starts(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All strings of the segments: row, start, and two hashes."""
    contexts = np.frombuffer(b"".join(rows["context"]), dtype=np.uint8).reshape(-1, CONTEXT)
    one, two = context_window_hashes(contexts)
    begin = rows["anchor"].to_numpy(dtype=np.int64)[:, None] - (REACH - 1) + np.arange(REACH)
    own = (begin >= rows["first"].to_numpy()[:, None]) & (begin <= rows["last"].to_numpy()[:, None])
    row = np.nonzero(own)[0]
    return row, begin[own], one[own], two[own]


def _runs(rows: pd.DataFrame, row: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    """Consecutive starts of one row as first and last."""
    if not len(row):
        return pd.DataFrame({"doc_id": pd.array([], "Int64"), "text_hash": [], "first": [], "last": []})
    opens = np.r_[True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]
    closes = np.r_[opens[1:], True]
    of = row[opens]
    return pd.DataFrame(
        {
            "doc_id": rows["doc_id"].astype("Int64").array[of],
            "text_hash": rows["text_hash"].to_numpy()[of],
            "first": start[opens].astype(np.int32),
            "last": start[closes].astype(np.int32),
        }
    )


def _repeated_runs(rows: pd.DataFrame) -> pd.DataFrame:
    """The runs of starts whose strings occur twice or more among the given segments."""
    row, start, one, two = _starts(rows)
    order = np.lexsort((two, one))
    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    repeated = np.zeros(len(row), dtype=bool)
    repeated[order] = np.r_[same, False] | np.r_[False, same]
    return _runs(rows, row[repeated], start[repeated])


def _compared(contexts: DataFrame) -> DataFrame:
    """Repeated runs among segments that share a core; a core's segments meet in one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= _CONTEXTS_AT_ONCE:
                rows = pd.concat(held, ignore_index=True)
                core = rows["core"].to_numpy()
                done = int(np.searchsorted(core, core[-1], side="left"))  # the last core may go on
                held = [rows.iloc[done:]]
                for at in _groups(core[:done]):
                    yield _repeated_runs(rows.iloc[at].reset_index(drop=True))
        if held:
            rows = pd.concat(held, ignore_index=True)
            for at in _groups(rows["core"].to_numpy()):
                yield _repeated_runs(rows.iloc[at].reset_index(drop=True))

    sorted_rows = contexts.repartition("core").sortWithinPartitions("core")
    return sorted_rows.mapInPandas(run, _PLACE)


def _groups(core: np.ndarray) -> Iterator[slice]:
    """Slices of whole cores, of about ``_CONTEXTS_AT_ONCE`` rows or one core."""
    cuts = np.r_[np.flatnonzero(core[1:] != core[:-1]) + 1, len(core)]
    begin = 0
    for cut, following in zip(cuts, np.r_[cuts[1:], len(core) + _CONTEXTS_AT_ONCE + 1]):
        if following - begin > _CONTEXTS_AT_ONCE and cut > begin:
            yield slice(begin, int(cut))
            begin = int(cut)


def _compared_by_shuffle(work: WorkTables, contexts: DataFrame) -> DataFrame:
    """The same for cores with very many segments: every string is a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows = batch.iloc[at : at + 256].reset_index(drop=True)
                row, start, one, two = _starts(rows)
                places = _runs(rows, row, start) if len(row) == 0 else pd.DataFrame(
                    {
                        "doc_id": rows["doc_id"].astype("Int64").array[row],
                        "text_hash": rows["text_hash"].to_numpy()[row],
                        "first": start.astype(np.int32),
                        "last": start.astype(np.int32),
                    }
                )
                places["one"], places["two"] = one.view(np.int64), two.view(np.int64)
                yield places

    strings = contexts.mapInPandas(run, _PLACE + ", one long, two long")
    twice = strings.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return strings.join(work.keep(twice, "twice"), ["one", "two"], "left_semi").drop("one", "two")


def repeated_starts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts (doc_id, text, text_hash), and ``doc_id, text_hash, first, last``: runs of starts of repeated strings."""
    work = WorkTables(docs.sparkSession, "suffix-dedup")
    texts = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    cores = work.keep(_shared_cores(texts), "cores")
    likely = work.keep(_likely_segments(texts, cores), "segments")
    # Equal contexts have equal cores; of their places the smallest stands for all.
    known = work.keep(
        likely.groupBy("context1", "context2").agg(
            F.count("*").alias("n"), F.min("core").alias("core"), F.min("place").alias("place")
        ),
        "known",
    )
    multiple = known.where("n > 1")
    whole = likely.join(multiple.select("context1", "context2"), ["context1", "context2"], "left_semi")
    single = work.keep(known.where("n = 1").select("core", "place").join(cores, "core", "left_semi"), "single")
    once = multiple.select("core", "place").join(single.select("core").distinct(), "core", "left_semi")
    wanted = work.keep(single.unionByName(once), "wanted")
    contexts = work.keep(_contexts(texts, wanted), "contexts")
    hot = contexts.groupBy("core").agg(F.count("*").alias("n")).where(F.col("n") > HOT_CORE).select("core")
    hot = work.keep(hot, "hot")
    runs = whole.select("doc_id", "text_hash", "first", "last").unionByName(
        _compared(contexts.join(hot, "core", "left_anti"))
    )
    if not hot.isEmpty():
        runs = runs.unionByName(_compared_by_shuffle(work, contexts.join(hot, "core", "left_semi")))
    return texts, work.keep(runs, "runs")


def _cut(text: bytes, first: list[int], last: list[int]) -> tuple[int, int, bytes]:
    """Removed bytes, maximal removed runs, and what is left."""
    steps = np.zeros(len(text) + 1, dtype=np.int32)
    np.add.at(steps, np.asarray(first, dtype=np.int64), 1)
    np.add.at(steps, np.asarray(last, dtype=np.int64) + LENGTH, -1)
    gone = np.cumsum(steps[:-1]) > 0
    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (binary).

    Null text counts as empty; texts under 200 bytes lose nothing. Of a string
    that occurs twice or more every occurrence goes, in one document or many.
    Rows are told apart by doc_id and text; equal rows are copies of each
    other and lose all that 200-byte strings cover. An empty table gives none.
    """
    texts, runs = repeated_starts(docs)
    key = [F.coalesce("doc_id", F.lit(-1)).alias("k1"), F.col("doc_id").isNull().alias("k2"), "text_hash"]
    per_text = runs.select(*key, "first", "last").groupBy("k1", "k2", "text_hash").agg(
        F.collect_set(F.struct("first", "last")).alias("runs")
    )
    joined = texts.select("doc_id", "text", *key).join(per_text, ["k1", "k2", "text_hash"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, first, last in zip(batch["text"], batch["first"], batch["last"]):
                data = text.encode()
                found = (0, 0, data) if first is None or not len(first) else _cut(data, first, last)
                rows.append((len(data), *found))
            table = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])
            table.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield table

    lists = joined.select("doc_id", "text", F.col("runs.first").alias("first"), F.col("runs.last").alias("last"))
    return lists.mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def removal_digests(docs: DataFrame) -> DataFrame:
    """``without_repeats`` with ``kept_sha256`` in place of the kept bytes."""
    return without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )



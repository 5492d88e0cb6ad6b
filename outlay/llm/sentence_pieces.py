"""Piece encoding and decoding of documents with a table of distinct chunks.

1. Every task counts the chunks of its documents; the counts are summed.
2. Chunks are ranked by frequency in levels, and as many levels as fit the
   bounds ``TABLE_ROWS`` and ``TABLE_BYTES`` make the table. Each of its chunks
   is segmented once, on the executors, and the table is broadcast.
3. Documents are cut into chunks, looked up, and the ids are joined back by
   position. The other, rare chunks are segmented in a table of the worker
   that meets them: a chunk that occurs once is segmented once there, too.

So documents never move and nothing that grows without bound is broadcast. A
shuffled join for the rare chunks would be exact as well, but it has to move
every document's positions twice (measured in the README).
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.llm.common import WorkTables, id_and_text
from outlay.llm.piece_chunks import ChunkTable, Segmenter, Vocabulary, chunks, load_vocabulary, unmarked

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Bounds of the broadcast table.
TABLE_ROWS = 200_000
TABLE_BYTES = 8 << 20
#: Bytes of chunks that a worker remembers besides the table.
WORKER_BYTES = 96 << 20
#: Distinct chunks that a task counts before it hands them on.
COUNTED_AT_ONCE = 200_000


def chunk_counts(docs: DataFrame, pattern: re.Pattern[str]) -> DataFrame:
    """``chunk, n`` of all chunks that occur twice or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(chunks(text, pattern))
                if len(seen) > COUNTED_AT_ONCE:
                    yield pd.DataFrame({"chunk": list(seen.keys()), "n": list(seen.values())})
                    seen.clear()
        yield pd.DataFrame({"chunk": pd.Series(list(seen.keys()), dtype="object"), "n": pd.Series(list(seen.values()), dtype="int64")})

    counted = id_and_text(docs).select("text").mapInPandas(run, "chunk string, n long")
    return counted.groupBy("chunk").agg(F.sum("n").alias("n")).where("n > 1")


def chunk_table(docs: DataFrame, pattern: re.Pattern[str], shared: Broadcast, work: WorkTables, rows: int, size: int) -> DataFrame:
    """``chunk, ids, characters`` of the most frequent chunks, at most ``rows`` rows and ``size`` bytes of chunks."""
    counts = work.keep(chunk_counts(docs, pattern).select("*", F.floor(F.log2("n") * 4).cast("int").alias("level")), "counts")
    # At most 256 levels exist, as counts are below 2^64.
    levels = counts.groupBy("level").agg(F.count("*").alias("n"), F.sum(F.octet_length("chunk")).alias("size")).collect()
    n_rows = n_bytes = 0
    lowest = None
    for level in sorted(levels, key=lambda row: -row["level"]):
        n_rows, n_bytes = n_rows + level["n"], n_bytes + level["size"]
        if n_rows > rows or n_bytes > size:
            break
        lowest = level["level"]
    taken = counts.where(F.col("level") >= lowest if lowest is not None else F.lit(False))

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segmenter = Segmenter(shared.value)
        for batch in batches:
            found = [segmenter.encode_chunk(chunk) for chunk in batch["chunk"]]
            yield pd.DataFrame(
                {
                    "chunk": batch["chunk"],
                    "ids": [np.asarray(ids, dtype="<u4").tobytes() for ids in found],
                    "characters": [segmenter.decode_marked(ids) for ids in found],
                }
            )

    return work.keep(taken.select("chunk").mapInPandas(segment, "chunk string, ids binary, characters string"), "table")


def _share(spark: SparkSession, vocabulary: Vocabulary) -> Broadcast:
    """The vocabulary for all tasks; its size is that of the model file."""
    return spark.sparkContext.broadcast(vocabulary)


_workers: dict[int, ChunkTable] = {}


def _table(vocabulary: Broadcast, rows: Broadcast) -> ChunkTable:
    """This worker's table, kept while the shared rows are the same object."""
    known, shared = _workers.get(0), rows.value
    if known is None or known.shared is not shared:
        known = _workers[0] = ChunkTable(Segmenter(vocabulary.value), shared, WORKER_BYTES)
    return known


def encode_pieces(docs: DataFrame, path: str = MODEL, rows: int = TABLE_ROWS, size: int = TABLE_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (array of int, begin and end included), decoded (text).

    Null text counts as empty: only the begin and the end id, decoded to
    nothing. A marker character in a text is white space to the tokenizer, so
    it is decoded as a space; all other texts come back as they are. Repeated
    rows are encoded each; an empty table gives no rows.
    """
    return _encoded(docs, path, rows, size, False)


def encode_piece_digests(docs: DataFrame, path: str = MODEL, rows: int = TABLE_ROWS, size: int = TABLE_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256 (of little-endian 32-bit ids), decoded_sha256.

    Null, empty, long and repeated texts as in ``encode_pieces``.
    """
    return _encoded(docs, path, rows, size, True)


def _encoded(docs: DataFrame, path: str, rows: int, size: int, digests: bool) -> DataFrame:
    work = WorkTables(docs.sparkSession, "pieces")
    vocabulary = load_vocabulary(path)
    shared = _share(docs.sparkSession, vocabulary)
    pattern = vocabulary.chunk_pattern()
    table = chunk_table(docs, pattern, shared, work, rows, size).toArrow()  # at most ``rows`` rows and ``size`` bytes of chunks
    known = {
        chunk: (ids, characters)
        for chunk, ids, characters in zip(*(table[name].to_pylist() for name in ("chunk", "ids", "characters")))
    }
    known_rows = docs.sparkSession.sparkContext.broadcast(known)
    begin, end = (np.asarray([i], dtype="<u4").tobytes() for i in (vocabulary.begin, vocabulary.end))

    def coded(text: str, found: ChunkTable) -> tuple[bytes, str]:
        found.turn()
        parts = chunks(text, pattern)
        if not parts:
            return begin + end, ""
        ids, characters = zip(*map(found.__getitem__, parts))
        return b"".join((begin, *ids, end)), unmarked("".join(characters))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = _table(shared, known_rows)
        gc.disable()  # the table holds no cycles, and it has many entries
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                done = [coded(text, found) for text in part["text"]]
                if digests:
                    yield pd.DataFrame(
                        {
                            "doc_id": part["doc_id"].to_numpy(),
                            "n_tokens": [len(ids) // 4 for ids, _ in done],
                            "ids_sha256": [hashlib.sha256(ids).hexdigest() for ids, _ in done],
                            "decoded_sha256": [hashlib.sha256(text.encode()).hexdigest() for _, text in done],
                        }
                    )
                else:
                    yield pd.DataFrame(
                        {
                            "doc_id": part["doc_id"].to_numpy(),
                            "ids": [np.frombuffer(ids, dtype="<i4") for ids, _ in done],
                            "decoded": [text for _, text in done],
                        }
                    )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_and_text(docs).mapInPandas(run, schema if digests else "doc_id long, ids array<int>, decoded string")

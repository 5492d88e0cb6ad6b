"""Byte-level BPE over tables of documents."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from outlay.llm.byte_bpe import ByteBpe, _Pieces, digests, load_ranks
from outlay.llm.common import id_and_text

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: In the stage: bytes of text encoded at once, bytes of remembered pieces, joined parts remembered, longest remembered piece.
SLICE_BYTES = 2 << 20
STAGE_BYTES = 48 << 20
STAGE_REMEMBERED = 50_000
LONG_PIECE = 64

_workers: dict[int, _Pieces] = {}


def _share(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary for all tasks; its size is that of the one file (about 50,000 tokens)."""
    return spark.sparkContext.broadcast(load_ranks(path))


def _pieces(shared: Broadcast, pattern: str) -> _Pieces:
    """The encoder of this worker process, kept while the vocabulary is the same object."""
    ranks = shared.value
    known = _workers.get(0)
    if known is None or known.bpe.ranks is not ranks or known.bpe.pattern.pattern != pattern:
        known = _workers[0] = _Pieces(ByteBpe(ranks, pattern))
    return known


def encode_digests(docs: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null text counts as empty (no ids; digests of nothing). Texts are read
    whole, white space and any characters included. An empty table gives none.
    """
    shared = _share(docs.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = _pieces(shared, pattern)
        gc.disable()  # the remembered pieces hold no cycles, and there are many
        for batch in batches:
            rows = list(digests(batch["text"], pieces))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_tokens": [row[0] for row in rows],
                    "ids_sha256": [row[1] for row in rows],
                    "decoded_sha256": [row[2] for row in rows],
                }
            )

    return id_and_text(docs).mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


class _IdsAndBytes(dict):
    """piece -> (ids as 32-bit numbers, bytes decoded from them), forgotten when they take too many bytes."""

    def __init__(self, bpe: ByteBpe) -> None:
        super().__init__()
        self.bpe, self.used = bpe, 0

    def __missing__(self, piece: str) -> tuple[bytes, bytes]:
        ids = self.bpe.encode_piece(piece.encode())
        value = (np.asarray(ids, dtype=np.int32).tobytes(), self.bpe.decode(ids))
        if len(piece) <= LONG_PIECE:
            self[piece] = value
            self.used += 250 + 5 * len(piece)  # about what the entry takes
        return value

    def turn(self) -> None:
        if self.used > STAGE_BYTES:
            self.clear()
            self.used = 0


def _slices(batch: pa.RecordBatch, texts: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``SLICE_BYTES`` of text, of one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES)))
        yield batch.slice(at, end - at)
        at = end


def round_trip(docs: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with the text decoded from its ids, plus ``token_ids`` and ``n_tokens``.

    A null text stays null, with no ids. Columns of the input with the names of
    the two new ones are replaced; all others are kept as they are. Rows go
    through in slices of a few MB, and what a worker remembers of pieces is
    bounded in bytes, so a task needs the longest text and little more.
    """
    shared = _share(docs.sparkSession, path)
    kept = docs.select(*[c for c in docs.columns if c not in ("token_ids", "n_tokens")])
    schema = T.StructType([*kept.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())])

    def coded(batch: pa.RecordBatch, pieces: _IdsAndBytes) -> pa.RecordBatch:
        ids, decoded = [], []
        for text in batch.column("text").to_pylist():
            pieces.turn()
            found = pieces.bpe.pieces(text or "")
            parts = tuple(zip(*map(pieces.__getitem__, found))) or ((), ())
            ids.append(b"".join(parts[0]))
            decoded.append(None if text is None else b"".join(parts[1]).decode())
        ends = np.cumsum([0, *[len(row) // 4 for row in ids]], dtype=np.int64)
        numbers = pa.array(np.frombuffer(b"".join(ids), dtype=np.int32))
        arrays = {name: batch.column(name) for name in batch.schema.names}
        arrays["text"] = pa.array(decoded, type=batch.column("text").type)
        arrays["token_ids"] = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), numbers)
        arrays["n_tokens"] = pa.array(np.diff(ends))
        return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _IdsAndBytes(ByteBpe(shared.value, pattern, STAGE_REMEMBERED))
        gc.disable()  # what is remembered holds no cycles
        try:
            for batch in batches:
                for part in _slices(batch, "text"):
                    yield coded(part, pieces)
        finally:
            gc.enable()  # the worker goes on to tasks of other stages

    return kept.mapInArrow(run, schema)

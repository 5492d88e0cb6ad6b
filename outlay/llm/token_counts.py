"""Token counts of documents under a unigram vocabulary, by a trie in every task."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from outlay.llm.byte_bpe import load_ranks
from outlay.llm.common import id_and_text
from outlay.llm.token_trie import TokenTrie, rank_scores

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def token_counts(docs: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per row of ``docs``: doc_id, n_pretokens, n_tokens.

    Null and empty texts have none of either. No shuffle: every task builds
    the trie of the pre-tokens it meets and starts anew when it is full. An
    empty table gives no rows.
    """
    # The vocabulary's size is that of its file, whatever the documents.
    shared = docs.sparkSession.sparkContext.broadcast(rank_scores(load_ranks(path)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, split = TokenTrie(shared.value), regex.compile(pattern).findall
        for batch in batches:
            pretokens, tokens = [], []
            for text in batch["text"]:
                trie.turn()
                found = split(text)
                pretokens.append(len(found))
                tokens.append(sum(map(trie.__getitem__, found)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_pretokens": pretokens, "n_tokens": tokens})

    return id_and_text(docs).mapInPandas(run, "doc_id long, n_pretokens long, n_tokens long")

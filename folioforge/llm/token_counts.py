"""Token counts by heap-and-linked-list byte-pair merging, without identifiers.

The symbols of a piece form a linked list; a heap holds its adjacent pairs that can merge.
The pair of lowest rank (the leftmost of equals) is popped, merged, and its new neighbours
pushed, until none is left: the count is the number of symbols less the merges.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.vocabulary import Vocabulary, default_path, load

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Counts of short pieces that a task remembers; with more it starts anew.
REMEMBERED = 400_000
_SHORT = 48


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Tokens of one piece, given its first symbols."""
    n = len(symbols)
    if n < 2:
        return n
    text = list(symbols)
    after, before = list(range(1, n)) + [-1], list(range(-1, n - 1))
    heap = [(rank, i, pair) for i, pair in enumerate(zip(text, text[1:])) if (rank := ranks.get(pair)) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, left, pair = heapq.heappop(heap)
        right = after[left]
        if text[left] != pair[0] or right < 0 or text[right] != pair[1]:
            continue  # one of the two has merged with another neighbour meanwhile
        text[left], text[right] = pair[0] + pair[1], ""
        merges += 1
        beyond = after[left] = after[right]
        if beyond >= 0:
            before[beyond] = left
            new = (text[left], text[beyond])
            if (rank := ranks.get(new)) is not None:
                heapq.heappush(heap, (rank, left, new))
        if (previous := before[left]) >= 0:
            new = (text[previous], text[left])
            if (rank := ranks.get(new)) is not None:
                heapq.heappush(heap, (rank, previous, new))
    return n - merges


class _Counts(dict):
    """Tokens of a piece, counted when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> int:
        v = self.vocabulary
        symbols = list(v.in_symbols(piece))
        symbols[-1] += v.word_end
        count = merged_count([s for s in symbols if s in v.ids], v.ranks)
        if len(piece) <= _SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = count
        return count


def count_text(text: str, counts: _Counts) -> int:
    v, total = counts.vocabulary, 0
    for special, part in v.parts(text):
        total += 1 if special else sum(map(counts.__getitem__, v.pieces(v.normalise(part))))
    return total


def token_counts(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    limit: int = LIMIT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    A null text counts as an empty one: no bytes, no tokens. Special strings inside a text
    are one token each, as the library has it by default. Texts are never cut; only the id
    and the text are read, so other columns do not matter. Each row is counted on its own,
    without a shuffle.
    """
    path = vocabulary_path or default_path(VOCABULARY)

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = _Counts(load(path))
        for texts in batches:
            yield pd.Series([count_text(t, counts) for t in texts], dtype="int64")

    text = F.coalesce(F.col(text_column), F.lit(""))
    counted = docs.select(
        F.col(id_column).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        n_tokens(text).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

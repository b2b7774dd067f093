"""Operator 4: numbers of tokens by byte-pair merging that keeps no ids."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import id_and_text, table, text_slices
from corpusmill.llm.vocabularies import byte_ranks, pattern

VOCABULARY, LIMIT = "byte_bpe_50k.json", 1024
# Words whose counts a worker remembers; beyond it, it starts afresh.
REMEMBERED = 1 << 20


def merged_count(word: bytes, ranks: dict[bytes, int]) -> int:
    """Initial symbols minus merges.

    Symbols are a linked list over the word's bytes; a heap holds adjacent pairs by rank
    and place. Pairs whose symbols have been merged since are passed over when popped.
    """
    size = len(word)
    if size < 2 or word in ranks:
        return 1 if size else 0
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    # A symbol starts at its index and ends at after[index]; -1 marks one that is gone.
    heap = [(rank, i, i + 2) for i in range(size - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapify(heap)
    count = size
    while heap:
        _, i, end = heappop(heap)
        middle = after[i]
        if middle == -1 or middle >= size or after[middle] != end:
            continue
        count -= 1
        after[i], after[middle] = end, -1
        if end < size:
            before[end] = i
            if (rank := ranks.get(word[i : after[end]])) is not None:
                heappush(heap, (rank, i, after[end]))
        left = before[i]
        if left >= 0 and (rank := ranks.get(word[left:end])) is not None:
            heappush(heap, (rank, left, end))
    return count


class WordCounts(dict):
    """Remembers the count of each word it has merged."""

    def __init__(self, name: str) -> None:
        super().__init__()
        self.ranks, special = byte_ranks(name)
        self.words = regex.compile(pattern())
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        count = self[word] = merged_count(word.encode(), self.ranks)
        return count

    def of(self, text: str) -> int:
        if self.special is None or not (found := self.special.findall(text)):
            return sum(map(self.__getitem__, self.words.findall(text)))
        return len(found) + sum(sum(map(self.__getitem__, self.words.findall(part))) for part in self.special.split(text))


_KNOWN: dict[str, WordCounts] = {}


def count_tokens(
    docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: one row per input row.

    ``vocabulary`` is a byte-level one, ``.json`` or ``.tiktoken``, by public name or path.
    A missing or empty text has no bytes and no tokens; repeated rows give repeated results.
    No shuffle; a text's cost grows with its length, a long word's as n log n.
    """

    def count(batches):
        counts = _KNOWN.setdefault(vocabulary, WordCounts(vocabulary))
        for batch in text_slices(batches):
            texts = batch.column(1)
            n = np.fromiter((counts.of(body) for body in texts.to_pylist()), np.int64, batch.num_rows)
            columns = [batch.column(0), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return id_and_text(docs, doc_id, text).mapInArrow(count, schema)


def op4_token_counts(spark, folder: str) -> DataFrame:
    """``count_tokens`` over all documents."""
    return count_tokens(table(spark, folder, "documents").select(F.col("doc_id"), F.col("text")))

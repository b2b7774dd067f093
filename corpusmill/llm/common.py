"""What the operators of this folder share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.batches import text_slices  # noqa: F401
from corpusmill.session import written

# Stands for a missing document id: such rows count as one document after all others.
NO_ID = 2**63 - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, under these names; a missing text is empty."""
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, end to end, and its offsets."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class WordHashes(dict):
    """Remembers 64-bit hashes of words; starts afresh when it holds too many."""

    LIMIT = 1 << 17

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def split_words(text: str) -> list[bytes]:
    """A-Z lower-cased, cut at the white space of ASCII, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def hashed_words(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, end to end, and the number of words of each text."""
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = [h for part in words for h in map(_HASHES.__getitem__, part)]
    return np.array(flat, np.uint64), counts


def coded_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hashed_words`` of ``split_words`` of a text column: the hashes of its distinct words, which of
    them each word is, all end to end, and the number of words of each text."""
    # Its own rows alone: a kernel after a cast of a slice reads other bytes.
    split = pc.ascii_split_whitespace(pc.ascii_lower(column.take(pa.array(np.arange(len(column))))))
    words = split.flatten()
    # White space at either end of a text leaves an empty word there.
    some = pc.not_equal(pc.binary_length(words), 0)
    owner = np.repeat(np.arange(len(split)), np.diff(np.asarray(split.offsets, np.int64)))
    counts = np.bincount(owner[some.to_numpy(zero_copy_only=False)], minlength=len(split))
    coded = words.filter(some).dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    return hashes, coded.indices.to_numpy(), counts


def mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of two; not symmetric."""
    with np.errstate(over="ignore"):
        x = (a ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9) + np.asarray(b, np.uint64)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, whatever texts they are in."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    size = len(words) - n + 1
    out = words[:size]
    for k in range(1, n):
        out = mix(out, words[k : k + size])
    return out


def settle(df: DataFrame, label: str) -> DataFrame:
    """``materialize``, after which the shuffle files that led to the table are let go: Spark
    removes them once the JVM has collected what refers to them."""
    return settled(df, label)[0]


def settled(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``settle``, and the table's path for ``release``."""
    table, path = written(df, label)
    df.sparkSession.sparkContext._jvm.System.gc()
    return table, path

"""Operator 3: documents packed into sequences by a plan made from the histogram of lengths."""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import id_and_text, partitions, table, text_slices
from corpusmill.llm.vocabularies import encoder
from corpusmill.session import materialize

# Fixed values of the contract: the length of a sequence and the id that ends a document.
CONTEXT, END = 1024, 2
VOCABULARY = "byte_bpe_50k.json"

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>"


def cut_pieces(
    docs: DataFrame, context: int = CONTEXT, vocabulary: str = VOCABULARY, ids: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids``: each document's token ids, with the
    end id, in pieces of ``context`` ids of which only the first may be shorter. ``ids`` is
    null unless asked for."""

    def cut(batches):
        encode = encoder(vocabulary)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
        for batch in text_slices(batches):
            out: list[list] = [[] for _ in names]
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = np.array([*encode(body), END], dtype="<u4")
                edges = [0, *range(len(tokens) % context or context, len(tokens) + 1, context)]
                for piece, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    values = (number, piece, a, b - a, zlib.crc32(tokens[a:b].tobytes()), tokens[a:b] if ids else None)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return id_and_text(docs, doc_id, text).mapInArrow(cut, _PIECES)


def best_fit_plan(histogram: dict[int, int], context: int) -> list[tuple[int, int, int, int, int, int]]:
    """``length, low, high, first, offset, each``: pieces of ``length`` with ranks from
    ``low`` up to ``high`` go to sequences from ``first`` on, ``each`` to a sequence, the
    first of them at ``offset``.

    Best fit over counts, longest first: all pieces of a length take the fullest sequences
    that still hold one, a range of like sequences at a time, then open new ones. The number
    of ranges depends on the number of lengths, not of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []
    plan, opened = [], 0

    def add(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in room:
                room[space] = []
                spaces.insert(bisect_left(spaces, space), space)
            room[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        low, left = 0, histogram[length]
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                break
            space = spaces[at]
            first, count = room[space].pop()
            # As many as the tightest sequences take, one after the other.
            each = space // length
            full = min(count, left // each)
            if full:
                plan.append((length, low, low + full * each, first, context - space, each))
                add(space - each * length, first, full)
                low, left, first, count = low + full * each, left - full * each, first + full, count - full
            if left and count:
                plan.append((length, low, low + left, first, context - space, left))
                add(space - left * length, first, 1)
                low, left, first, count = low + left, 0, first + 1, count - 1
            if count:
                room[space].append((first, count))
            elif not room[space]:
                del room[space]
                spaces.remove(space)
        each = context // length
        full, rest = divmod(left, each)
        if full:
            plan.append((length, low, low + full * each, opened, 0, each))
            add(context - each * length, opened, full)
        if rest:
            plan.append((length, low + full * each, low + left, opened + full, 0, rest))
            add(context - rest * length, opened + full, 1)
        opened += full + (rest > 0)
    return plan


def pack(pieces: DataFrame, context: int = CONTEXT) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces of length 1 to ``context``.

    At most ``context`` counts reach the driver. A piece's rank within its length comes from
    the counts by length and bucket, so that the pieces of one length, which may be most of
    them, are spread over all buckets; then the planned slot of that rank is joined on.
    """
    spark = pieces.sparkSession
    buckets = 4 * partitions(spark)
    bucketed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = materialize(bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("_n")), "lengths")
    histogram = {int(r.length): r.n for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = best_fit_plan(histogram, context)
    schema = "length bigint, _low bigint, _high bigint, _first bigint, _offset bigint, _each bigint"
    slots = spark.createDataFrame(plan, schema)
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = bucketed.join(starts, ["length", "_bucket"]).withColumn("_rank", F.col("_start") + F.row_number().over(within) - 1)
    # The plan's size is bounded by the number of lengths.
    placed = ranked.join(F.broadcast(slots), "length").where("_low <= _rank and _rank < _high")
    turn = F.col("_rank") - F.col("_low")
    return placed.select(
        *pieces.columns,
        (F.col("_first") + F.floor(turn / F.col("_each"))).cast("bigint").alias("sequence_id"),
        (F.col("_offset") + turn % F.col("_each") * F.col("length")).cast("bigint").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, context: int = CONTEXT, vocabulary: str = VOCABULARY, ids: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The pieces of all documents with their places, see ``cut_pieces`` and ``pack``.

    A missing or empty text is one piece, the end id. Repeated rows are packed as often as
    they come; rows without an id are packed too. An empty table gives no rows.
    """
    return pack(materialize(cut_pieces(docs, context, vocabulary, ids, doc_id, text), "pieces"), context)


def op3_packing(spark, folder: str) -> DataFrame:
    """``pack_documents`` over all documents, without the ids themselves."""
    return pack_documents(table(spark, folder, "documents")).drop("ids")



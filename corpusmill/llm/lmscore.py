"""Operator 10: texts scored by a language model learned from most of them."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import coded_words, id_and_text, mix, partitions, settle, settled, table, text_slices
from corpusmill.llm.trie import NgramTrie, distinct_rows
from corpusmill.session import release, written

# Fixed values of the contract: which documents are held out.
PARTS, HELD_OUT = 7, 2
# How much the estimates after one and after two words weigh against those of the order below.
SECOND, THIRD = 0.6, 0.5
# Bytes of text in a block of documents, tokens per shard of n-grams, words of blocks per shard of words.
BLOCK_BYTES, SHARD_TOKENS, SHARD_WORDS = 6 << 20, 400_000, 1_000_000
# The n-grams of a middle word that is more frequent than this are spread over all shards, and bring the
# counts of their pairs along. The model is the same whatever the bound.
SPLIT = 150_000
# Words that no text holds: the end of a text, what comes before it, and any unknown word.
END, BEGIN, UNKNOWN, RAISED = np.uint64(1), -2, -1, 4

_BLOCKS = "block bigint, ids array<bigint>, held array<boolean>, counts array<bigint>, words array<bigint>, tokens binary"


_SQUEEZE, _EXPAND = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _squeeze(array: np.ndarray) -> bytes:
    return _SQUEEZE.compress(array.tobytes())


def _expand(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(_EXPAND.decompress(data), kind)


def token_blocks(docs: DataFrame) -> DataFrame:
    """Documents by the block: their distinct words' hashes, and all tokens as numbers of those."""

    def emit(batches):
        names = ["block", "ids", "held", "counts", "words", "tokens"]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        ids, held, counts, hashes, tokens, size = [], [], [], [], [], 0
        context, done = TaskContext.get(), 0

        def flush():
            # The end is no word: it is put in by its own number.
            words, place = np.unique(np.concatenate([[END], *hashes]), return_inverse=True)
            place, at, local = place.astype(np.int32), 1, []
            for found, which, n in zip(hashes, tokens, counts, strict=True):
                local.append(np.insert(place[at : at + len(found)][which], np.cumsum(n - 1), place[0]))
                at += len(found)
            row = [context.partitionId() << 32 | done, ids, held, np.concatenate(counts), words.view(np.int64), _squeeze(np.concatenate(local))]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in text_slices(batches):
            found, which, n = coded_words(batch.column(1))
            hashes.append(found)
            tokens.append(which)
            counts.append(n + 1)
            ids += batch.column(0).to_pylist()
            held += batch.column(2).to_pylist()
            size += batch.column(1).nbytes
            if size >= BLOCK_BYTES:
                yield flush()
                ids, held, counts, hashes, tokens, size, done = [], [], [], [], [], 0, done + 1
        if ids:
            yield flush()

    return docs.mapInArrow(emit, _BLOCKS)


def _rows(batches):
    """One row at a time, lists as arrays: a block is large."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            out = {}
            for name, column in zip(batch.schema.names, row.columns, strict=True):
                if pa.types.is_list(column.type):
                    values = column.flatten()
                    out[name] = values.to_pylist() if pa.types.is_binary(values.type) else values.to_numpy(zero_copy_only=False)
                else:
                    out[name] = column[0].as_py()
            yield out


def _groups(batches):
    """Of rows ``shard, block, data`` that come by shard: each shard with its blocks and columns."""
    current, pieces = None, []
    for batch in batches:
        for shard, block, data in zip(*(batch.column(batch.schema.names.index(n)).to_pylist() for n in ("shard", "block", "data")), strict=True):
            if shard != current and pieces:
                yield current, pieces
                pieces = []
            current = shard
            pieces.append((block, _unpack(data)))
    if pieces:
        yield current, pieces


def _word_shards(blocks: DataFrame, shards: int) -> DataFrame:
    """``shard, counts, blocks, places``: one row per range of word hashes with the training counts of
    its distinct words, and of each block the places of its own words among them."""

    def route(batches):
        for row in _rows(batches):
            local = _expand(row["tokens"], np.int32)
            words = row["words"].view(np.uint64)
            n = np.bincount(local[np.repeat(~row["held"], row["counts"])], minlength=len(words))
            # Words come sorted, so a block's words for a shard lie together.
            shard = ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
            data = [_pack(np.diff(row["words"][x:y], prepend=0), n[x:y]) for x, y in zip(edges[:-1], edges[1:], strict=True)]
            columns = [pa.array(shard[edges[:-1]]), pa.array([row["block"]] * len(data), pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "block", "data"])

    def gather(batches):
        for shard, pieces in _groups(batches):
            words = np.concatenate([np.cumsum(gaps).view(np.uint64) for _, (gaps, _) in pieces])
            distinct, which = np.unique(words, return_inverse=True)
            sums = np.bincount(which, np.concatenate([n for _, (_, n) in pieces]), len(distinct)).astype(np.int64)
            ends = np.cumsum([len(p[0]) for _, p in pieces])[:-1]
            places = [_pack(np.diff(part, prepend=0)) for part in np.split(which, ends)]
            columns = [
                pa.array([shard], pa.int64()), pa.array([_pack(sums)], pa.binary()),
                pa.array([[block for block, _ in pieces]], pa.list_(pa.int64())), pa.array([places], pa.list_(pa.binary())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "counts", "blocks", "places"])

    routed = blocks.select("block", "held", "counts", "words", "tokens").mapInArrow(route, "shard bigint, block bigint, data binary")
    placed = routed.repartition(shards, "shard").sortWithinPartitions("shard")
    return placed.mapInArrow(gather, "shard bigint, counts binary, blocks array<bigint>, places array<binary>")


def _number_words(lexicon: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``block, shard, numbers``: of a block's words in a shard their numbers from 0, the most frequent
    first; and ``n, m, first``: how many words have this count and where their numbers begin. There
    are at most about the square root of twice the tokens of these. Words that training
    documents lack have the number of the unknown word."""

    def histogram(batches):
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, m = np.unique(_unpack(data)[0], return_counts=True)
                some = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(n[some]), pa.array(np.full(some.sum(), shard)), pa.array(m[some])], names=["n", "shard", "m"])

    cells = settle(lexicon.select("shard", "counts").mapInArrow(histogram, "n bigint, shard bigint, m bigint"), "cells")
    sizes = cells.groupBy("n").agg(F.sum("m").alias("m"))
    before = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = settle(sizes.select("n", "m", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("first")), "firsts")
    inside = Window.partitionBy("n").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.join(firsts.select("n", "first"), "n").select("n", "shard", (F.col("first") + F.coalesce(F.sum("m").over(inside), F.lit(0))).alias("start"))
    by_shard = starts.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("n", "start"))).alias("starts"))

    def number(batches):
        for row in _rows(batches):
            counts = _unpack(row["counts"])[0]
            order = np.argsort(counts, kind="stable")
            ordered = counts[order]
            rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
            numbers = np.full(len(counts), UNKNOWN, np.int64)
            if (known := ordered > 0).any():
                at = np.searchsorted(row["n"], ordered[known])
                numbers[order[known]] = row["start"][at] + rank[known]
            data = [_pack(numbers[np.cumsum(_unpack(p)[0])]) for p in row["places"]]
            columns = [pa.array(row["blocks"]), pa.array([row["shard"]] * len(data), pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "shard", "numbers"])

    joined = lexicon.join(by_shard, "shard", "left").select("shard", "counts", "blocks", "places", "starts.n", "starts.start")
    return joined.mapInArrow(number, "block bigint, shard bigint, numbers binary"), firsts


class _Counts:
    """A word's training count by its number; 0 for an unknown word."""

    def __init__(self, first: np.ndarray, n: np.ndarray, tokens: int, words: int, texts: int, limit: int) -> None:
        self.first, self.n, self.tokens, self.words, self.texts, self.limit = first, n, tokens, words, texts, limit
        # Numbers are by frequency, so those of the words whose n-grams are spread come first.
        self.spread = int(first[n <= limit].min(initial=words))

    def of(self, number: np.ndarray) -> np.ndarray:
        out = np.zeros(len(number), np.int64)
        known = number >= 0
        out[known] = self.n[np.searchsorted(self.first, number[known], side="right") - 1]
        out[number == BEGIN] = self.texts
        return out

    def split(self, number: np.ndarray) -> np.ndarray:
        """Whether a middle word's n-grams are spread."""
        out = (number >= 0) & (number < self.spread)
        return out | (number == BEGIN) if self.texts > self.limit else out

    def log_single(self, number: np.ndarray) -> np.ndarray:
        return np.log10((self.of(number) + 1) / (self.tokens + self.words + 1))

    def log_second(self, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.log10(SECOND * n / self.of(b) + (1 - SECOND) * 10 ** self.log_single(c))

    def log_unseen(self, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return self.log_single(c) + np.where(self.of(b) > 0, np.log10(1 - SECOND), 0.0)


def _numbers(row: dict) -> np.ndarray:
    number = np.concatenate([_unpack(p)[0] for p in row["numbers"]])
    return number.astype(np.int32) if number.max() < 2**31 else number


def _sequences(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's tokens, in numbers: the one before the last, the last, the token; and its document."""
    number = _numbers(row)
    sizes = row["counts"]
    begin = np.cumsum(sizes) - sizes
    c = number[_expand(row["tokens"], np.int32)]
    b, a = np.roll(c, 1), np.roll(c, 2)
    b[begin] = BEGIN
    a[begin] = BEGIN
    a[begin[sizes > 1] + 1] = BEGIN
    return a, b, c, np.repeat(np.arange(len(sizes)), sizes)


def _wide_pairs(row: dict, sequences, counts: _Counts, shards: int):
    """``x, y, shard`` by shard: a block's distinct pairs with a word whose n-grams are spread; the
    places of tokens that end one, and which of these pairs each ends."""
    _, x, y, _ = sequences
    wide = np.flatnonzero((counts.split(x) | counts.split(y)) & (x != UNKNOWN) & (y != UNKNOWN))
    (px, py), at = distinct_rows(x[wide], y[wide])
    shard = (mix(px.astype(np.uint64), py.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return px[order], py[order], shard[order], wide, place[at]


def _pair_counts(ready: DataFrame, shared, shards: int) -> DataFrame:
    """``block, shard, totals``: the training counts of a block's wide pairs of a shard, in their order.
    A pair comes once from each block, however often the block holds it."""

    def route(batches):
        for row in _rows(batches):
            sequences = _sequences(row)
            x, y, shard, wide, at = _wide_pairs(row, sequences, shared.value, shards)
            n = np.bincount(at, ~row["held"][sequences[3][wide]], len(x)).astype(np.int64)
            edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)) if len(shard) else np.zeros(1, np.int64)
            data = [_pack(np.diff(x[i:j], prepend=0), y[i:j], n[i:j]) for i, j in zip(edges[:-1], edges[1:], strict=True)]
            columns = [pa.array(shard[edges[:-1]]) if data else pa.array([], pa.int64()), pa.array([row["block"]] * len(data), pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "block", "data"])

    def total(batches):
        for shard, pieces in _groups(batches):
            x, y, n = (np.concatenate([p[k] for _, p in pieces]) for k in range(3))
            edges = np.cumsum([len(p[0]) for _, p in pieces])[:-1]
            x = np.concatenate([np.cumsum(part) for part in np.split(x, edges)])
            (distinct, _), which = distinct_rows(x, y)
            sums = np.bincount(which, n, len(distinct)).astype(np.int64)[which]
            data = [_pack(part) for part in np.split(sums, edges)]
            columns = [pa.array([block for block, _ in pieces], pa.int64()), pa.array([shard] * len(data), pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "shard", "totals"])

    placed = ready.mapInArrow(route, "shard bigint, block bigint, data binary").repartition(shards, "shard").sortWithinPartitions("shard")
    return placed.mapInArrow(total, "block bigint, shard bigint, totals binary")


def _route(ready: DataFrame, shared, shards: int) -> DataFrame:
    """``shard, block, data``: each block's n-grams for each shard, sorted and squeezed: the numbers
    of ``b``, ``c``, ``a``, the document and whether it is held out; and, where ``b`` is spread,
    the training counts of ``b c`` and ``a b``."""

    def route(batches):
        counts = shared.value
        for row in _rows(batches):
            a, b, c, doc = sequences = _sequences(row)
            spread = counts.split(b)
            _, _, _, wide, at = _wide_pairs(row, sequences, counts, shards)
            total = np.zeros(len(c), np.int64)
            total[wide] = np.concatenate([np.zeros(0, np.int64), *(_unpack(p)[0] for p in row["totals"])])[at]
            # The pair before a token's own ends at the token before.
            after, context = np.where(spread, total, 0), np.where(spread, np.roll(total, 1), 0)
            # Before a text lies nothing that a pair could show.
            context[spread & (b == BEGIN)] = counts.texts
            del sequences, wide, at, total
            key = mix(b.astype(np.uint64), 5)
            key[spread] = mix(mix(key[spread], c[spread].astype(np.uint64)), a[spread].astype(np.uint64))
            shard = (key % np.uint64(shards)).astype(np.min_scalar_type(shards))
            del key
            order = np.argsort((b + np.int64(RAISED)) * np.int64(counts.words + RAISED) + (c + np.int64(RAISED)))
            order = order[np.argsort(shard[order], kind="stable")]
            edges = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0))
            shard = shard[order[edges]]
            # Gaps of sorted columns are small numbers, which squeeze well.
            columns = [b[order], c[order], a[order], (doc * 2 + row["held"][doc])[order], after[order], context[order]]
            out = [shard.astype(np.int64).tolist(), []]
            for low, high in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
                part = [v[low:high] for v in columns]
                out[1].append(_pack(*(np.diff(v, prepend=v.dtype.type(0)) if k in (0, 1, 4) else v for k, v in enumerate(part))))
            size = len(out[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array([row["block"]] * size, pa.int64()), pa.array(out[1], pa.binary())],
                names=["shard", "block", "data"],
            )

    return ready.mapInArrow(route, "shard bigint, block bigint, data binary")


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, squeezed together."""
    bodies, widths = [], []
    for values in columns:
        top = max(-int(values.min()), int(values.max())) if len(values) else 0
        width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - 1))
        # Bytes of like weight together squeeze better.
        bodies.append(np.ascontiguousarray(values.astype(f"i{width}").view(np.uint8).reshape(-1, width).T).reshape(-1))
        widths.append(width)
    body = _squeeze(np.concatenate(bodies))
    return struct.pack("<IIB", len(body), len(columns[0]), len(widths)) + bytes(widths) + body


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        size, length, columns = struct.unpack_from("<IIB", data, at)
        widths = data[at + 9 : at + 9 + columns]
        at += 9 + columns
        raw, x = _expand(data[at : at + size], np.uint8), 0
        for width in widths:
            part = raw[x : x + width * length].reshape(width, length)
            out.append(np.ascontiguousarray(part.T).view(f"i{width}").reshape(-1).astype(np.int64))
            x += width * length
        at += size
    return out


def _bases(ready: DataFrame, shared) -> DataFrame:
    """A block's documents without its tokens: what needs no more than counts of single words."""

    def bases(batches):
        counts = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = next(_rows([one.select([n for n in one.schema.names if n != "ids"])]))
                number, local, sizes = _numbers(row), _expand(row["tokens"], np.int32), row["counts"]
                doc = np.repeat(np.arange(len(sizes)), sizes)
                known = np.bincount(doc, (counts.of(number) > 0)[local], len(sizes)).astype(np.int64)
                base = np.bincount(doc, counts.log_single(number)[local], len(sizes))
                columns = [one.column(one.schema.names.index(n)) for n in ("block", "ids", "held", "counts")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([known]), pa.array([base])], names=["block", "ids", "held", "counts", "known", "base"])

    return ready.mapInArrow(bases, "block bigint, ids array<bigint>, held array<boolean>, counts array<bigint>, known array<bigint>, base array<double>")


def _documents(summed: DataFrame) -> DataFrame:
    """One row per document from its block's base and the sums that the shards made of it (``sums``)."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def documents(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                columns = [one.column(one.schema.names.index(n)).flatten() for n in ("ids", "held", "counts", "known", "base")]
                score = np.zeros(len(columns[0]))
                for part in one.column(one.schema.names.index("sums")).flatten().to_pylist():
                    gaps, logs = _unpack(part)
                    score[np.cumsum(gaps)] += logs.astype(np.int32).view(np.float32)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=names)

    return summed.mapInArrow(documents, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")


def _score_shards(routed: DataFrame, shared, shards: int) -> DataFrame:
    """``block, sums`` by shard: builds the trie of a shard's training n-grams, then scores all of its own.
    A block's sums by document are one row, as gaps and single-precision bits: rows of their
    own would be as many as a good part of the tokens."""

    def score(batches):
        counts = shared.value

        def second(b, c, n):
            return counts.log_second(b - RAISED, c - RAISED, n)

        def unseen(b, c):
            return counts.log_unseen(b - RAISED, c - RAISED)

        def finish(pieces):
            # In the trie, numbers are raised so that the marks among them count from 0 too.
            blocks = np.repeat(np.arange(len(pieces)), [len(p[0]) for _, p in pieces])
            # Columns 0, 1 and 4 are gaps.
            b, c, a, mark, after, context = (np.concatenate([np.cumsum(p[k]) if k in (0, 1, 4) else p[k] for _, p in pieces]) for k in range(6))
            names = np.array([block for block, _ in pieces], np.int64)
            pieces.clear()
            (gb, gc, ga), at = distinct_rows(b + RAISED, c + RAISED, a + RAISED)
            wide = counts.split(b)
            del b, c, a
            n = np.bincount(at, mark & 1 == 0, len(gb))
            # What a spread word's n-grams brought along; otherwise all n-grams of the word are here.
            brought = np.full((2, len(gb)), -1, np.int64)
            brought[0, at[wide]], brought[1, at[wide]] = after[wide], context[wide]
            del after, context, wide
            held = (n > 0) | (brought[0] >= 0)
            trie = NgramTrie.build(ga[held], gb[held], gc[held], n[held], second, THIRD, *brought[:, held]).mapped() if held.any() else None
            # Each n-gram is looked up once, however often it is here.
            found = np.zeros(len(gb))
            for x in range(0, len(gb), 1 << 19):
                s = slice(x, x + (1 << 19))
                found[s] = trie.score(ga[s], gb[s], gc[s], unseen, THIRD) if trie else unseen(gb[s], gc[s])
            logs = found[at]
            key, where = np.unique(blocks << 32 | mark >> 1, return_inverse=True)
            sums = np.bincount(where, logs, len(key)).astype(np.float32).view(np.int32)
            edges = np.flatnonzero(np.diff(key >> 32, prepend=-1, append=-1))
            doc = key & 0xFFFFFFFF
            data = [_pack(np.diff(doc[x:y], prepend=0), sums[x:y].astype(np.int64)) for x, y in zip(edges[:-1], edges[1:], strict=True)]
            columns = [pa.array(names[key[edges[:-1]] >> 32]), pa.array(data, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["block", "sums"])

        for _, pieces in _groups(batches):
            yield finish(pieces)

    placed = routed.repartition(max(shards, 1), "shard").sortWithinPartitions("shard")
    return placed.mapInArrow(score, "block bigint, sums binary")


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: one row per input row.

    The model interpolates relative frequencies after two words, after one, and the smoothed
    single-word estimate. It is learned from all documents that are not held out, so what is
    gathered grows with them. Words are numbered by frequency, documents are turned into
    blocks of numbers once, and each block's n-grams go, sorted and squeezed, to the shard of their
    middle word. There the trie of the shard is built and queried; sums by document come back.
    A shard's size follows from the number of shards, which follows from the tokens. The n-grams of
    a word that would fill a shard are spread by all their words and bring the counts of
    their pairs along, so the model has one rule for all words.

    A missing or empty text is its end alone. Repeated rows are learned from and scored as often
    as they come; a row without an id is not held out. An empty table gives no rows.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % PARTS == HELD_OUT, F.lit(False))
    rows = id_and_text(docs, doc_id, text).withColumn("held", held)
    blocks, first = written(token_blocks(rows), "blocks")
    per_block = F.size("words"), F.size(F.filter("held", lambda h: ~h)), F.aggregate("counts", F.lit(0).cast("bigint"), lambda x, y: x + y)
    asked, texts, every = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in per_block]).first()
    lexicon, second = written(_word_shards(blocks, max(partitions(spark), -(-asked // SHARD_WORDS))), "lexicon")
    numbered, firsts = _number_words(lexicon)
    steps = sorted((r.first, r.n, r.m) for r in firsts.collect())
    words, tokens = sum(m for _, _, m in steps), sum(n * m for _, n, m in steps)
    known = _Counts(np.array([s[0] for s in steps], np.int64), np.array([s[1] for s in steps], np.int64), tokens, words, texts, SPLIT)
    shared = spark.sparkContext.broadcast(known)
    # Both the hashes of words and the shards of them are in rising order.
    numbers = numbered.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "numbers"))).alias("parts"))
    lean = blocks.select("block", "ids", "held", "counts", "tokens")
    ready, third = settled(lean.join(numbers, "block").select("*", F.col("parts.numbers").alias("numbers")).drop("parts"), "ready")
    release(spark, first, second)
    base = settle(_bases(ready, shared), "base")
    encoded = ready.drop("ids")
    shards = max(partitions(spark), -(-every // SHARD_TOKENS))
    totals, fourth = settled(_pair_counts(encoded, shared, shards), "totals")
    found = totals.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "totals"))).alias("found"))
    totals = F.coalesce(F.col("found.totals"), F.array().cast("array<binary>")).alias("totals")
    # Written, so that the blocks are not shuffled once more beside the n-grams, which are the most there is at a time.
    asking, fifth = settled(encoded.join(found, "block", "left").select(*encoded.columns, totals), "asking")
    release(spark, third, fourth)
    sums = settle(_score_shards(_route(asking, shared, shards), shared, shards), "sums")
    release(spark, fifth)
    by_block = sums.groupBy("block").agg(F.collect_list("sums").alias("sums"))
    scored = _documents(base.join(by_block, "block"))
    return scored.withColumn("train_tokens", F.lit(tokens).cast("bigint"))


def op10_lm_scoring(spark, folder: str) -> DataFrame:
    """``score_texts`` over all documents."""
    return score_texts(table(spark, folder, "documents"))

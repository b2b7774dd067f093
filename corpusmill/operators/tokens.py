"""Vocabulary, token ids and training windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.text import word_tokens
from corpusmill.operators.batches import cut
from corpusmill.operators.ranks import running_offsets
from corpusmill.session import materialize

UNKNOWN, END_OF_TEXT, FIRST_WORD = 0, 1, 2
# The vocabulary size of the training run, and what 16-bit ids can name.
VOCABULARY = 50_257
ID_LIMIT = 1 << 16
# Tokens looked up at a time, at least one document.
_TOKENS = 1 << 18


def build_vocab(docs: DataFrame, size: int = VOCABULARY, text: str = "text") -> DataFrame:
    """``token, n, id`` of the most frequent tokens; ids 0 and 1 stand for an unknown
    token and the end of a text and count towards ``size``."""
    if size > ID_LIMIT:
        raise ValueError(f"ids have 16 bits: at most {ID_LIMIT}")
    tokens = docs.select(F.explode(word_tokens(F.col(text))).alias("token"))
    counts = materialize(tokens.groupBy("token").agg(F.count("*").alias("n")), "counts")
    wanted = size - FIRST_WORD
    # The counts' bit lengths, of which there are at most 64, tell how often a token must
    # occur to be among the first: only that many tokens are sorted, not all of each task.
    bits = F.length(F.bin("n"))
    enough = 0
    for row in sorted(counts.groupBy(bits.alias("bits")).count().collect(), reverse=True):
        enough, least = enough + row["count"], row["bits"]
        if enough >= wanted:
            counts = counts.where(bits >= least)
            break
    # The limit comes first: the window sees the vocabulary, not the corpus.
    order = [F.desc("n"), F.asc("token")]
    top = counts.orderBy(*order).limit(wanted)
    place = F.row_number().over(Window.orderBy(*order))
    return top.select("token", "n", (place - 1 + FIRST_WORD).alias("id"))


def encode_tokens(
    docs: DataFrame, vocab: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, tokens``: the ids of a document's tokens and an end-of-text id.

    The vocabulary has at most 65,536 entries, which go to every task. Tokens are cut in
    the JVM and looked up in Arrow batches; no token is shuffled.
    """
    words = [row.token for row in vocab.orderBy("id").select("token").limit(ID_LIMIT + 1).collect()]
    if len(words) + FIRST_WORD > ID_LIMIT:
        raise ValueError(f"ids have 16 bits: at most {ID_LIMIT}")
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def look_up(batches):
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            # Some at a time: ids and what leads to them are several times as many bytes as short words.
            for a, b in cut(np.asarray(pc.list_value_length(batch.column(1)).fill_null(0), np.int64), _TOKENS):
                keys, lists = (column.slice(a, b - a) for column in batch.columns)
                place = pc.index_in(lists.flatten().cast(pa.string()), value_set=known)
                ids = pc.fill_null(pc.add(place, FIRST_WORD), UNKNOWN).cast(pa.int32())
                offsets = pc.subtract(lists.offsets, lists.offsets[0]).cast(pa.int32())
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(offsets, ids)], [doc_id, "ids"])

    split = docs.select(doc_id, word_tokens(F.col(text)).alias("words"))
    kept = T.StructType([docs.schema[doc_id], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    encoded = split.mapInArrow(look_up, kept)
    return encoded.select(doc_id, F.array_append("ids", END_OF_TEXT).alias("tokens"))


def token_totals(encoded: DataFrame, tokens: str = "tokens") -> DataFrame:
    total = F.coalesce(F.sum(F.size(tokens)), F.lit(0))
    return encoded.agg(total.cast("bigint").alias("total_tokens"))


def token_windows(
    encoded: DataFrame, context: int, doc_id: str = "doc_id", tokens: str = "tokens"
) -> DataFrame:
    """``window_id, x, y``: consecutive windows of the concatenated tokens, in document
    order, with ``y`` one token ahead of ``x``. A last, short window is dropped.

    Each document hands every window it reaches into one slice, so rows are per window
    and not per token; a window gathers at most ``context + 1`` tokens. ``encoded`` is read
    twice and should be a written table.
    """
    lengths = encoded.select(doc_id, F.size(tokens).cast("bigint").alias("_length"))
    offsets = running_offsets(lengths, doc_id, "_length", "_offset")
    placed = encoded.select(doc_id, tokens).join(offsets, doc_id).where(F.size(tokens) > 0)
    # Window w takes tokens w*context .. (w+1)*context, the last one for y only.
    first = F.greatest(F.lit(0), F.floor((F.col("_offset") - 1) / context)).cast("bigint")
    last = F.floor((F.col("_offset") + F.size(tokens) - 1) / context).cast("bigint")
    reached = placed.select("_offset", tokens, F.explode(F.sequence(first, last)).alias("window_id"))
    begin = F.greatest(F.col("window_id") * context, F.col("_offset"))
    end = F.least((F.col("window_id") + 1) * context + 1, F.col("_offset") + F.size(tokens))
    local = (begin - F.col("_offset") + 1).cast("int")
    piece = F.struct(begin.alias("begin"), F.slice(tokens, local, (end - begin).cast("int")).alias("ids"))
    pieces = reached.where(end > begin).select("window_id", piece.alias("piece"))
    gathered = pieces.groupBy("window_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    stream = gathered.select("window_id", F.flatten("pieces.ids").alias("ids"))
    full = stream.where(F.size("ids") == context + 1)
    return full.select("window_id", F.slice("ids", 1, context).alias("x"), F.slice("ids", 2, context).alias("y"))


def sample_windows(windows: DataFrame, count: int, seed: int = 0) -> DataFrame:
    """A batch of ``count`` random windows."""
    from corpusmill.operators.sampling import sample_k

    return sample_k(windows, count, "window_id", seed)


# Documents and windows meet in stretches of so many tokens.
_STRETCH = 1 << 20


def index_tokens(encoded: DataFrame, doc_id: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``doc_id, offset, length, file``: where each document's tokens begin in the whole stream, how many
    there are, and the file that holds them. ``encoded`` is a written table; only lengths are moved."""
    sizes = encoded.select(
        doc_id, F.size(tokens).cast("bigint").alias("length"), F.col("_metadata.file_path").alias("file")
    )
    sizes = materialize(sizes.where("length > 0"), "lengths")
    offsets = running_offsets(sizes, doc_id, "length", "offset")
    return materialize(sizes.join(offsets, doc_id), "token-index")


def random_starts(index: DataFrame, count: int, context: int, seed: int = 0) -> DataFrame:
    """``window_id, start``: ``count`` places of the stream, drawn with replacement, at which a window
    and the token after it fit; none if it is too short."""
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    places = total - context
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id"))), 1, 15), 16, 10).cast("bigint")
    ids = index.sparkSession.range(count if places > 0 else 0)
    return ids.select(F.col("id").alias("window_id"), (drawn % max(places, 1)).alias("start"))


def read_windows(index: DataFrame, starts: DataFrame, context: int, doc_id: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``window_id, start, x, y``: the windows that begin at ``starts``, anywhere in the stream, with
    ``y`` one token ahead of ``x``.

    A window finds its documents in the index, by stretches of the stream in which both lie: a join
    of narrow rows. Only the files that hold some of them are read, and of those only the rows that
    a window touches are joined. The files' names, at most a few per window, are collected.
    """
    spark = index.sparkSession

    def stretches(begin, end):
        return F.explode(F.sequence(F.floor(begin / _STRETCH), F.floor((end - 1) / _STRETCH))).alias("stretch")

    docs = index.select(doc_id, "offset", "length", "file", stretches(F.col("offset"), F.col("offset") + F.col("length")))
    windows = starts.select("window_id", "start", stretches(F.col("start"), F.col("start") + context + 1))
    meets = (F.col("offset") < F.col("start") + context + 1) & (F.col("offset") + F.col("length") > F.col("start"))
    hits = docs.join(windows, "stretch").where(meets).drop("stretch").distinct()
    hits = materialize(hits, "window-documents")
    touched = [r.file for r in hits.select("file").distinct().collect()]
    if not touched:
        empty = "window_id bigint, start bigint, x array<int>, y array<int>"
        return spark.createDataFrame([], empty)
    held = spark.read.parquet(*touched).select(doc_id, tokens)
    begin = F.greatest("start", "offset")
    end = F.least(F.col("start") + context + 1, F.col("offset") + F.col("length"))
    local = (begin - F.col("offset") + 1).cast("int")
    piece = F.struct(begin.alias("begin"), F.slice(tokens, local, (end - begin).cast("int")).alias("ids"))
    pieces = held.join(hits, doc_id).select("window_id", "start", piece.alias("piece"))
    gathered = pieces.groupBy("window_id", "start").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    whole = gathered.select("window_id", "start", F.flatten("pieces.ids").alias("ids")).where(F.size("ids") == context + 1)
    return whole.select("window_id", "start", F.slice("ids", 1, context).alias("x"), F.slice("ids", 2, context).alias("y"))

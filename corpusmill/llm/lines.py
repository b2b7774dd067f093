"""Operator 2: lines that several documents hold, dropped by probing a sharded index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.common import NO_ID, partitions, record_batch, table, text_slices
from corpusmill.llm.perfect import PerfectHash
from corpusmill.session import materialize

# Fixed values of the contract: what is stripped off a line, and the least length of a key.
BLANK = " \t\n\x0b\x0c\r"
LEAST = 10
# Distinct lines in a shard of the index, which one task holds in memory.
SHARD_KEYS = 1 << 15
# A line that more than this share of all (line, document) rows hold is looked up where the
# document is. There are fewer such lines than this number, so their index is sent to all tasks.
HOT_LINES = 20_000

_ROW = "id bigint, h bigint, f int"


def _split(texts: pa.Array):
    """Each text's number of lines, all lines, and of those with a long enough key their
    place and their hash: 64 bits to find them by, 32 more as fingerprint."""
    pieces = pc.split_pattern(texts, "\n")
    counts = np.asarray(pc.list_value_length(pieces), dtype=np.int64)
    lines = pieces.flatten()
    keys = pc.ascii_lower(pc.utf8_trim(lines, characters=BLANK))
    place = np.flatnonzero(np.asarray(pc.greater_equal(pc.utf8_length(keys), LEAST)))
    digests = [xxhash.xxh3_128_intdigest(k) for k in keys.take(pa.array(place)).to_pylist()]
    h = np.array([d & (2**64 - 1) for d in digests], dtype=np.uint64).view(np.int64)
    f = np.array([d >> 96 for d in digests], dtype=np.uint32).view(np.int32)
    return counts, lines, place, h, f


class _Shard:
    """A perfect hash, and by its numbers: fingerprint, count and first holder of each line."""

    def __init__(self, blobs: dict) -> None:
        self.hash = PerfectHash(np.frombuffer(blobs["sizes"], np.int64), np.frombuffer(blobs["bits"], np.uint8))
        self.finger = np.frombuffer(blobs["finger"], np.int32)
        self.count = np.frombuffer(blobs["count"], np.uint8)
        self.owner = np.frombuffer(blobs["owner"], np.int64)

    @staticmethod
    def pack(h, f, several, owner) -> dict:
        # Two lines whose 64 bits are equal but whose fingerprints are not share a number; the
        # first takes it, the other is never found and so stays.
        index = PerfectHash.build(h.view(np.uint64))
        number = index.number(h.view(np.uint64))
        number, first = np.unique(number, return_index=True)
        return {
            "sizes": index.sizes.tobytes(),
            "bits": index.bits.tobytes(),
            "finger": f[first].astype(np.int32).tobytes(),
            "count": several[first].astype(np.uint8).tobytes(),
            "owner": owner[first].astype(np.int64).tobytes(),
        }

    def probe(self, h: np.ndarray, f: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which lines the index knows, and which of these are to be dropped."""
        if not len(self.finger):
            return np.zeros(len(h), bool), np.zeros(len(h), bool)
        number = self.hash.number(h.view(np.uint64))
        safe = np.maximum(number, 0)
        known = (number >= 0) & (self.finger[safe] == f)
        return known, known & (self.count[safe] > 1) & (self.owner[safe] != ids)


_BLOBS = ("sizes", "bits", "finger", "count", "owner")
_SHARD = "shard bigint, sizes binary, bits binary, finger binary, count binary, owner binary"


def _emit_rows(batches):
    """``id, h, f`` of the distinct long lines of each row."""
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("f", pa.int32())])
    for batch in text_slices(batches):
        counts, _, place, h, f = _split(batch.column(1))
        row = np.repeat(np.arange(len(counts)), counts)[place]
        ids = np.asarray(batch.column(0), dtype=np.int64)[row]
        _, first = np.unique(np.column_stack([row, h]), axis=0, return_index=True)
        yield record_batch(schema, ids[first], h[first], f[first])


def line_index(rows: DataFrame) -> tuple[DataFrame, dict, int]:
    """The index of ``id, h, f``: a table of shards, the shard of the hot lines, the number
    of shards. Counts need telling one document from several only."""
    counted = rows.groupBy("h", "f").agg(F.count("*").alias("n"), F.min("id").alias("owner"), F.max("id").alias("last"))
    counted = materialize(counted.withColumn("several", F.when(F.col("owner") < F.col("last"), 2).otherwise(1)), "lines")
    total, distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    hot_rows = counted.where(F.col("n") > max(total / HOT_LINES, 1)).select("h", "f", "several", "owner").collect()
    columns = list(zip(*hot_rows, strict=True)) or [[], [], [], []]
    kinds = (np.int64, np.int32, np.uint8, np.int64)
    hot = _Shard.pack(*(np.array(c, dtype=k) for c, k in zip(columns, kinds, strict=True)))
    shards = max(4 * partitions(rows.sparkSession), -(-distinct // SHARD_KEYS))

    def build(key, group):
        arrays = {n: group.column(n).to_numpy() for n in ("h", "f", "several", "owner")}
        blobs = _Shard.pack(arrays["h"], arrays["f"], arrays["several"], arrays["owner"])
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), **{n: pa.array([blobs[n]], pa.binary()) for n in _BLOBS}})

    cold = counted.where(F.col("n") <= max(total / HOT_LINES, 1)).withColumn("shard", F.pmod("h", F.lit(shards)))
    return cold.groupBy("shard").applyInArrow(build, _SHARD), hot, shards


def _dropped(docs: DataFrame, shards_table: DataFrame, hot: dict, shards: int) -> DataFrame:
    """``id, hashes``: the lines each document loses."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(hot)

    def probe_hot(batches):
        schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("f", pa.int32()), ("drop", pa.bool_())])
        shard = _Shard(shared.value)
        for batch in _emit_rows(batches):
            ids, h, f = (batch.column(i).to_numpy() for i in range(3))
            known, drop = shard.probe(h, f, ids)
            yield record_batch(schema, ids, h, f, pa.array(drop, mask=~known)).filter(pa.array(~known | drop))

    probes = docs.select("id", "text").mapInArrow(probe_hot, _ROW + ", drop boolean")
    found = probes.where("drop").select("id", "h")
    empty = [F.lit(None).cast("binary").alias(n) for n in _BLOBS]
    asked = probes.where("drop is null").select(F.pmod("h", F.lit(shards)).alias("shard"), "id", "h", "f", *empty)
    nothing = [F.lit(None).cast(k).alias(n) for n, k in (("id", "bigint"), ("h", "bigint"), ("f", "int"))]
    index = shards_table.select("shard", *nothing, *_BLOBS)
    # A shard's arrays come before the lines that are looked up in it, which stream by.
    both = index.unionByName(asked).repartition(partitions(spark), "shard").sortWithinPartitions("shard", F.col("h").asc_nulls_first())

    def probe(batches):
        schema = pa.schema([("id", pa.int64()), ("h", pa.int64())])
        shard = None
        for batch in batches:
            names = batch.schema.names
            at = {n: batch.column(names.index(n)) for n in names}
            opens = np.flatnonzero(np.asarray(at["sizes"].is_valid()))
            edges = [0, *opens.tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a in opens:
                    shard = _Shard({n: at[n][a].as_py() for n in _BLOBS})
                    a += 1
                if a < b and shard is not None:
                    ids, h, f = (at[n].slice(a, b - a).to_numpy() for n in ("id", "h", "f"))
                    drop = shard.probe(h, f, ids)[1]
                    yield record_batch(schema, ids[drop], h[drop])

    cold = both.mapInArrow(probe, "id bigint, h bigint")
    return found.unionByName(cold).groupBy("id").agg(F.collect_set("h").alias("hashes"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, kept, n_lines, n_dropped``: the input row as it was (a struct of all its columns),
    its text without the lines to be dropped, and the numbers of lines before and dropped.

    A line's key is the line stripped and with A-Z lower-cased. A key of at least ten code
    points that two or more documents hold stays only in the one with the smallest id, with
    all its repeats there. A missing or empty text is one empty line. Rows with the same id are
    one document; rows without an id are one document after all others. Every row stays.

    Distinct line hashes are numbered by a minimal perfect hash per shard of the hash space,
    over arrays of fingerprints, counts and holders. Lines are hashed where the text is; the
    hashes go to their shard and look themselves up there, streaming past its arrays, and
    only those to be dropped come back. Texts move once, to meet their list.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    shards_table, hot, shards = line_index(rows.select("id", "text").mapInArrow(_emit_rows, _ROW))
    dropped = _dropped(rows, shards_table, hot, shards)
    kept = T.StructType(
        [rows.schema["row"], T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )

    def rewrite(batches):
        for batch in text_slices(batches):
            names = batch.schema.names
            texts, lists = (batch.column(names.index(n)) for n in ("text", "hashes"))
            counts = np.ones(batch.num_rows, np.int64)
            lost = np.zeros(batch.num_rows, np.int64)
            out = texts.to_pylist()
            some = np.flatnonzero(np.asarray(lists.is_valid()))
            counts = np.asarray(pc.add(pc.count_substring(texts, "\n"), 1), dtype=np.int64)
            if len(some):
                sizes, lines, place, h, _ = _split(texts.take(pa.array(some)))
                lines, begin = lines.to_pylist(), np.concatenate([[0], np.cumsum(sizes)])
                cut = np.searchsorted(place, begin)
                for k, row in enumerate(some.tolist()):
                    a, b = cut[k], cut[k + 1]
                    gone = set(place[a:b][np.isin(h[a:b], np.array(lists[row].as_py(), np.int64))].tolist())
                    lost[row] = len(gone)
                    out[row] = "\n".join(lines[i] for i in range(begin[k], begin[k + 1]) if i not in gone)
            columns = [batch.column(names.index("row")), pa.array(out, pa.string()), pa.array(counts), pa.array(lost)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "kept", "n_lines", "n_dropped"])

    return rows.join(dropped, "id", "left").select("row", "text", "hashes").mapInArrow(rewrite, kept)


def op2_line_dedup(spark, folder: str) -> DataFrame:
    """The digest of ``dedup_lines`` over all documents."""
    done = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def dedup_sql(source: str, columns: str) -> str:
    """``columns`` of ``source`` with ``kept``, ``n_lines`` and ``n_dropped``."""
    return f"""
    WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {source}),
    lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split),
    keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACE})")} AS key FROM lines),
    shared AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= {LEAST}
        GROUP BY key HAVING count(DISTINCT doc_id) > 1),
    judged AS (SELECT k.doc_id, k.line, k.pos, coalesce(s.owner <> k.doc_id, false) AS gone
        FROM keyed k LEFT JOIN shared s ON k.key = s.key),
    rebuilt AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM judged GROUP BY doc_id)
    SELECT {columns} FROM rebuilt JOIN {source} USING (doc_id)"""


SQL = dedup_sql("documents", "doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256")


"""Operator 12: words of one edit's distance, by a bit-sliced index of positions and letters."""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import partitions, record_batch, table, text_slices
from corpusmill.operators.skew import HEAVY_KEYS, join_counted
from corpusmill.session import materialize

LEAST, TWICE, RATIO, TYPO = 7, 2, 10, 31
_RUN = re.compile("[a-zÀ-ÿ]+")
# Words counted in a worker before their counts are passed on; rows indexed together; units
# (a word and 64 others) compared together; positions indexed at a time.
COUNTED, TOGETHER, UNITS, WINDOW = 1 << 19, 1 << 15, 1 << 15, 64
# Words of a shard beyond which it is cut finer.
CROWD = 4096


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: lower-cased (A-Z) runs of letters of at least ``LEAST`` code points, and how often
    each is met. A run whose hash with its document's id is divisible by ``TYPO`` lacks a letter."""

    def count(batches):
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
        seen: Counter = Counter()
        for batch in text_slices(batches):
            for key, body in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                # Bytes are lower-cased in A-Z alone.
                runs = Counter(_RUN.findall(body.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                head = f"{'' if key is None else key}:"
                for run, n in runs.items():
                    h = crc32((head + run).encode())
                    if h % TYPO == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= LEAST:
                        seen[run] += n
                if len(seen) >= COUNTED:
                    yield record_batch(schema, list(seen), list(seen.values()))
                    seen = Counter()
        yield record_batch(schema, list(seen), list(seen.values()))

    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    return whole.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _pieces(word: Column, s: Column) -> list[Column]:
    """What two words of which the shorter has ``s`` letters share, if one edit parts them: all but the
    last third, all but the first third, or both outer thirds."""
    third = F.floor(s / 3).cast("int")
    most, size = s - third, F.length(word)
    outer = F.concat(F.substring(word, F.lit(1), third), F.lit(" "), F.substring(word, size - third + 1, third))
    return [F.substring(word, F.lit(1), most), F.substring(word, size - most + 1, most), outer]


def _shards(words: DataFrame) -> DataFrame:
    """``key, s, kind, word, n``: each word in the shards where it meets its near words."""

    def members(s):
        return F.array(
            *[
                F.struct(F.xxhash64(s, F.lit(kind), piece).alias("key"), s.alias("s"), F.lit(kind).alias("kind"))
                for kind, piece in enumerate(_pieces(F.col("word"), s), 1)
            ]
        )

    size = F.length("word")
    both = F.when(size > LEAST, F.concat(members(size), members(size - 1))).otherwise(members(size))
    return words.select("word", "n", F.inline(both)).select("key", "s", "kind", "word", "n")


def _finer(rows: DataFrame) -> DataFrame:
    """Crowded shards by one letter at a time: words that are the same but for the letter at one
    place, and words that are the same when the longer lacks one. The alphabet bounds these."""
    word, size = F.col("word"), F.length("word")
    places = F.sequence(F.lit(1), size)

    def without(i):
        return F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, size))

    swapped = F.transform(places, lambda i: F.xxhash64("key", i, without(i)))
    itself = F.array(F.xxhash64("key", F.lit(0), word))
    lacking = F.array_distinct(F.transform(places, lambda i: F.xxhash64("key", F.lit(0), without(i))))
    keys = F.when(size == F.col("s"), F.concat(swapped, itself)).otherwise(lacking)
    return rows.select(F.explode(keys).alias("key"), "s", "kind", "word", "n")


def _lanes(sizes: np.ndarray) -> np.ndarray:
    """The first bit of each shard: small ones share 64 bits, larger ones begin 64 of their own."""
    firsts, at = [], 0
    for size in sizes.tolist():
        if at % 64 + size > 64:
            at = -(-at // 64) * 64
        firsts.append(at)
        at += size
    return np.array(firsts, np.int64)


def near_pairs(words: list[str], shard: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one shard that a single edit parts, of which the shorter has ``s`` letters.

    ``words`` have ``s`` or ``s + 1`` letters; rows of a shard follow each other. For every place and
    letter a set of bits holds the words with that letter there. Along a word of ``s`` letters three sets
    are carried for 64 words at once: those like it so far, those with one other letter, those
    with one more, which are read one place further on. Words that lack a letter are the last from
    the other side. Places are indexed some at a time, so memory does not grow with the length.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1))
    counts = np.diff(begins, append=len(words))
    firsts = _lanes(counts)
    bit = np.repeat(firsts, counts) + np.arange(len(words)) - np.repeat(begins, counts)
    lanes = int(bit[-1]) // 64 + 1
    row_at = np.full(lanes * 64, -1, np.int64)
    row_at[bit] = np.arange(len(words))
    one = np.uint64(1) << (bit % 64).astype(np.uint64)
    letters, codes = np.unique(np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    longer = np.zeros(lanes, np.uint64)
    np.bitwise_or.at(longer, bit[sizes > s] // 64, one[sizes > s])
    # A unit is a word of s letters and one lane of its shard.
    owner = np.repeat(np.arange(len(begins)), counts)
    asking = np.flatnonzero(sizes == s)
    first, last = firsts[owner[asking]] // 64, (firsts + counts - 1)[owner[asking]] // 64
    span = last - first + 1
    unit_row = np.repeat(asking, span)
    unit_lane = np.repeat(first, span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
    # A small shard's own bits.
    inside = np.zeros(len(begins), np.uint64)
    np.bitwise_or.at(inside, owner, one)
    whole = (counts > 64)[owner[unit_row]]
    present = np.zeros(lanes, np.uint64)
    np.bitwise_or.at(present, bit // 64, one)
    member = np.where(whole, present[unit_lane], inside[owner[unit_row]])
    # The last lane of a large shard may hold small ones too.
    if whole.any():
        end = (firsts + counts)[owner[unit_row]] - unit_lane * 64
        partial = whole & (end < 64)
        member[partial] &= (np.uint64(1) << end[partial].astype(np.uint64)) - np.uint64(1)
    same, other, more = member.copy(), np.zeros_like(member), np.zeros_like(member)
    by_bit = [np.flatnonzero(bit % 64 == b) for b in range(64)]
    for low in range(0, s, WINDOW):
        places = min(WINDOW, s - low)
        index = np.zeros((places + 1, len(letters), lanes), np.uint64)
        for rows in by_bit:
            # One row a lane has this bit, so no cell is named twice.
            for p in range(places + 1):
                has = rows[sizes[rows] > low + p]
                index[p, codes[starts[has] + low + p], bit[has] // 64] |= one[has]
        flat, stride = index.reshape(-1), len(letters) * lanes
        for a in range(0, len(unit_row), UNITS):
            z, x, m = same[a : a + UNITS], other[a : a + UNITS], more[a : a + UNITS]
            at, lane = starts[unit_row[a : a + UNITS]] + low, unit_lane[a : a + UNITS]
            for p in range(places):
                cell = codes[at + p] * lanes + lane + p * stride
                here, next_ = flat[cell], flat[cell + stride]
                x[:] = (x & here) | (z & ~here)
                m[:] = (m | z) & next_
                z &= here
    found = (other & ~longer[unit_lane]) | ((more | same) & longer[unit_lane])
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    hits = np.flatnonzero(found)
    for a in range(0, len(hits), UNITS):
        part = hits[a : a + UNITS]
        unit, place = np.nonzero(np.unpackbits(found[part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        u, v = unit_row[part[unit]], row_at[unit_lane[part[unit]] * 64 + place]
        extra = sizes[v] > s
        left += [u, v[extra]]
        right += [v, u[extra]]
    return np.concatenate(left), np.concatenate(right)


_MATCHES = "word string, near bigint, form_n bigint, form string"


def _match(batches):
    """Rows in order of ``s, key, word``: for each word of a shard the number of its near words there
    and the most frequent of them."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])

    def settle(rows: pa.Table):
        keys, kinds = rows.column("key").to_numpy(), rows.column("kind").to_numpy()
        n, words, s = rows.column("n").to_numpy(), rows.column("word").to_pylist(), int(rows.column("s")[0].as_py())
        u, v = near_pairs(words, np.cumsum(np.diff(keys, prepend=keys[0]) != 0), s)
        # A pair is counted in the first kind of shard where it meets.
        most = s - s // 3
        start = np.array([hash(w[:most]) for w in words])
        end = np.array([hash(w[-most:]) for w in words])
        again = (kinds[u] > 1) & (start[u] == start[v]) | (kinds[u] > 2) & (end[u] == end[v])
        u, v = u[~again], v[~again]
        # Most frequent first; rows of a shard are in the order of words.
        order = np.lexsort((np.arange(len(n)), -n))
        rank = np.empty(len(n), np.int64)
        rank[order] = np.arange(len(n))
        best = np.full(len(n), len(n), np.int64)
        np.minimum.at(best, u, rank[v])
        near = np.bincount(u, minlength=len(n))
        met = np.flatnonzero(near)
        form = order[best[met]]
        return record_batch(schema, [words[i] for i in met.tolist()], near[met], n[form], [words[i] for i in form.tolist()])

    def paired(rows: pa.Table) -> pa.Table:
        """Without shards of one word."""
        keys = rows.column("key").to_numpy()
        new = np.diff(keys, prepend=keys[0] - 1) != 0
        return rows.filter(pa.array(~(new & np.append(new[1:], True))))

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < TOGETHER:
            continue
        rows = pa.concat_tables(held)
        # The last shard may go on.
        keys = rows.column("key").to_numpy()
        done = int(np.flatnonzero(np.diff(keys, prepend=keys[0]) != 0)[-1]) if (keys != keys[0]).any() else 0
        held = [rows.slice(done)]
        yield from map(settle, _by_size(paired(rows.slice(0, done))))
    if held:
        yield from map(settle, _by_size(paired(pa.concat_tables(held))))


def _by_size(rows: pa.Table):
    """Rows of one ``s`` each; fewer where words are long."""
    if not rows.num_rows:
        return
    sizes = rows.column("s").to_numpy()
    keys = rows.column("key").to_numpy()
    edges = np.flatnonzero(np.diff(sizes) != 0) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(sizes)], strict=True):
        heads = a + np.flatnonzero(np.diff(keys[a:b], prepend=keys[a] - 1))
        limit, low = max(1, (1 << 21) // int(sizes[a])), a
        for head, end in zip(heads.tolist(), [*heads[1:].tolist(), b], strict=True):
            if end - low > limit and head > low:
                yield rows.slice(low, head - low)
                low = head
        yield rows.slice(low, b - low)


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``word, n, n_near, best``: for each of the distinct words the number of others one edit away, and
    the most frequent of them (``best.form``, ``-best.less`` times; ties: the first in code points).

    Two words that one edit parts share two thirds of their letters, in one of three ways. So each word goes to six
    small shards, by hash, where all its near words meet it. A shard of more than ``crowd`` words is cut
    by single letters; then the alphabet bounds it, whatever the words. Exact at every size.
    """
    rows = _shards(words)
    sizes = rows.groupBy("key").agg(F.count("*").alias("z"))
    crowded = materialize(sizes.where(F.col("z") > crowd), "spelling-crowds")
    total = 6 * words.count()
    # Fewer than HEAVY_KEYS shards can hold so much, so these are sent to every task.
    heavy = crowded.where(F.col("z") > max(total // HEAVY_KEYS, 1))
    calm = rows.join(F.broadcast(heavy.select("key")), "key", "left_anti").join(crowded.select("key"), "key", "left_anti")
    finer = _finer(join_counted(rows, crowded, "key", total, "z").drop("z"))
    met = calm.unionByName(finer).repartition(partitions(words.sparkSession), "key")
    matches = met.sortWithinPartitions("s", "key", "word").mapInArrow(_match, _MATCHES)
    best = F.struct((-F.col("form_n")).alias("less"), "form")
    none = F.lit(None).cast("struct<less:bigint,form:string>")
    both = words.select("word", "n", F.lit(0).cast("bigint").alias("near"), none.alias("best")).unionByName(
        matches.select("word", F.lit(None).cast("bigint").alias("n"), "near", best.alias("best"))
    )
    return both.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))


def group_spellings(words: DataFrame, ratio: int = RATIO, crowd: int = CROWD) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words with their counts ``n``.

    A word's form is its most frequent near word if that is at least ``ratio`` times as frequent;
    its root is where forms lead to. Along forms counts grow ``ratio``-fold, so there are few rounds.
    Words need ``LEAST`` letters, a proof that their thirds are not empty. Missing
    words and counts do not come up; an empty table gives no rows.
    """
    near = near_words(words, crowd)
    taken = -F.col("best.less") >= ratio * F.col("n")
    named = near.select(
        "word",
        F.when(taken, F.col("best.form")).alias("form"),
        "n",
        "n_near",
        F.when(taken, -F.col("best.less")).alias("form_n"),
    )
    named = materialize(named, "spelling-forms")
    step = named.where("form is not null").select(F.col("word").alias("root"), F.col("form").alias("next"))
    roots = step.select(F.col("root").alias("word"), F.col("next").alias("root"))
    moving = True
    while moving:
        moved = roots.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = materialize(moved, "spelling-roots")
        moving, roots = not moved.where("moved").isEmpty(), moved.drop("moved")
    done = named.join(roots, "word", "left")
    return done.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, folder: str) -> DataFrame:
    """Forms and roots of all words that documents hold at least twice.

    Missing texts have no words; a missing id hashes as an empty one; repeated rows count again; runs
    of letters of any length are words.
    """
    words = count_words(table(spark, folder, "documents")).where(F.col("n") >= TWICE)
    return group_spellings(materialize(words, "spelling-words"))


SQL = f"""
WITH RECURSIVE crcs AS (
    SELECT list(list_reduce(list_prepend(b, range(8)),
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS tab
    FROM range(256) t(b)
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, xor(list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
            lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [(192 + ord(x) // 64)::BIGINT, (128 + ord(x) % 64)::BIGINT] END))),
        lambda c, x: xor(c // 256, tab[xor(c % 256, x) + 1])), 4294967295) AS h
    FROM counted, crcs
), changed AS (
    SELECT n, CASE WHEN h % {TYPO} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= {LEAST} GROUP BY word HAVING sum(n) >= {TWICE}
), places AS (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), lacking AS (
    SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM places
), pairs AS (
    SELECT a.word, b.word AS other, b.n FROM lacking a JOIN lacking b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM lacking a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM lacking a JOIN words b ON a.rest = b.word
), ranked AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place FROM pairs
), named AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= {RATIO} * w.n THEN r.other END AS form,
        CASE WHEN r.n >= {RATIO} * w.n THEN r.n END AS form_n
    FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1
), ways AS (
    SELECT word, word AS root, form AS next FROM named
    UNION ALL SELECT w.word, w.next, n.form FROM ways w JOIN named n ON w.next = n.word
)
SELECT n.word, form, root, n, n_near, form_n FROM named n JOIN ways w ON n.word = w.word AND w.next IS NULL
"""

"""Operator 9: documents linked by the Jaccard similarity of their four-word shingles, exactly."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import NO_ID, hashed_words, mix, partitions, settle, shingles, split_words, table, text_slices
from corpusmill.operators.components import connected_components
from corpusmill.operators.skew import join_counted

# Fixed values of the contract: words of a shingle; 100 * shared >= LIKE * union.
SHINGLE, LIKE = 4, 85
# Sets and shingles in a block of sets that one task searches; turns of single comparisons go on
# while one in so many links. None of these changes a result.
MEMBERS, GRAMS, WORTH = 1000, 2_000_000, 4


def shingle_sets(bodies: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes; a shorter text has one, of all its words."""
    split = [split_words(b) for b in bodies]
    words, counts = hashed_words(split)
    every, begin, out = shingles(words, SHINGLE), np.cumsum(counts) - counts, []
    for at, n in zip(begin.tolist(), counts.tolist(), strict=True):
        if n >= SHINGLE:
            out.append(np.unique(every[at : at + n - SHINGLE + 1]))
        elif n:
            whole = np.full(1, n, np.uint64)
            for word in words[at : at + n]:
                whole = mix(whole, word)
            out.append(whole)
        else:
            out.append(words[:0])
    return out


def least_overlap(size, like: int = LIKE):
    """Shingles that a set of this size shares with any set it is linked to, at least."""
    return -(-like * size // 100)


def _key(grams: np.ndarray) -> int:
    """A set's own hash."""
    with np.errstate(over="ignore"):
        total = mix(grams, 77).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total, len(grams)).view(np.int64)[0])


def _keys(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, key``."""

    def emit(batches):
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column(1).to_pylist())
            arrays = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_key(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "key"])

    return docs.mapInArrow(emit, "doc_id bigint, n_shingles bigint, key bigint")


def _heads(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, n, gram``: of each set in ``wanted`` (``key, doc_id``) its first shingles by hash.
    Linked sets share at least ``1 + n // 16`` of those for the smaller ``n``, whatever the
    others are."""

    def emit(batches):
        for batch in text_slices(batches):
            at = batch.schema.names.index
            sets = shingle_sets(batch.column(at("text")).to_pylist())
            chosen = [(k, s) for s, found in zip(sets, batch.column(at("keys")).to_pylist(), strict=True) if (k := _key(s)) in (found or (k,)) and len(s)]
            sizes = np.array([len(s) for _, s in chosen], np.int64)
            lengths = np.minimum(sizes - least_overlap(sizes) + 1 + sizes // 16, sizes)
            grams = np.concatenate([s[:k] for (_, s), k in zip(chosen, lengths.tolist(), strict=True)] or [np.zeros(0, np.uint64)])
            keys = np.array([k for k, _ in chosen], np.int64)
            arrays = [pa.array(np.repeat(keys, lengths)), pa.array(np.repeat(sizes, lengths)), pa.array(grams.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "n", "gram"])

    return _holding(docs, wanted).mapInArrow(emit, "key bigint, n bigint, gram bigint")


def _holding(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``text, keys`` of the documents that stand for a set in ``wanted``; of all rows without an id
    the text alone, since no id tells which set is whose."""
    lists = wanted.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    nameless = docs.where("doc_id IS NULL").select("text", F.lit(None).cast("array<bigint>").alias("keys"))
    return docs.join(lists, "doc_id").select("text", "keys").unionByName(nameless)


def _sets_of(docs: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """``key, n, grams`` of the sets in ``wanted`` (``key, doc_id``), from the documents."""
    def emit(batches):
        for batch in text_slices(batches):
            at = batch.schema.names.index
            sets = shingle_sets(batch.column(at("text")).to_pylist())
            keys, out = [], []
            for grams, found in zip(sets, batch.column(at("keys")).to_pylist(), strict=True):
                key = _key(grams)
                if len(grams) and (found is None or key in found):
                    keys.append(key)
                    out.append(grams.view(np.int64))
            arrays = [pa.array(keys, pa.int64()), pa.array([len(g) for g in out], pa.int64()), pa.array(out, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "n", "grams"])

    found = _holding(docs, wanted).mapInArrow(emit, "key bigint, n bigint, grams array<bigint>")
    # Rows with the same id may hold the same set twice, rows without an id any set.
    return found.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]) if repeated else found


def _occurrences(n: int, lists: list[np.ndarray], sizes: np.ndarray, wanted: np.ndarray | None = None, like: int = LIKE) -> np.ndarray:
    """T-occurrence search by DivideSkip: the sets that share enough with a query of ``n`` shingles,
    given the sorted list of holders of each of its shingles that has any.

    The longest lists, one fewer than the occurrences a result needs at least, are put aside. The
    others are merged by a heap; the sets met in them (those ``wanted``) are then looked for in the
    long lists by binary search, as long as they can still reach the occurrences that their own size
    asks for.
    """
    lists = sorted(lists, key=len)
    aside = min(least_overlap(n, like) - 1, len(lists))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    counts: dict[int, int] = {}
    for candidate in heapq.merge(*[postings.tolist() for postings in short]):
        counts[candidate] = counts.get(candidate, 0) + 1
    met = np.fromiter(counts.keys(), np.int64, len(counts))
    count = np.fromiter(counts.values(), np.int64, len(counts))
    if wanted is not None:
        met, count = met[wanted[met]], count[wanted[met]]
    # 100 * shared >= like * (both - shared)
    needed = -(-like * (n + sizes[met]) // (100 + like))
    for left, postings in zip(range(len(long), 0, -1), long, strict=True):
        able = count + left >= needed
        met, count, needed = met[able], count[able], needed[able]
        if (count >= needed).all():
            break
        at = np.minimum(np.searchsorted(postings, met), len(postings) - 1)
        count += postings[at] == met
    return met[count >= needed]


def divide_skip(query: np.ndarray, sets: list[np.ndarray], like: int = LIKE) -> list[int]:
    """Which of ``sets`` are linked to ``query``; only lists of the query's own shingles are made."""
    tokens = np.concatenate(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owners = np.repeat(np.arange(len(sets)), sizes)
    place = np.searchsorted(query, tokens)
    held = query[np.minimum(place, len(query) - 1)] == tokens
    order = np.lexsort((owners[held], place[held]))
    edges = np.flatnonzero(np.diff(place[held][order], prepend=-1, append=-1))
    lists = np.split(owners[held][order], edges[1:-1]) if len(order) else []
    return sorted(_occurrences(len(query), lists, sizes, None, like).tolist())


def search_block(sets: list[np.ndarray], components: list, asks: np.ndarray, listed: np.ndarray, like: int = LIKE):
    """``(i, j)`` of linked sets, one that asks and one that is listed, enough of them to connect all
    that such links connect. ``components`` are what earlier links connect; a set isn't compared with
    those that it is connected to already."""
    sizes = np.array([len(s) for s in sets], np.int64)
    holders = np.flatnonzero(listed)
    tokens = np.concatenate([sets[i] for i in holders])
    owners = np.repeat(holders, sizes[holders])
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    distinct, ends = tokens[starts], np.append(starts[1:], len(tokens))
    _, root = np.unique(np.array(components, np.int64), return_inverse=True)
    both = bool((asks & listed).any())
    for i in np.flatnonzero(asks).tolist():
        # What both sides list is asked for once.
        wanted = (root != root[i]) & (np.minimum(sizes, sizes[i]) * 100 >= like * np.maximum(sizes, sizes[i]))
        if both:
            wanted[: i + 1] = False
        if not wanted[holders].any():
            continue
        at = np.minimum(np.searchsorted(distinct, sets[i]), len(distinct) - 1)
        lists = [owners[starts[p] : ends[p]] for p in at[distinct[at] == sets[i]].tolist()]
        for j in _occurrences(int(sizes[i]), lists, sizes, wanted, like).tolist():
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                yield i, j


def _compare(pairs: DataFrame, sets: DataFrame, like: int) -> DataFrame:
    """``leader, key`` of the pairs that are linked. Pairs come by leader, so that one search
    serves many of them; a leader's pairs need not lie together."""
    joined = pairs.join(sets.select("key", F.col("grams").alias("b")), "key")
    joined = joined.join(sets.select(F.col("key").alias("leader"), F.col("grams").alias("a")), "leader")

    def judge(batches):
        for batch in batches:
            at = batch.schema.names.index
            leaders, keys = (np.asarray(batch.column(at(n)), np.int64) for n in ("leader", "key"))
            first, out = {}, [[], []]
            for row, leader in enumerate(leaders.tolist()):
                first.setdefault(leader, []).append(row)
            values = {c: (batch.column(at(c)).flatten().to_numpy().view(np.uint64), np.asarray(batch.column(at(c)).offsets, np.int64) - batch.column(at(c)).offsets[0].as_py()) for c in "ab"}

            def grams(c, row, values=values):
                flat, offsets = values[c]
                return flat[offsets[row] : offsets[row + 1]]

            for leader, rows in first.items():
                for hit in divide_skip(grams("a", rows[0]), [grams("b", r) for r in rows], like):
                    out[0].append(leader)
                    out[1].append(int(keys[rows[hit]]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["leader", "key"])

    return joined.select("leader", "key", "a", "b").mapInArrow(judge, "leader bigint, key bigint")


def _fits(a: Column, b: Column) -> Column:
    """Sizes that allow a link."""
    return (100 * F.least(a, b)) >= (LIKE * F.greatest(a, b))


def _active(heads: DataFrame) -> DataFrame:
    """``key`` of the sets that share enough of their heads with sets of a like size."""
    near = Window.partitionBy("gram").orderBy("n", "key")
    # `least` and `greatest` pass over nulls: without a neighbour the set's own size would fit itself.
    sides = [side("n").over(near) for side in (F.lag, F.lead)]
    met = sides[0].isNotNull() & _fits(sides[0], F.col("n")) | sides[1].isNotNull() & _fits(sides[1], F.col("n"))
    shared = heads.withColumn("met", met).where("met").groupBy("key", "n").agg(F.count("*").alias("m"))
    # The other set may be smaller, and its head then shorter.
    return shared.where(F.col("m") >= 1 + F.floor(LIKE * F.col("n") / 1600)).select("key")


def _short_lists(sets: DataFrame) -> DataFrame:
    """``gram, key, n, at``: the rarest shingles of each set, so many that two linked sets share
    one, with their place among all of the set's by frequency. Sets that share too few of
    their shingles with any others are left out."""
    rows = sets.select("key", "n", F.explode("grams").alias("gram"))
    held = rows.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    shared = rows.join(held, "gram")
    order = Window.partitionBy("key").orderBy("df", "gram")
    total = F.count("*").over(Window.partitionBy("key"))
    placed = shared.select("gram", "key", "n", total.alias("m"), F.row_number().over(order).alias("rank"))
    least = F.ceil(LIKE * F.col("n") / 100)
    placed = placed.where(F.col("m") >= least).withColumn("at", F.col("n") - F.col("m") + F.col("rank"))
    return placed.where(F.col("at") <= F.col("n") - least + 1).select("gram", "key", "n", "at")


def _asked(lists: DataFrame, known: DataFrame | None, tested: DataFrame | None, turn: int) -> DataFrame:
    """``leader, key``: for each set one leader to be compared with. Every list is led by the member that
    comes first in this turn's order; a set asks the leader of most of its lists among those of
    another component that it has not asked before. So there are at most as many pairs as sets."""
    rows = lists.select("gram", "key")
    rows = rows.withColumn("component", F.col("key")) if known is None else rows.join(known, "key", "left").withColumn("component", F.coalesce("component", "key"))
    order = F.struct(F.xxhash64("key", F.lit(turn)).alias("order"), F.col("key").alias("leader"), F.col("component").alias("of"))
    # Aggregated before it is shuffled, so that a list that most sets are in is no single task.
    led = rows.groupBy("gram").agg(F.min(order).alias("first"), F.min("component").alias("low"), F.max("component").alias("high"))
    led = led.where("low < high").select("gram", "first.leader", "first.of")
    pairs = rows.join(led, "gram").where("component <> of").groupBy("leader", "key").agg(F.count("*").alias("n"))
    if tested is not None:
        pairs = pairs.join(tested, ["leader", "key"], "left_anti")
    best = pairs.groupBy("key").agg(F.max(F.struct("n", "leader")).alias("best"))
    return best.select("best.leader", "key")


def _blocks(lists: DataFrame, known: DataFrame | None) -> DataFrame:
    """``unit, low, high, block, key, component``: which sets are searched together. Lists whose least
    component is the same are one group, so that a set comes into few of them; of a group beyond
    ``MEMBERS`` sets or ``GRAMS`` shingles every two blocks are a unit."""
    rows = lists.select("gram", "key", "n")
    rows = rows.withColumn("component", F.col("key")) if known is None else rows.join(known, "key", "left").withColumn("component", F.coalesce("component", "key"))
    mixed = rows.groupBy("gram").agg(F.min("component").alias("home"), F.max("component").alias("high")).where("home < high")
    members = settle(rows.join(mixed.select("gram", "home"), "gram").select("home", "key", "n", "component").distinct(), "members")
    sizes = members.groupBy("home").agg(
        F.count("*").alias("n"), F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum("n") / GRAMS)).alias("blocks")
    )
    placed = join_counted(members.drop("n"), settle(sizes, "sizes"), "home", members.count())
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key"), "blocks"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    return placed.select(F.xxhash64("home", low, high).alias("unit"), low, high, "block", "key", "component")


def _search(blocks: DataFrame, sets: DataFrame, like: int) -> DataFrame:
    """``leader, key``: links inside the units, each searched in one task."""

    def flush(rows, sets):
        low, high, block, keys, components = zip(*rows, strict=True)
        asks, listed = np.array(block) == np.array(low), np.array(block) == np.array(high)
        if not (asks.any() and listed.any()):
            return None
        found = list(search_block(sets, components, asks, listed, like))
        columns = [pa.array([keys[pair[side]] for pair in found], pa.int64()) for side in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=["leader", "key"])

    def search(batches):
        unit, rows, held = None, [], []
        for batch in batches:
            at = batch.schema.names.index
            lists = batch.column(at("grams"))
            flat, edges = lists.flatten().to_numpy().view(np.uint64), np.asarray(lists.offsets, np.int64)
            edges = edges - edges[0]
            columns = [batch.column(at(n)).to_pylist() for n in ("unit", "low", "high", "block", "key", "component")]
            for i, (of, *row) in enumerate(zip(*columns, strict=True)):
                if of != unit and rows:
                    if (out := flush(rows, held)) is not None:
                        yield out
                    rows, held = [], []
                unit = of
                rows.append(row)
                held.append(flat[edges[i] : edges[i + 1]].copy())
        if rows and (out := flush(rows, held)) is not None:
            yield out

    joined = blocks.join(sets.select("key", "grams"), "key")
    placed = joined.repartition(partitions(sets.sparkSession), "unit").sortWithinPartitions("unit")
    placed = placed.select("unit", "low", "high", "block", "key", "component", "grams")
    return placed.mapInArrow(search, "leader bigint, key bigint")


def link_lists(lists: DataFrame, sets: DataFrame, like: int = LIKE) -> DataFrame:
    """``src, dst``: links that connect what all links inside a list connect. ``lists`` (``gram, key, n``)
    and ``sets`` (``key, n, grams``) are written tables; a link is ``like`` hundredths at least.

    In turns, every set is compared with one leader of its short lists that lies in another
    component, for as long as a good part of the comparisons links: most copies find one another there,
    with no more comparisons than sets. Sets whose lists then still hold several components are searched,
    all of a list against all, so nothing is left out; only links come out of the tasks.
    """
    none = sets.select(F.col("key").alias("leader"), "key").where(F.lit(False))
    links, known, tested, turn = none, None, None, 0
    while True:
        asked = settle(_asked(lists, known, tested, turn), "asked")
        if asked.isEmpty():
            break
        new = settle(_compare(asked, sets, like), "links")
        linked = new.count()
        if linked:
            links = links.unionByName(new)
            known = settle(connected_components(links, "leader", "key").withColumnRenamed("node", "key"), "known")
        if linked * WORTH < asked.count():
            break
        tested = asked if tested is None else tested.unionByName(asked)
        turn += 1
    every = links.unionByName(settle(_search(_blocks(lists, known), sets, like), "searched"))
    return every.select(F.col("leader").alias("src"), F.col("key").alias("dst"))


def linked_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per input row; ``component_id`` is the smallest
    id that links lead to.

    Documents with equal sets are one from the start. By hash order, the first sixth and a little
    more of each set shows which sets can have a link at all; for these, the exact frequencies
    of all shingles give the short lists. A missing or empty text, or one without words, has no
    shingles and is its own component. Rows with the same id share what either is linked to; a
    missing id counts as larger than all others.
    """
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    keys = settle(_keys(rows), "keys")
    some = keys.where("n_shingles > 0")
    distinct = some.groupBy("key").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("doc_id"))
    distinct = distinct.withColumn("doc_id", F.when(F.col("doc_id") < NO_ID, F.col("doc_id")))
    twice = not keys.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty()
    active = settle(_active(_heads(rows, distinct).distinct() if twice else _heads(rows, distinct)), "active")
    sets = settle(_sets_of(rows, distinct.join(active, "key"), twice), "sets")
    ends = connected_components(link_lists(settle(_short_lists(sets), "lists"), sets)).select(F.col("node").alias("key"), F.col("component").alias("class"))
    holders = some.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    classed = holders.join(ends, "key", "left").withColumn("class", F.coalesce("class", "key"))
    least = classed.groupBy("class").agg(F.min("least").alias("component_id"))
    named = classed.join(least, "class").select("key", "component_id")
    out = keys.join(named, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return out


def op9_ngram_join(spark, folder: str) -> DataFrame:
    """``linked_documents`` over all documents."""
    return linked_documents(table(spark, folder, "documents"))


def linked_sql(source: str) -> str:
    return f"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
            lambda x: x <> '') AS words FROM {source}),
    grams AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {SHINGLE} THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - {SHINGLE - 2}), lambda i: array_to_string(words[i:i + {SHINGLE - 1}], ' ')) END) AS gram FROM w),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY x, y),
    links AS (SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
        WHERE 100 * shared >= {LIKE} * (s.n + t.n - shared)),
    both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON b.x = r.y),
    named AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
    SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM w LEFT JOIN sizes USING (doc_id) JOIN named USING (doc_id)"""


SQL = linked_sql("documents")

"""Operator 8: passages that several documents share, by banded MinHash of paragraphs."""

from __future__ import annotations

import re
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import id_and_text, mix, partitions, settle, settled, shingles, table, text_slices
from corpusmill.llm.ngramjoin import link_lists
from corpusmill.operators.components import connected_components
from corpusmill.session import release

# Words of a shingle, and the Jaccard similarity of paragraphs that count as copies, in hundredths.
SHINGLE, SIMILAR = 5, 80
# A paragraph goes from one unit's start over whole units until it has this many words; of so
# many starts in a row the one with the least hash is taken.
WORDS, NEIGHBOURS = 22, 4
# A repeat of so many words holds a paragraph that is cut alike in all its copies: where units
# do not see to it, the least of so many starts in a row opens one of WORDS words. With no more
# than WORDS in a row, these paragraphs leave no gaps.
SURE, ROW = 50, 22
# Bands of so many minima each: at the similarity asked for, one band agrees with probability
# 0.64, one of four with 0.983; equal paragraphs always agree.
BANDS, ROWS = 4, 2
# Contents that chains of shared bands connect are searched by one task up to so many, all pairs of
# them at once where no shingle is in more than ``FEW``. Neither changes a result.
MEMBERS, FEW = 1000, 32
# Paragraphs whose keys a task packs at a time.
ROUTED = 1 << 17

_RUN = re.compile(r"\S+")
_KEYS = [f"band{b}" for b in range(BANDS)]
_KINDS = [("doc_id", pa.int64()), ("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("content", pa.int64()), ("root", pa.int64())]
_KINDS += [(k, pa.int64()) for k in _KEYS]
_PARAGRAPHS = "doc_id bigint, row bigint, first int, last int, content bigint, root bigint, " + ", ".join(f"{k} bigint" for k in _KEYS)


def _windows(size: int, froms: np.ndarray, tos: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in a span from one of ``froms`` to before its ``tos``."""
    steps = np.zeros(size + 1, np.int64)
    some = froms < tos
    np.add.at(steps, froms[some], 1)
    np.add.at(steps, tos[some], -1)
    return np.cumsum(steps[:-1]) > 0


def _winnowed(words: np.ndarray, active: np.ndarray) -> np.ndarray:
    """The start of the least of ``ROW`` paragraphs of ``WORDS`` words in a row, for each row
    whose first place is in ``active``. Of equal ones in reach of a row one is enough."""
    whole, spans = words, {1: words}
    for k in (1, 2, 4, 8):
        whole = spans[2 * k] = mix(whole[:-k], whole[k:])
    rest = WORDS - 16
    whole = mix(whole[:-rest], whole[rest:])
    head = mix(spans[4][: len(whole)], words[SHINGLE - 1 : SHINGLE - 1 + len(whole)])
    # The first words decide, so a change further on leaves the start; then all words.
    keys = (head & np.uint64(0xFFFFFFFF00000000)) | (whole >> np.uint64(32))
    at = np.arange(len(keys))
    for k in (1, 2, 4, 8, ROW - 16):
        later = keys[at[k:]] <= keys[at[:-k]]
        at = np.where(later, at[k:], at[:-k])
    starts = np.unique(at[active])
    # In a run of equal ones, those that a kept one before and one after make needless.
    same = keys[starts[1:]] == keys[starts[:-1]]
    inner = np.flatnonzero(same[1:] & same[:-1]) + 1
    keep = np.ones(len(starts), bool)
    kept = -1
    for i in inner.tolist():
        if keep[i - 1]:
            kept = starts[i - 1]
        keep[i] = starts[i + 1] - kept > ROW
    return starts[keep]


def _words(bodies: list[str]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Word hashes of all texts end to end, how many each has, the distinct words and which one each is."""
    split = [body.split() for body in bodies]
    coded = pa.array(list(chain.from_iterable(split)), pa.large_string()).dictionary_encode()
    distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    # No word holds a line end, so all are lowered at once.
    lowered = "\n".join(distinct).lower().encode("utf-8").split(b"\n") if distinct else []
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, lowered), np.uint64, len(distinct))
    return hashes[which], np.fromiter(map(len, split), np.int64, len(split)), distinct, which


def _cut(bodies: list[str]):
    """Word hashes of all texts end to end, how many each has, and for each paragraph its text,
    first word and end, counted from the first word of all.

    Units start at words with a capital and after words that end a sentence, so a passage is
    cut alike wherever it stands; which units start a paragraph depends on their first words. Any ``SURE`` words in a row in
    which units alone do not settle a paragraph get winnowed ones, by their words alone.
    """
    words, counts, distinct, which = _words(bodies)
    begin, flat = np.cumsum(counts) - counts, which
    opens = np.fromiter(map(str.isupper, map(itemgetter(0), distinct)), bool, len(distinct))[which]
    stops = np.fromiter(map(".!?".__contains__, map(itemgetter(-1), distinct)), bool, len(distinct))[which]
    opens[1:] |= stops[:-1]
    opens[begin[counts > 0]] = True
    units = np.flatnonzero(opens)
    owner = np.searchsorted(begin, units, side="right") - 1
    ends = np.append(units[1:], len(flat))
    # Where a paragraph ends that starts at this unit: with the unit that fills it up.
    fills = np.searchsorted(ends, units + WORDS)
    fits = fills < len(ends)
    last = ends[np.minimum(fills, len(ends) - 1)] if len(ends) else ends
    fits &= last <= (begin + counts)[owner]
    froms = tos = np.zeros(0, np.int64)
    # The least hash of the unit's first words among neighbours of the same text.
    if len(units):
        keys = words[units]
        for k in (1, 2):
            keys = mix(keys, words[np.minimum(units + k, len(words) - 1)])
        chosen = np.zeros(len(units), bool)
        padded = np.concatenate([keys, np.full(NEIGHBOURS - 1, np.iinfo(np.uint64).max, np.uint64)])
        least = np.lib.stride_tricks.sliding_window_view(padded, NEIGHBOURS).argmin(axis=1) + np.arange(len(units))
        chosen[np.minimum(least, len(units) - 1)] = True
        # A text's first unit has no neighbours before it.
        chosen[np.flatnonzero(np.diff(owner, prepend=-1))] = True
        # Words in a row that hold all these neighbours, the words before and behind that make
        # them and the paragraph's end units, and so the same paragraph in any text.
        u = np.arange(max(len(units) - NEIGHBOURS + 1, 0))
        far = u + NEIGHBOURS - 1
        u, far = (x[(owner[u] == owner[far]) & fits[least[u]]] for x in (u, far))
        froms, tos = np.maximum(units[far] + 3, last[least[u]] + 1) - SURE, units[u]
        froms = np.maximum(froms, begin[owner[u]])
        fits &= chosen
    starts, stops = units[fits], last[fits]
    rows = len(words) - WORDS - ROW + 2
    within = _windows(len(words), begin, begin + counts - SURE + 1)
    bare = np.flatnonzero(within & ~_windows(len(words), froms, tos))
    if len(bare):
        active = np.flatnonzero(_windows(rows, bare, bare + SURE - WORDS - ROW + 2))
        more = _winnowed(words, active)
        both = np.unique(np.append(starts, more) * (len(words) + 1) + np.append(stops, more + WORDS))
        starts, stops = both // (len(words) + 1), both % (len(words) + 1)
    return words, counts, np.searchsorted(begin, starts, side="right") - 1, starts, stops, begin


def _each(starts: np.ndarray, ends: np.ndarray):
    """Places of the shingles of all paragraphs end to end, and where each paragraph's begin."""
    sizes = ends - starts - SHINGLE + 1
    heads = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) - np.repeat(heads - starts, sizes), heads, sizes


def _contents(grams: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each paragraph's words in order."""
    places, heads, sizes = _each(starts, ends)
    with np.errstate(over="ignore"):
        return np.add.reduceat(mix(grams[places], (places - np.repeat(starts, sizes)).astype(np.uint64)), heads).view(np.int64)


def _distinct(grams: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of all paragraphs end to end, and where each paragraph's begin and end."""
    places, _, sizes = _each(starts, ends)
    taken, owner = grams[places], np.repeat(np.arange(len(starts)), sizes)
    order = np.lexsort((taken, owner))
    taken, owner = taken[order], owner[order]
    new = np.append(True, (taken[1:] != taken[:-1]) | (owner[1:] != owner[:-1]))[: len(taken)]
    return taken[new], np.append(0, np.cumsum(np.bincount(owner[new], minlength=len(starts))))


def _groups(owner: np.ndarray, starts: np.ndarray, ends: np.ndarray, grams: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each paragraph the least content of those that similar paragraphs of the same text connect it to,
    and whether there are others. Paragraphs come by text and start.

    The shingles of a paragraph that its text has only once are in another where the two overlap, so
    that places tell how many they share. The others, of repeated words, are compared as sets.
    """
    size = ends - starts - SHINGLE + 1
    # Whether a shingle is in its text twice; those of two texts have an owner of neither.
    text = np.zeros(len(grams), np.int64)
    edges = np.flatnonzero(np.diff(owner, prepend=-1))
    text[starts[edges]] = owner[edges] - np.append(0, owner[edges][:-1])
    keys = mix(grams, np.cumsum(text).astype(np.uint64))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(grams) + 1, np.int64)
    twice[order] = np.append(False, same) | np.append(same, False)
    before = np.cumsum(twice) - twice
    plain = before[ends - SHINGLE + 1] == before[starts]
    left, right = [], []
    n_distinct = size.copy()
    others = np.flatnonzero(~plain)
    if len(others):
        flat, at = _distinct(grams, starts[others], ends[others])
        n_distinct[others] = np.diff(at)
        one = np.lexsort((content[others], owner[others]))
        one = one[np.append(True, (np.diff(owner[others][one]) != 0) | (np.diff(content[others][one]) != 0))]
        i, j = like_pairs(owner[others][one], [flat[at[k] : at[k + 1]] for k in one.tolist()])
        left.append(others[one[i]])
        right.append(others[one[j]])
    for far in range(1, len(starts)):
        shared = np.minimum(ends[far:], ends[:-far]) - starts[far:] - SHINGLE + 1
        near = np.flatnonzero((owner[far:] == owner[:-far]) & (shared > 0))
        if not len(near):
            break
        near = near[plain[near] | plain[near + far]]
        i, j, shared = near, near + far, shared[near]
        like = 100 * shared >= SIMILAR * (n_distinct[i] + n_distinct[j] - shared)
        left.append(i[like])
        right.append(j[like])
    i, j = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (left, right))
    group = np.arange(len(starts))
    while (group[i] != group[j]).any():
        least = np.minimum(group[i], group[j])
        for side in (i, j):
            np.minimum.at(group, group[side], least)
            np.minimum.at(group, side, least)
        group = group[group]
    root = content.copy()
    np.minimum.at(root, group, content)
    most = content.copy()
    np.maximum.at(most, group, content)
    return root[group], root[group] < most[group]


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id, row, first, last, content, root, band0, band1, ...`` of every paragraph, ``first`` and ``last``
    in words. ``row`` numbers texts. Similar contents of a text are connected to their least, the
    ``root``; those without any have none."""

    def emit(batches):
        schema = pa.schema(_KINDS)
        base = TaskContext.get().partitionId() << 33
        for batch in text_slices(batches):
            words, _, owner, starts, ends, begin = _cut(batch.column(1).to_pylist())
            if not len(starts):
                continue
            grams = shingles(words, SHINGLE)
            # Minima from a paragraph's first to behind its last shingle; every other one is between two.
            edges = np.column_stack([starts, ends - SHINGLE + 1]).reshape(-1)
            padded = np.append(grams, np.uint64(0))
            minima = [np.minimum.reduceat(mix(padded, k + 1), edges)[::2] for k in range(BANDS * ROWS)]
            bands = []
            for b in range(BANDS):
                key = np.full(len(starts), b, np.uint64)
                for row in minima[b * ROWS : (b + 1) * ROWS]:
                    key = mix(key, row)
                bands.append(key.view(np.int64))
            content = _contents(grams, starts, ends)
            root, several = _groups(owner, starts, ends, grams, content)
            ids, shift = batch.column(0).take(pa.array(owner)), begin[owner]
            columns = [ids, pa.array(base + owner), pa.array((starts - shift).astype(np.int32)), pa.array((ends - shift).astype(np.int32))]
            columns += [pa.array(content), pa.array(root, mask=~several), *map(pa.array, bands)]
            base += batch.num_rows
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.mapInArrow(emit, _PARAGRAPHS)


def _shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``class, content, rep, grams``: the distinct shingles of one occurrence of each paragraph in ``wanted``
    (``content, class, rep, doc_id, first, last``). Of rows with the same id those that hold it give them."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("content", "class", "rep", "first", "last")).alias("places"))
    found = docs.join(lists, "doc_id")

    def emit(batches):
        for batch in text_slices(batches):
            at = batch.schema.names.index
            words, counts, _, _ = _words(batch.column(at("text")).to_pylist())
            lists = batch.column(at("places"))
            owner = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets, np.int64)))
            content, of, rep, first, last = (np.asarray(column, np.int64) for column in lists.flatten().flatten())
            inside = np.flatnonzero(last <= counts[owner])
            begin = (np.cumsum(counts) - counts)[owner]
            starts, ends = (begin + first)[inside], (begin + last)[inside]
            if not len(inside):
                continue
            grams = shingles(words, SHINGLE)
            held = _contents(grams, starts, ends) == content[inside]
            inside, starts, ends = inside[held], starts[held], ends[held]
            if not len(inside):
                continue
            flat, edges = _distinct(grams, starts, ends)
            sets = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(c[inside]) for c in (of, content, rep)] + [sets], names=["class", "content", "rep", "grams"])

    return found.select("text", "places").mapInArrow(emit, "class bigint, content bigint, rep bigint, grams array<bigint>")


def _shared_buckets(occur: DataFrame) -> DataFrame:
    """``bucket, content``: what is in buckets that several texts meet in. Two bands at a time, so that
    half of the keys are moved at once, packed by shard of them; copies among some paragraphs
    in a row are one before."""
    shards = partitions(occur.sparkSession)

    def route(batches):
        held, size = [], 0

        def flush():
            content, row, bucket, other = (np.concatenate([h[k] for h in held]) for k in range(4))
            bucket, content, row = np.append(bucket, other), np.tile(content, 2), np.tile(row, 2)
            bucket, content, low, high = _met(bucket, content, row, row)
            shard = bucket.view(np.uint64) % np.uint64(shards)
            order = np.argsort(shard.astype(np.min_scalar_type(shards)), kind="stable")
            edges = np.append(np.flatnonzero(np.diff(shard[order].astype(np.int64), prepend=-1)), len(order))
            data = [np.concatenate([v[order[x:y]] for v in (bucket, content, low, high)]).tobytes() for x, y in zip(edges[:-1], edges[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(shard[order[edges[:-1]]].astype(np.int64)), pa.array(data, pa.binary())], names=["shard", "data"])

        for batch in batches:
            if batch.num_rows:
                held.append([batch.column(k).to_numpy() for k in range(4)])
                size += batch.num_rows
            if size >= ROUTED:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def meet(pieces):
        columns = [np.concatenate(c) for c in zip(*(np.frombuffer(p, np.int64).reshape(4, -1) for p in pieces), strict=True)]
        bucket, content, low, high = _met(*columns)
        begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        several = np.minimum.reduceat(low, begin) < np.maximum.reduceat(high, begin)
        several = np.repeat(several, np.diff(np.append(begin, len(bucket))))
        return pa.RecordBatch.from_arrays([pa.array(bucket[several]), pa.array(content[several])], names=["bucket", "content"])

    def gather(batches):
        current, pieces = None, []
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard != current and pieces:
                    yield meet(pieces)
                    pieces = []
                current = shard
                pieces.append(data)
        if pieces:
            yield meet(pieces)

    parts = []
    for band in range(0, BANDS, 2):
        routed = occur.select("content", "row", *_KEYS[band : band + 2]).mapInArrow(route, "shard bigint, data binary")
        placed = routed.repartition(shards, "shard").sortWithinPartitions("shard")
        parts.append(settle(placed.mapInArrow(gather, "bucket bigint, content bigint"), "buckets"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def _met(bucket: np.ndarray, content: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct contents of each bucket, by bucket, with the least and the greatest of their rows."""
    order = np.lexsort((content, bucket))
    bucket, content = bucket[order], content[order]
    begin = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (content[1:] != content[:-1])))
    return bucket[begin], content[begin], np.minimum.reduceat(low[order], begin), np.maximum.reduceat(high[order], begin)


def like_pairs(classes: np.ndarray, sets: list[np.ndarray], reps: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``i, j`` of similar sets of the same class, enough of them to connect all that such pairs
    connect. Classes come in order; sets are sorted. Sets of one of ``reps`` need not be compared."""
    begin = np.flatnonzero(np.diff(classes, prepend=classes[:1] - 1)) if len(classes) else np.zeros(0, np.int64)
    members = np.diff(np.append(begin, len(classes)))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    some = np.flatnonzero(np.repeat(members > 1, members))
    if not len(some):
        return left[0], right[0]
    place = np.repeat(np.arange(len(begin)), members)
    owner, flat = np.repeat(some, sizes[some]), np.concatenate([sets[i] for i in some])
    # A shingle's holders in a class lie together, in order.
    order = np.lexsort((flat, place[owner]))
    owner, flat = owner[order], flat[order]
    run = np.cumsum(np.append(True, (flat[1:] != flat[:-1]) | (place[owner][1:] != place[owner][:-1])))
    crowded = np.zeros(len(begin), bool)
    crowded[place[owner[FEW:][run[FEW:] == run[:-FEW]]]] = True
    kept = ~crowded[place[owner]]
    owner, run, found = owner[kept], run[kept], []
    for far in range(1, FEW):
        both = np.flatnonzero(run[far:] == run[:-far])
        if not len(both):
            break
        i, j = owner[both], owner[both + far]
        i, j = (i, j) if reps is None else (i[reps[i] != reps[j]], j[reps[i] != reps[j]])
        found.append(i * len(sets) + j)
    pairs, shared = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True)
    i, j = pairs // len(sets), pairs % len(sets)
    like = 100 * shared >= SIMILAR * (sizes[i] + sizes[j] - shared)
    left.append(i[like])
    right.append(j[like])
    for at in np.flatnonzero(crowded).tolist():
        links = _spread(sets[begin[at] : begin[at] + members[at]])
        left.append(links[:, 0] + begin[at])
        right.append(links[:, 1] + begin[at])
    return np.concatenate(left), np.concatenate(right)


def _spread(sets: list[np.ndarray]) -> np.ndarray:
    """Pairs of similar sets that connect what such pairs connect: from each set to those that are
    like it and not reached yet, so what is connected is not compared again."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    waiting, links, reached = np.ones(len(sets), bool), [np.zeros((0, 2), np.int64)], []
    indexed, n_waiting = 0, len(sets)
    following = iter(range(len(sets)))
    while n_waiting:
        if 2 * n_waiting <= indexed or not indexed:
            rest = np.flatnonzero(waiting)
            flat, owner = np.concatenate([sets[i] for i in rest]), np.repeat(rest, sizes[rest])
            order = np.argsort(flat, kind="stable")
            flat, owner, indexed = flat[order], owner[order], n_waiting
        if reached:
            x = reached.pop()
        else:
            x = next(i for i in following if waiting[i])
            waiting[x] = False
            n_waiting -= 1
        lows, highs = np.searchsorted(flat, sets[x]), np.searchsorted(flat, sets[x], side="right")
        holders = np.concatenate([owner[a:b] for a, b in zip(lows.tolist(), highs.tolist(), strict=True)])
        met, shared = np.unique(holders[waiting[holders]], return_counts=True)
        met = met[100 * shared >= SIMILAR * (sizes[met] + sizes[x] - shared)]
        if len(met):
            waiting[met] = False
            n_waiting -= len(met)
            reached += met.tolist()
            links.append(np.column_stack([np.full(len(met), x), met]))
    return np.concatenate(links)


def _search_classes(sets: DataFrame) -> DataFrame:
    """``src, dst``: similar contents of a class (``class, content, rep, grams``), which one task compares."""

    def compare(table):
        of, content, rep = (table.column(n).to_numpy() for n in ("class", "content", "rep"))
        # Rows with the same id may give a set twice.
        order = np.lexsort((content, of))
        order = order[np.append(True, (np.diff(of[order]) != 0) | (np.diff(content[order]) != 0))]
        lists = table.column("grams").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        flat, edges = lists.flatten().to_numpy().view(np.uint64), np.asarray(lists.offsets, np.int64)
        edges = edges - edges[0]
        i, j = like_pairs(of[order], [flat[edges[k] : edges[k + 1]] for k in order.tolist()], rep[order])
        content = content[order]
        return pa.RecordBatch.from_arrays([pa.array(content[i]), pa.array(content[j])], names=["src", "dst"])

    def search(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column(0).to_numpy()
            last = int(np.searchsorted(of, of[-1]))
            if last or held and held[-1].column(0)[-1].as_py() != of[-1]:
                # What comes before the last class is whole.
                whole = [*held, batch.slice(0, last)]
                held = []
                yield compare(pa.Table.from_batches(whole))
            held.append(batch.slice(last))
        if held:
            yield compare(pa.Table.from_batches(held))

    placed = sets.repartition(partitions(sets.sparkSession), "class").sortWithinPartitions("class")
    return placed.mapInArrow(search, "src bigint, dst bigint")


def _links(docs: DataFrame, lists: DataFrame, held: DataFrame) -> DataFrame:
    """``src, dst``: links that connect what all similar contents that share a bucket connect.

    Contents that first stand in the same text (``rep``) were compared there. Buckets with others are
    searched: contents that chains of them connect come together in one task, which leaves out no
    pair. Those of a class beyond ``MEMBERS`` are linked by list, as documents are in
    ``ngramjoin``: a few turns with one leader a list, then all against all in blocks, without the
    pairs that are connected already.
    """
    placed = settle(lists.join(held.select("content", "rep"), "content"), "placed")
    several = placed.groupBy("bucket").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.min("content").alias("low")).where("a < b")
    lists = settle(placed.join(several.select("bucket", "low"), "bucket").select("bucket", "content", "low"), "lists")
    edges = lists.where("content <> low").select(F.col("content").alias("src"), F.col("low").alias("dst"))
    members = connected_components(edges).select(F.col("node").alias("content"), F.col("component").alias("class"))
    sizes = members.groupBy("class").agg((F.count("*") > MEMBERS).alias("crowded"))
    first, last = F.shiftright("place", 32).alias("first"), F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).alias("last")
    wanted = held.join(members.join(sizes, "class"), "content")
    wanted = settle(wanted.select("content", "class", "crowded", "rep", "doc_id", first, last), "wanted")
    links = settle(_search_classes(_shingle_sets(docs, wanted.where("NOT crowded"))), "links")
    crowded = wanted.where("crowded")
    if crowded.isEmpty():
        return links
    sets = _shingle_sets(docs, crowded).dropDuplicates(["content"]).select(F.col("content").alias("key"), F.size("grams").cast("bigint").alias("n"), "grams")
    sets = settle(sets, "sets")
    inside = lists.select(F.col("bucket").alias("gram"), F.col("content").alias("key")).join(sets.select("key", "n"), "key")
    return links.unionByName(link_lists(settle(inside, "inside"), sets, SIMILAR))


def shared_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, start, end, n_words, component, first_doc_id, removed``: the passages of each
    document that are also in another, as places in code points.

    Paragraphs (``WORDS`` words or more, cut by content) with Jaccard similarity of 0.8 or more on
    five-word shingles are linked when they share a MinHash band, all of them; components of links
    are classes of copies. A class that two documents hold is a repeat: all its occurrences are
    listed, overlapping ones joined, and those outside the smallest document are to be removed.
    Shorter texts have no paragraphs. Missing and empty texts give no rows; rows with the same
    id are one document; rows without an id are not looked at.

    Only keys of bands and contents move until it is known which buckets hold several contents. Texts
    move to fetch the shingles of those, and for the places of repeats.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, doc_id, text).where("doc_id is not null")
    occur, first = settled(paragraphs(rows), "paragraphs")
    lists = _shared_buckets(occur)
    shared = settle(lists.select("content").distinct(), "shared")
    # What shares no bucket with another text is no repeat, unless it is like something in its text that does.
    columns = occur.select("doc_id", "row", "first", "last", "content", "root")
    direct = settle(columns.join(shared, "content", "left_semi"), "direct")
    touched = direct.where("root IS NOT NULL").select("root").distinct()
    more = columns.where("root IS NOT NULL").join(touched, "root", "left_semi").join(shared, "content", "left_anti")
    more = settle(more.select(direct.columns), "more")
    release(spark, first)
    occur = direct.unionByName(more)
    place = F.shiftleft(F.col("first").cast("bigint"), 32) + F.col("last")
    held = occur.groupBy("content").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.min("row").alias("rep"),
        F.min_by("doc_id", "row").alias("doc_id"), F.min_by(place, "row").alias("place"),
    )
    held = settle(held, "held")
    near = occur.where("root <> content").select(F.col("root").alias("src"), F.col("content").alias("dst")).distinct()
    components = connected_components(_links(rows, lists, held).unionByName(near)).withColumnRenamed("node", "content")
    classed = held.select("content", "first_doc", "last_doc").join(components, "content", "left").withColumn("component", F.coalesce("component", "content"))
    classes = classed.groupBy("component").agg(F.min("first_doc").alias("first_doc_id"), F.max("last_doc").alias("last_doc"))
    several = classes.where("first_doc_id < last_doc").select("component", "first_doc_id")
    repeats = classed.select("content", "component").join(several, "component")
    placed = occur.select("doc_id", "first", "last", "content").join(repeats, "content").drop("content")
    # Overlapping or touching spans become one.
    ordered = Window.partitionBy("doc_id").orderBy("first", "last")
    before = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opened = placed.withColumn("opens", F.when(F.coalesce(F.col("first") <= before, F.lit(False)), 0).otherwise(1))
    numbered = opened.withColumn("span", F.sum("opens").over(ordered))
    spans = numbered.groupBy("doc_id", "span").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min("component").alias("component"),
        F.min("first_doc_id").alias("first_doc_id"), F.max(F.col("doc_id") > F.col("first_doc_id")).alias("removed"),
    )
    fields = ["first", "last", "component", "first_doc_id", "removed"]
    lists = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("spans"))

    def place(batches):
        names = ["doc_id", "start", "end", "n_words", "component", "first_doc_id", "removed"]
        kinds = [pa.int64()] * 6 + [pa.bool_()]
        for batch in text_slices(batches):
            at = batch.schema.names.index
            out: list[list] = [[] for _ in names]
            for key, body, found in zip(*(batch.column(at(n)).to_pylist() for n in ("doc_id", "text", "spans")), strict=True):
                words = [m.span() for m in _RUN.finditer(body)]
                for s in found:
                    if s["last"] <= len(words):
                        values = (key, words[s["first"]][0], words[s["last"] - 1][1], s["last"] - s["first"], s["component"], s["first_doc_id"], s["removed"])
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id bigint, start bigint, end bigint, n_words bigint, component bigint, first_doc_id bigint, removed boolean"
    return rows.join(lists, "doc_id").mapInArrow(place, schema)


def op8_substring_dedup(spark, folder: str) -> DataFrame:
    """``shared_passages`` of all documents."""
    return shared_passages(table(spark, folder, "documents"))

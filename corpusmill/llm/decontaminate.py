"""Operator 6: benchmark passages in documents, by embedding, sampling and exact edit distance."""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import id_and_text, mix, table, text_slices

# The share of an item's words that may differ, and the recall to be reached at that many edits.
EDITS, RECALL = 0.2, 0.99
# Items searched for at a time; their tables are sent to all tasks. Sampled places of a table,
# tables per walk. Edited items, at least, on which the recall of a size class is measured.
BLOCK, SAMPLED, TABLES, TRIALS = 2000, 3, 6, 4000
# Rare words of an item that must follow a window's start.
SPARE = 4
_RUN = re.compile(r"\S+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def bare(run: str) -> str:
    """A run of characters without the marks at its ends, unless it is nothing but marks."""
    return _EDGES.sub("", run) or run


def words_of(text: str) -> list[str]:
    return [bare(run) for run in text.lower().split()]


class WordNumbers(dict):
    """Remembers the number of each run of characters met."""

    LIMIT = 1 << 20

    def __init__(self, vocabulary: dict[str, int]) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, run: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[run] = self.vocabulary.get(bare(run), 0)
        return value


def edits_of(size: int) -> int:
    return int(EDITS * size + 1e-9)


def embed(text: np.ndarray, starts: np.ndarray, walk: np.ndarray) -> np.ndarray:
    """The random walks from each of ``starts``: row ``j`` holds the word under the pointer at
    step ``j``, which the word and the step then move on or not. Equal texts give equal
    rows; each edit makes the two walks differ until they happen to meet again."""
    at, rows = starts.copy(), []
    for bits in walk:
        symbol = text[np.minimum(at, len(text) - 1)]
        rows.append(symbol)
        at = at + bits[symbol]
    return np.array(rows)


def embed_all(texts: list[np.ndarray], walk: np.ndarray) -> np.ndarray:
    """The walk from the start of each text, which then ends in words that no item has."""
    apart = len(walk) + 1
    sizes = np.array([len(t) + apart for t in texts])
    joined = np.zeros(sizes.sum(), np.int64)
    starts = np.cumsum(sizes) - sizes
    for at, text in zip(starts.tolist(), texts, strict=True):
        joined[at : at + len(text)] = text
    return embed(joined, starts, walk)


def edit_ends(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each end in ``text``, the least edit distance of ``item`` to a run that ends there."""
    places = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, symbol in enumerate(item.tolist()):
        step = np.empty_like(row)
        step[0] = i + 1
        step[1:] = np.minimum(row[:-1] + (text != symbol), row[1:] + 1)
        row = np.minimum.accumulate(step - places) + places
    return row


def best_run(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """``distance, start, end`` of the run of ``text`` nearest to ``item``."""
    ends = edit_ends(item, text)
    end = int(ends.argmin())
    back = edit_ends(item[::-1], text[:end][::-1])
    length = len(back) - 1 - int(back[::-1].argmin())
    return int(ends[end]), end - length, end


@dataclass
class _SizeClass:
    """Items of like size, and hash tables over sampled places of their embeddings."""

    items: list[int]
    least: int
    most: int
    tables: list[tuple[np.ndarray, list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]]


class ItemIndex:
    """Items as word numbers, from 1 on; 0 is any word that no item has."""

    def __init__(self, ids: list, texts: list[str], recall: float = RECALL, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        split = [words_of(t) for t in texts]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for words in split for w in words}))}
        self.ids = ids
        self.items = [np.array([self.vocabulary[w] for w in words], np.int64) for words in split]
        size = len(self.vocabulary) + 1
        sizes = np.array([len(i) for i in self.items], np.int64)
        self.apart = int(2 * sizes.max(initial=1)) + 2
        self.classes, low = [], 1
        while low <= sizes.max(initial=0):
            high = max(low, int(low * 1.3))
            members = np.flatnonzero((sizes >= low) & (sizes <= high)).tolist()
            if members:
                self.classes.append(self._tables(members, low, high, size, recall, rng))
            low = high + 1

    def _keys(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        keys = rows[places[0]].astype(np.uint64)
        for p in places[1:]:
            keys = mix(keys, rows[p].astype(np.uint64))
        return keys

    def _tables(self, members, low, high, size, recall, rng) -> _SizeClass:
        """Walks with sampled tables, until edited items would be found often enough."""
        steps = max(2, 2 * low - low // 4)
        sampled = min(SAMPLED, steps)
        trials = np.repeat(np.arange(len(members)), -(-TRIALS // len(members)))
        edited = [self._edited(self.items[members[t]], rng, size) for t in trials.tolist()]
        missed = np.ones(len(trials), bool)
        tables = []
        # Every trial is met by a walk and places with some probability, so this ends.
        while missed.mean() > 1 - recall:
            walk = rng.integers(0, 2, (steps, size), np.int8)
            rows, tried = embed_all([self.items[m] for m in members], walk), embed_all(edited, walk)
            own = rows[:, trials]
            choices, lookups = [], []
            for _ in range(TABLES):
                places = np.sort(rng.choice(steps, sampled, replace=False))
                keys = self._keys(rows, places)
                order = np.argsort(keys)
                choices.append(places)
                lookups.append((keys[order], np.array(members)[order]))
                missed &= self._keys(tried, places) != self._keys(own, places)
            tables.append((walk, choices, lookups))
        return _SizeClass(members, low, high, tables)

    @staticmethod
    def _edited(item: np.ndarray, rng, size: int) -> np.ndarray:
        out = item.tolist()
        for _ in range(edits_of(len(item))):
            kind, at = rng.integers(3), int(rng.integers(max(len(out), 1)))
            if kind == 0 and out:
                out[at] = int(rng.integers(size))
            elif kind == 1:
                out.insert(at, int(rng.integers(size)))
            elif len(out) > 1:
                del out[at]
        return np.array(out, np.int64)

    def _could_begin(self, text: np.ndarray, begins: np.ndarray, often: np.ndarray, group: _SizeClass) -> np.ndarray:
        """Which of ``begins`` an item of this class may start at; none that it does is left out.

        Of any words of an item all but its edits remain. Taken are the words that are rarest
        in the text at hand: some of them must then follow closely.
        """
        rare = np.zeros(len(often), bool)
        need = SPARE
        for item in group.items:
            words, allowed = self.items[item], edits_of(len(self.items[item]))
            spare = min(SPARE, len(words) - allowed)
            need = min(need, spare)
            rare[words[np.argsort(often[words], kind="stable")[: allowed + spare]]] = True
        rare[0] = False
        marks = np.concatenate([[0], np.cumsum(rare[text], dtype=np.int32)])
        reach = np.minimum(begins + group.most + edits_of(group.most), len(text))
        return marks[reach] - marks[begins] >= need

    def find(self, text: np.ndarray, edges: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int, int]]:
        """``item, distance, start, end`` of runs that are near an item, the nearest one of any
        that overlap. ``edges`` are the ends of the texts that ``text`` holds; a run stays
        within one of them."""
        edges = edges or [(0, len(text))]
        firsts = [first for first, _ in edges]
        begins = np.flatnonzero(text > 0)
        often = np.bincount(text, minlength=len(self.vocabulary) + 1)
        found: dict[int, list[tuple[int, int, int]]] = {}
        for group in self.classes:
            starts = begins[self._could_begin(text, begins, often, group)]
            if not len(starts):
                continue
            pairs = []
            for walk, choices, lookups in group.tables:
                rows = embed(text, starts, walk)
                for places, (keys, items) in zip(choices, lookups, strict=True):
                    mine = self._keys(rows, places)
                    low, high = np.searchsorted(keys, mine), np.searchsorted(keys, mine, side="right")
                    hit = np.flatnonzero(high > low)
                    if len(hit):
                        n = (high - low)[hit]
                        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        pairs.append(np.column_stack([items[np.repeat(low[hit], n) + nth], np.repeat(starts[hit], n)]))
            if pairs:
                for item, at in np.unique(np.concatenate(pairs), axis=0).tolist():
                    self._verify(text, edges[bisect_right(firsts, at) - 1], item, at, found)
        return [(item, *run) for item, runs in sorted(found.items()) for run in runs]

    def _verify(self, text: np.ndarray, edge: tuple[int, int], item: int, at: int, found: dict) -> None:
        symbols = self.items[item]
        allowed = edits_of(len(symbols))
        runs = found.setdefault(item, [])
        if any(start <= at < end for _, start, end in runs[-2:]):
            return
        low, high = max(edge[0], at - 2 * allowed), min(edge[1], at + len(symbols) + 2 * allowed)
        part = text[low:high]
        if np.isin(part, symbols).sum() < len(symbols) - allowed:
            return
        distance, start, end = best_run(symbols, part)
        if distance <= allowed and (distance, low + start, low + end) not in runs[-2:]:
            runs.append((distance, low + start, low + end))


_SCHEMA = "doc_id bigint, item_id bigint, start bigint, end bigint, distance int, n_item_words int"


def find_leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block: int = BLOCK,
) -> DataFrame:
    """``doc_id, item_id, start, end, distance, n_item_words``: each item that a document holds,
    with the place (code points) of the nearest run of words and its edit distance in words,
    which is at most a fifth of the item's words. Words are cut at white space, lower-cased, and
    without the marks at their ends.

    Every start of every whole text that could begin such a run (by the rare words of items that
    follow) is embedded; windows that agree with an item in some table's sampled places
    are verified exactly, so nothing false is returned. Items come in blocks of bounded size,
    each sent to all tasks. No shuffle. Missing texts and items without words match nothing;
    repeated rows give repeated results; an empty table of items gives no rows.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, doc_id, text)
    wanted = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    total = wanted.count()
    blocks = max(1, -(-total // block))
    parts = []
    for number in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        part.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        shared = spark.sparkContext.broadcast(ItemIndex([r.item_id for r in part], [r.text for r in part]))
        parts.append(rows.mapInArrow(_searcher(shared), _SCHEMA))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _searcher(shared):
    def search(batches):
        index = shared.value
        number = WordNumbers(index.vocabulary).__getitem__
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2
        names = ["doc_id", "item_id", "start", "end", "distance", "n_item_words"]
        for batch in text_slices(batches):
            out: list[list] = [[] for _ in names]
            bodies, keys = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            # All texts of a batch end to end, too far apart for a run to reach over.
            apart = [0] * index.apart
            numbers, edges = [], []
            for body in bodies:
                first = len(numbers)
                numbers += map(number, body.lower().split())
                edges.append((first, len(numbers)))
                numbers += apart
            begin = [first for first, _ in edges]
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for item, *run in index.find(np.array(numbers, np.int64), edges):
                row = bisect_right(begin, run[1]) - 1
                best[row, item] = min(best.get((row, item), tuple(run)), tuple(run))
            for (row, item), (distance, a, b) in sorted(best.items()):
                body = bodies[row]
                spans = [m.span() for m in _RUN.finditer(body)]
                first, last = spans[a - begin[row]][0], spans[b - begin[row] - 1][1]
                values = (keys[row], index.ids[item], first, last, distance, len(index.items[item]))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return search


def op6_decontamination(spark, folder: str) -> DataFrame:
    """``find_leaks`` of all benchmark items in all documents."""
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))

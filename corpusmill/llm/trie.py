"""An n-gram trie of Elias-Fano levels with quantised smoothed probabilities."""

from __future__ import annotations

import mmap
from functools import cached_property

import numpy as np


def distinct_rows(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of the columns of whole numbers, sorted by the first, then the next; and which each is."""
    order, new = np.zeros(0, np.int64), np.zeros(0, bool)
    if len(columns[0]):
        # One number for a row; what would not fit is numbered first.
        key, size = np.zeros(len(columns[0]), np.int64), 1
        for column in columns:
            low = int(column.min())
            span = int(column.max()) - low + 1
            if size * span >= 1 << 63:
                values, key = np.unique(key, return_inverse=True)
                size = len(values)
            key = key * span + (column.astype(np.int64) - low)
            size *= span
        order = np.arange(len(key)) if (key[1:] >= key[:-1]).all() else np.argsort(key)
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return [column[order[new]] for column in columns], which


class EliasFano:
    """A non-decreasing sequence: low bits as they are, high bits as gaps in unary."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.arrays = arrays
        self.shift = int(arrays["shift"][0])
        self.size = len(arrays["low"])
        # Where the ones of the unary part are: what `select` answers.
        self.ones = np.flatnonzero(np.unpackbits(arrays["high"], bitorder="little")).astype(np.int64)

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.int64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        shift = max(0, int(np.log2(max(top // max(n, 1), 1))))
        low = values & ((1 << shift) - 1)
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if shift <= 8 * np.dtype(k).itemsize)
        bits = np.zeros((top >> shift) + n + 1, bool)
        bits[(values >> shift) + np.arange(n)] = True
        return cls({"low": low.astype(kind), "high": np.packbits(bits, bitorder="little"), "shift": np.array([shift])})

    def at(self, index: np.ndarray) -> np.ndarray:
        return ((self.ones[index] - index) << self.shift) | self.arrays["low"][index].astype(np.int64)

    @cached_property
    def whole(self) -> np.ndarray:
        return self.at(np.arange(self.size))


class Ranges:
    """Sorted lists of numbers, one after the other, as one Elias-Fano sequence: each list is
    raised by where the one before it ended. Pointers to the lists are another."""

    def __init__(self, values: EliasFano, pointers: EliasFano, base: EliasFano) -> None:
        self.values, self.pointers, self.base = values, pointers, base

    @classmethod
    def build(cls, owner: np.ndarray, values: np.ndarray, lists: int) -> Ranges:
        """``values`` are sorted within each ``owner``, owners are sorted."""
        counts = np.bincount(owner, minlength=lists)
        ends = np.cumsum(counts)
        tops = np.zeros(lists, np.int64)
        tops[counts > 0] = values[ends[counts > 0] - 1] + 1
        base = np.cumsum(tops) - tops
        pointers = np.concatenate([[0], ends])
        return cls(EliasFano.build(values + base[owner]), EliasFano.build(pointers), EliasFano.build(base))

    def find(self, owner: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The place of each value within its owner's list, counted over all lists; -1 if absent
        or if there is no owner. The lists are one rising sequence, which is searched for all at once."""
        out = np.full(len(owner), -1, np.int64)
        there = np.flatnonzero((owner >= 0) & (value >= 0))
        if not len(there) or not self.values.size:
            return out
        own = owner[there]
        wanted = value[there] + self.base.whole[own]
        at = np.searchsorted(self.values.whole, wanted)
        # Beyond the last of its list lie those of the next.
        hit = at < self.pointers.whole[own + 1]
        hit[hit] = self.values.whole[at[hit]] == wanted[hit]
        out[there[hit]] = at[hit]
        return out

    def first(self, owner: np.ndarray) -> np.ndarray:
        return self.pointers.whole[owner]


FLOOR, CODES = -30.0, 65_535


def quantise(logs: np.ndarray) -> np.ndarray:
    return np.round((np.clip(logs, FLOOR, 0) / FLOOR) * CODES).astype(np.uint16)


def restore(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) / CODES * FLOOR


def _given(sums: np.ndarray, at: np.ndarray, known: np.ndarray | None) -> np.ndarray:
    """The sums, but what is ``known`` of a row where that is not negative."""
    if known is not None:
        there = known >= 0
        sums[at[there]] = known[there]
    return sums


class NgramTrie:
    """Probabilities of ``c`` after ``b`` and after ``a b``, where ``b`` is the root.

    Level 1: the words ``b``. Level 2: the successors ``c`` of each ``b``, and likewise the words
    ``a`` before it. Level 3: the successors of each pair ``a b``, numbered by their place among
    the successors of ``b``: few numbers, however large the vocabulary.
    """

    def __init__(self, roots: EliasFano, successors: Ranges, before: Ranges, third: Ranges, second_code, third_code) -> None:
        self.roots, self.successors, self.before, self.third = roots, successors, before, third
        self.second_code, self.third_code = second_code, third_code
        # Sorted root words, searched as a whole.
        self.words = roots.whole

    @classmethod
    def build(cls, a, b, c, count, log_second, weight_third: float, pair_count=None, context_count=None) -> NgramTrie:
        """From distinct ``a b c`` with counts.

        ``log_second(b, c, n)`` gives the smoothed log10 probability of ``c`` after ``b`` seen ``n``
        times; level 3 mixes in the share among ``a b`` with ``weight_third``. Counts of ``b c`` and
        ``a b`` are sums over the rows, but for rows where ``pair_count`` and ``context_count`` are not
        negative: those n-grams are not all here. Contexts without a count are left out.
        """
        words, root = np.unique(b, return_inverse=True)
        (pair_root, pair_c), at_pair = distinct_rows(root, c)
        n_pair = _given(np.bincount(at_pair, count, len(pair_root)), at_pair, pair_count)
        second = log_second(words[pair_root], pair_c, n_pair)
        successors = Ranges.build(pair_root, pair_c, len(words))
        deep = np.flatnonzero(context_count != 0) if context_count is not None else np.arange(len(a))
        (context_root, context_a), at_context = distinct_rows(root[deep], a[deep])
        before = Ranges.build(context_root, context_a, len(words))
        n_context = np.bincount(at_context, count[deep], len(context_root))
        n_context = _given(n_context, at_context, context_count[deep] if context_count is not None else None)
        relative = at_pair[deep] - successors.first(root[deep])
        order = np.argsort(at_context * (relative.max(initial=0) + 1) + relative)
        third = Ranges.build(at_context[order], relative[order], len(context_root))
        share = count[deep][order] / n_context[at_context[order]]
        log_third = np.log10(weight_third * share + (1 - weight_third) * 10 ** second[at_pair[deep][order]])
        return cls(EliasFano.build(words), successors, before, third, quantise(second), quantise(log_third))

    def score(self, a, b, c, log_unseen, weight_third: float) -> np.ndarray:
        """log10 probabilities; ``log_unseen(b, c)`` is that of a ``c`` never seen after ``b``."""
        root = np.searchsorted(self.words, b)
        known = root < len(self.words)
        known[known] = self.words[root[known]] == b[known]
        root = np.where(known, root, -1)
        at_second = self.successors.find(root, c)
        seen = at_second >= 0
        out = log_unseen(b, c)
        out[seen] = restore(self.second_code[at_second[seen]])
        context = self.before.find(root, a)
        deep = np.flatnonzero(context >= 0)
        relative = np.where(seen[deep], at_second[deep] - self.successors.first(root[deep]), -1)
        at_third = self.third.find(context[deep], relative)
        hit = at_third >= 0
        out[deep[~hit]] += np.log10(1 - weight_third)
        out[deep[hit]] = restore(self.third_code[at_third[hit]])
        return out

    def _levels(self) -> dict[str, np.ndarray]:
        parts = {"roots": self.roots}
        for name in ("successors", "before", "third"):
            ranges = getattr(self, name)
            parts |= {f"{name}.{k}": getattr(ranges, k) for k in ("values", "pointers", "base")}
        arrays = {f"{n}.{k}": v for n, e in parts.items() for k, v in e.arrays.items()}
        return arrays | {"second_code": self.second_code, "third_code": self.third_code}

    def mapped(self) -> NgramTrie:
        """The same trie over one memory map; what is not asked for needs no memory of its own."""
        arrays = self._levels()
        space = mmap.mmap(-1, max(1, sum(-(-v.nbytes // 8) * 8 for v in arrays.values())))
        at, views = 0, {}
        for name, v in arrays.items():
            view = np.frombuffer(space, v.dtype, len(v), at)
            view[:] = v
            views[name], at = view, at + -(-v.nbytes // 8) * 8

        def sequence(name: str) -> EliasFano:
            return EliasFano({k: views[f"{name}.{k}"] for k in ("low", "high", "shift")})

        ranges = [Ranges(*(sequence(f"{n}.{k}") for k in ("values", "pointers", "base"))) for n in ("successors", "before", "third")]
        return NgramTrie(sequence("roots"), *ranges, views["second_code"], views["third_code"])

"""Rules as one deterministic automaton over bytes.

Each rule's pattern becomes a nondeterministic automaton; subset construction turns it into
a scanner of leftmost, longest, non-overlapping matches; the scanners of all rules run side
by side as one product automaton, which is minimised and stored as one transition array.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ALL = (1 << 256) - 1


class _Parser:
    """Literals, ``\\xhh`` and other escapes, classes, groups, ``|``, ``? * + {m} {m,} {m,n}``."""

    def __init__(self, pattern: str) -> None:
        self.text, self.at = pattern, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def char(self) -> int:
        c = self.take()
        if c == "\\":
            c = self.take()
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        if ord(c) > 127:
            raise ValueError("patterns are ASCII")
        return ord(c)

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        node = self.atom()
        while self.peek() and self.peek() in "?*+{":
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None), "{": (0, 0)}[c := self.take()]
            if c == "{":
                end = self.text.index("}", self.at)
                first, comma, last = self.text[self.at : end].partition(",")
                low, high = int(first), int(last) if last else None if comma else int(first)
                self.at = end + 1
            node = ("rep", node, low, high)
        return node

    def atom(self):
        if self.peek() == "(":
            self.take()
            node = self.alternatives()
            self.take()
            return node
        if self.peek() != "[":
            return ("set", 1 << self.char())
        self.take()
        mask = 0
        while self.peek() != "]":
            low = high = self.char()
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.char()
            mask |= sum(1 << b for b in range(low, high + 1))
        self.take()
        return ("set", mask)


class Nfa:
    """``arcs[s]`` holds (byte mask, target), ``free[s]`` targets reached without a byte."""

    def __init__(self, pattern: str) -> None:
        self.arcs: list[list[tuple[int, int]]] = []
        self.free: list[list[int]] = []
        start = self._new()
        self.end = self._add(_Parser(pattern).alternatives(), start)
        self.start = self.closure({start})
        if self.end in self.start:
            raise ValueError(f"matches nothing at all: {pattern}")
        back: list[list[tuple[int, int]]] = [[] for _ in self.arcs]
        idle: list[list[int]] = [[] for _ in self.arcs]
        for s, arcs in enumerate(self.arcs):
            for mask, t in arcs:
                back[t].append((mask, s))
            for t in self.free[s]:
                idle[t].append(s)
        self._back, self._idle, self._first = back, idle, start

    def _new(self) -> int:
        self.arcs.append([])
        self.free.append([])
        return len(self.arcs) - 1

    def _add(self, node, at: int) -> int:
        kind = node[0]
        if kind == "set":
            end = self._new()
            self.arcs[at].append((node[1], end))
            return end
        if kind == "cat":
            for part in node[1]:
                at = self._add(part, at)
            return at
        if kind == "alt":
            end = self._new()
            for option in node[1]:
                begin = self._new()
                self.free[at].append(begin)
                self.free[self._add(option, begin)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            at = self._add(inner, at)
        end = self._new()
        self.free[at].append(end)
        if high is None:
            self.free[self._add(inner, end)].append(end)
            return end
        for _ in range(high - low):
            at = self._add(inner, at)
            self.free[at].append(end)
        return end

    def closure(self, states: set[int], free=None) -> frozenset[int]:
        free = self.free if free is None else free
        found, todo = set(states), list(states)
        while todo:
            for t in free[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)

    def move(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({t for s in states for mask, t in self.arcs[s] if mask >> byte & 1})

    def first_start(self, data: bytes, low: int, end: int) -> int:
        """The leftmost place from ``low`` on whose match ends at ``end``, found backwards."""
        states, best = self.closure({self.end}, self._idle), end
        for at in range(end - 1, low - 1, -1):
            byte = data[at]
            states = self.closure({t for s in states for mask, t in self._back[s] if mask >> byte & 1}, self._idle)
            if not states:
                break
            if self._first in states:
                best = at
        return best

    def matches(self, data: bytes) -> bool:
        states = self.start
        for byte in data:
            states = self.move(states, byte)
            if not states:
                return False
        return self.end in states


@dataclass(frozen=True)
class Rule:
    """``pattern`` is what a match consumes; it counts only if it also fits ``keep``.

    ``quiet`` matches that do not fit are not reported by the automaton at all. That is
    for patterns whose matches cannot reach back over the end of a dropped one.
    """

    name: str
    pattern: str
    keep: str
    quiet: bool = False


class _Scanner:
    """Subset construction for one rule. A state lists, by place of start, the sets of
    positions that matches in progress may be in; the earliest start wins.

    No match may have to be given back: once a pattern has matched, it goes on matching
    until it ends, and no later start may match while an earlier one is undecided. Rules for
    which that does not hold are refused here, when they are compiled.
    """

    def __init__(self, rule: Rule, samples: list[int]) -> None:
        self.rule = rule
        self.nfa = Nfa(rule.pattern)
        self.fit = Nfa(rule.keep) if rule.quiet else None
        self.states = {((), 0): 0}
        self.rows: list[list[int]] = []
        order = [((), 0)]
        for state in order:
            row = []
            for byte in samples:
                after = self._step(state[0], byte)
                if after not in self.states:
                    self.states[after] = len(order)
                    order.append(after)
                row.append(self.states[after])
            self.rows.append(row)
        self.outputs = [out for _, out in order]

    def _done(self, group) -> bool:
        return self.nfa.end in group[0]

    def _advance(self, group, byte: int):
        return self.nfa.move(group[0], byte), self.fit.move(group[1], byte) if self.fit else frozenset()

    def _step(self, groups: tuple, byte: int) -> tuple[tuple, int]:
        out, fresh = 0, (self.nfa.start, self.fit.start if self.fit else frozenset())
        if groups and self._done(groups[0]):
            after = self._advance(groups[0], byte)
            if after[0]:
                if not self._done(after):
                    raise ValueError(f"{self.rule.name}: a match may have to be given back")
                return (after,), 0
            out = int(self.fit is None or self.fit.end in groups[0][1])
            groups = ()
        moved = [self._advance(group, byte) for group in (*groups, fresh)]
        moved = list(dict.fromkeys(group for group in moved if group[0]))
        done = [i for i, group in enumerate(moved) if self._done(group)]
        if done and done[0] > 0:
            raise ValueError(f"{self.rule.name}: a later start may match first")
        return (tuple(moved[:1]) if done else tuple(moved)), out


def _minimise(moves: np.ndarray, outputs: np.ndarray) -> np.ndarray:
    """The class of each state: states of a class give the same outputs for ever."""
    label = np.unique(outputs, return_inverse=True)[1]
    count = int(label.max()) + 1
    while True:
        rows = np.column_stack([label, label[moves]])
        label = np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)
        if int(label.max()) + 1 == count:
            return label
        count = int(label.max()) + 1


class Automaton:
    """All rules at once: ``next_state[state * width + class_of[byte]]``. States from
    ``loud`` on report: bit ``k`` of ``output`` says that a match of rule ``k`` has ended
    before the byte that led there."""

    STRIDE = 512

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        nfas = [Nfa(r.pattern) for r in rules]
        masks = sorted({mask for nfa in nfas for arcs in nfa.arcs for mask, _ in arcs})
        signs: dict[tuple, int] = {}
        classes = [signs.setdefault(tuple(m >> b & 1 for m in masks), len(signs)) for b in range(256)]
        samples = [classes.index(c) for c in range(len(signs))]
        scanners = [_Scanner(rule, samples) for rule in rules]
        ids, order, rows = {(0,) * len(rules): 0}, [(0,) * len(rules)], []
        for state in order:
            row = []
            for c in range(len(samples)):
                after = tuple(s.rows[q][c] for s, q in zip(scanners, state, strict=True))
                if after not in ids:
                    ids[after] = len(order)
                    order.append(after)
                row.append(ids[after])
            rows.append(row)
        outputs = np.array([sum(s.outputs[q] << k for k, (s, q) in enumerate(zip(scanners, o, strict=True))) for o in order])
        moves = np.array(rows)
        label = _minimise(moves, outputs)
        # Silent states first; the start is state 0.
        firsts = np.unique(label, return_index=True)[1]
        ranked = sorted(range(len(firsts)), key=lambda c: (outputs[firsts[c]] > 0, c != label[0], c))
        place = np.empty(len(firsts), np.int64)
        place[ranked] = np.arange(len(ranked))
        kept = firsts[ranked]
        self.class_of = np.array(classes, np.uint8)
        self.width = len(samples)
        self.next_state = place[label[moves[kept]]].astype(np.int32).reshape(-1)
        self.output = outputs[kept]
        self.loud = int((self.output == 0).sum())
        table = self.next_state.reshape(-1, self.width)
        like_start = (table == table[0]).all(axis=1)
        self.resets = like_start[table].all(axis=0)[self.class_of]
        self.patterns, self.keeps = nfas, [Nfa(r.keep) for r in rules]
        if not self.resets[0xFF]:
            raise ValueError("no byte ends every match")

    def events(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where matches have ended, and of which rules. ``data`` ends with 0xFF.

        The bytes are cut after bytes that lead every state back to the start, into pieces
        of about ``STRIDE``, which are then scanned side by side, a byte of each at a time.
        """
        breaks = np.flatnonzero(self.resets[data]) + 1
        wanted = np.searchsorted(breaks, np.arange(self.STRIDE, len(data), self.STRIDE))
        starts = np.unique(np.concatenate([[0], breaks[wanted[wanted < len(breaks)]]]))
        starts = starts[starts < len(data)]
        lengths = np.diff(np.concatenate([starts, [len(data)]]))
        order = np.argsort(-lengths, kind="stable")
        at, lengths = starts[order], lengths[order]
        symbols = self.class_of[data]
        active = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
        state = np.zeros(len(at), np.int32)
        places, states = [], []
        for n in active.tolist():
            at, state = at[:n], state[:n]
            state = self.next_state.take(state * self.width + symbols.take(at))
            if state.max() >= self.loud:
                hit = np.flatnonzero(state >= self.loud)
                places.append(at[hit])
                states.append(state[hit])
            at = at + 1
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places, states = np.concatenate(places), np.concatenate(states)
        order = np.argsort(places)
        return places[order], self.output[states[order]]

    def spans(self, data: bytes, ends: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """``start, rule, end`` of the matches of one text that fit, from its events."""
        found, last = [], [0] * len(self.rules)
        for end, mask in ends:
            for k, rule in enumerate(self.rules):
                if mask >> k & 1:
                    start = self.patterns[k].first_start(data, last[k], end)
                    last[k] = end
                    if rule.quiet or self.keeps[k].matches(data[start:end]):
                        found.append((start, k, end))
        return sorted(found)

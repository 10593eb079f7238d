"""Weighted acyclic automata over words: count transducers.

A path from the root spells a phrase, one word to an arc; the arc that ends it
carries its count (0: no phrase ends there). States that are equal, arc for arc,
are one state, so the many phrases that go on alike share their ends.

An automaton is built from phrases in sorted order: once a prefix is passed, its
state is complete and is registered, deepest first. Phrases are rows of word
numbers, from 1, filled up with 0; words are numbered in the order of their bytes,
so rows in order are phrases in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


def in_order(rows: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows, and where in it each different one begins."""
    bits, width = int(n_words).bit_length(), rows.shape[1]
    if bits * width <= 63:
        key = np.zeros(len(rows), np.int64)
        for column in range(width):
            key = (key << bits) | rows[:, column]
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = key[1:] != key[:-1]
    else:
        order = np.lexsort(rows.T[::-1])
        held = rows[order]
        new = (held[1:] != held[:-1]).any(axis=1)
    return order, np.flatnonzero(np.concatenate([[len(rows) > 0], new])[: len(rows)])


@dataclass(frozen=True)
class CountTransducer:
    """``first`` has the place of the first arc of each state; state 0 has none.
    Arcs of a state are in the order of their words."""

    words: list[bytes]
    first: np.ndarray
    word: np.ndarray
    count: np.ndarray
    target: np.ndarray
    root: int

    @classmethod
    def build(cls, words: list[bytes], rows: np.ndarray, counts: np.ndarray) -> CountTransducer:
        """From different phrases in order; words that no row has are left out."""
        used = np.unique(rows)
        used = used[used > 0]
        rows = np.searchsorted(used, rows) + (rows > 0)
        arcs: list[tuple] = []
        sizes = [np.zeros(1, np.int64)]
        n_states, width, below = 1, rows.shape[1], None
        # Rows at which each prefix of a length begins, from the full length down.
        new = np.zeros(len(rows), bool)
        starts = []
        for column in range(width):
            new |= np.concatenate([[True], rows[1:, column] != rows[:-1, column]])[: len(rows)]
            starts.append(np.flatnonzero(new & (rows[:, column] > 0)))
        for column in range(width - 1, -1, -1):
            at = starts[column]
            ends_here = rows[at, column + 1] == 0 if column + 1 < width else np.ones(len(at), bool)
            count = np.where(ends_here, counts[at], 0)
            target = np.zeros(len(at), np.int64)
            if below is not None:
                parent, state = below
                target[parent] = state
            # Arcs that leave one state: those whose rows share the prefix before.
            owner = np.searchsorted(starts[column - 1], at, "right") - 1 if column else np.zeros(len(at), np.int64)
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)])
            kept, state = _register(rows[at, column], count, target, heads)
            size = np.diff(np.append(heads, len(at)))
            members = np.repeat(kept, size)
            arcs.append((rows[at, column][members] - 1, count[members], target[members]))
            sizes.append(size[kept])
            below = owner[heads], n_states + state
            n_states += int(kept.sum())
        first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        word, count, target = (np.concatenate(x) for x in zip(*arcs))
        root = int(below[1][0]) if len(below[1]) else 0
        return cls([words[i - 1] for i in used], first, word, count, target, root)

    # Paths

    def _onward(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``states``, arc) of all arcs that leave them."""
        size = self.first[states + 1] - self.first[states]
        place = np.repeat(np.arange(len(states)), size)
        skipped = np.cumsum(size) - size
        return place, np.arange(len(place)) - skipped[place] + self.first[states][place]

    def phrases(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of word numbers from 1, counts) of the phrases of each length."""
        states, paths = np.array([self.root]), np.zeros((1, 0), np.int64)
        while len(states):
            place, arc = self._onward(states)
            paths = np.column_stack([paths[place], self.word[arc] + 1])
            counted = self.count[arc] > 0
            if counted.any():
                yield paths[counted], self.count[arc][counted]
            inner = self.target[arc] > 0
            states, paths = self.target[arc][inner], paths[inner]

    def compose(self, asked: CountTransducer) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of word numbers of ``asked``, own counts) of the phrases that both have."""
        number = {word: i for i, word in enumerate(self.words)}
        own = np.array([number.get(word, -1) for word in asked.words], np.int64)
        n = max(len(self.words), 1)
        state_of_arc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        keys = state_of_arc * n + self.word
        mine, theirs, paths = np.array([self.root]), np.array([asked.root]), np.zeros((1, 0), np.int64)
        while len(mine) and len(keys):
            place, arc = asked._onward(theirs)
            word = own[asked.word[arc]]
            sought = mine[place] * n + word
            at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
            met = (word >= 0) & (keys[at] == sought)
            place, arc, at = place[met], arc[met], at[met]
            paths = np.column_stack([paths[place], asked.word[arc] + 1])
            both = (asked.count[arc] > 0) & (self.count[at] > 0)
            if both.any():
                yield paths[both], self.count[at][both]
            inner = (asked.target[arc] > 0) & (self.target[at] > 0)
            mine, theirs, paths = self.target[at][inner], asked.target[arc][inner], paths[inner]

    # Bytes

    def dump(self) -> bytes:
        lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        parts = [b"".join(self.words)]
        for values in (lengths, np.diff(self.first), self.word, self.count, self.target):
            values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
            parts += [values.dtype.str.encode(), values.tobytes()]
        head = np.array([self.root, len(parts), *map(len, parts)], "<i8")
        return head.tobytes() + b"".join(parts)

    @classmethod
    def load(cls, data: bytes) -> CountTransducer:
        root, n = (int(x) for x in np.frombuffer(data, "<i8", 2))
        ends = np.cumsum(np.concatenate([[16 + 8 * n], np.frombuffer(data, "<i8", n, 16)]))
        parts = [data[a:b] for a, b in zip(ends[:-1], ends[1:])]
        lengths, sizes, word, count, target = (
            np.frombuffer(x, kind.decode()).astype(np.int64) for kind, x in zip(parts[1::2], parts[2::2])
        )
        stops = np.cumsum(lengths).tolist()
        words = [parts[0][a:b] for a, b in zip([0, *stops], stops)]
        return cls(words, np.concatenate([[0], np.cumsum(sizes)]), word, count, target, root)


def _register(word: np.ndarray, count: np.ndarray, target: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the states that begin at ``heads`` are kept, and for every state
    the number of the kept one that equals it, arc for arc."""
    if not len(heads):
        return np.zeros(0, bool), np.zeros(0, np.int64)
    size = np.diff(np.append(heads, len(word)))
    place = np.arange(len(word)) - np.repeat(heads, size)
    mixed = place.astype(np.uint64)
    for values in (word, count, target):
        mixed = (mixed ^ values.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    digest = np.add.reduceat(mixed, heads) + size.astype(np.uint64)
    order = np.argsort(digest, kind="stable")
    new = np.concatenate([[True], digest[order][1:] != digest[order][:-1]])
    leader = np.empty(len(heads), np.int64)
    leader[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    # Digests may meet by chance: compare the arcs.
    other = np.minimum(np.repeat(heads[leader], size) + place, len(word) - 1)
    differ = (word != word[other]) | (count != count[other]) | (target != target[other])
    unlike = np.logical_or.reduceat(differ, heads) | (size != size[leader])
    leader = np.where(unlike, np.arange(len(heads)), leader)
    kept = leader == np.arange(len(heads))
    return kept, (np.cumsum(kept) - 1)[leader]


def union(parts: list[CountTransducer]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, phrases in order, counts): all phrases of the automata, the counts
    of equal ones summed."""
    words = sorted({word for part in parts for word in part.words})
    number = {word: i + 1 for i, word in enumerate(words)}
    held = []
    for part in parts:
        own = np.array([0, *(number[word] for word in part.words)], np.int64)
        held += [(own[rows], counts) for rows, counts in part.phrases()]
    width = max((rows.shape[1] for rows, _ in held), default=1)
    rows = np.zeros((sum(len(x) for x, _ in held), width), np.int64)
    at = 0
    for found, _ in held:
        rows[at : at + len(found), : found.shape[1]] = found
        at += len(found)
    counts = np.concatenate([np.zeros(0, np.int64), *(x for _, x in held)])
    order, heads = in_order(rows, len(words))
    summed = np.add.reduceat(counts[order], heads) if len(heads) else counts
    return words, rows[order[heads]], summed

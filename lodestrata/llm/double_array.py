"""Double-array tries over small whole numbers as symbols, built and walked by numpy."""

from __future__ import annotations

import numpy as np

# Symbols are below this; larger numbers are given as several digits.
SYMBOLS = 256
# Families of so many children get an own stretch of the array, smaller ones its gaps.
_LARGE = 16


def digits(numbers: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` digits of each number, the highest first; of negative numbers -1."""
    places = [(numbers >> (8 * k)) & 255 for k in reversed(range(count))]
    return np.where(numbers[:, None] < 0, -1, np.column_stack(places))


class DoubleArray:
    """A trie of sequences of symbols.

    State ``s`` goes on with symbol ``c`` to state ``base[s] + c``, if ``check`` of
    that state is ``s``. ``accept`` of a state is the number of the sequence that
    ends there, else -1. State 0 is the root.
    """

    def __init__(self, sequences: np.ndarray, lengths: np.ndarray) -> None:
        """``sequences`` has a row for each distinct sequence, of which ``lengths`` symbols count."""
        n, depth = sequences.shape
        families = []
        node, nodes = np.zeros(n, np.int64), 1
        for level in range(depth):
            rows = np.flatnonzero(lengths > level)
            links, inverse = np.unique(
                node[rows] * SYMBOLS + sequences[rows, level], return_inverse=True)
            node[rows] = nodes + inverse
            parents = links // SYMBOLS
            heads = np.flatnonzero(np.append(True, parents[1:] != parents[:-1])[: len(parents)])
            families.append((parents, links % SYMBOLS, nodes + np.arange(len(links)), heads,
                             np.diff(np.append(heads, len(links)))))
            nodes += len(links)
        wide = sum(int((sizes >= _LARGE).sum()) for *_, sizes in families)
        # State 0 and what lies below the first symbols stay free, and as much at the end.
        self._at = SYMBOLS
        size = (3 + wide) * SYMBOLS + 2 * nodes
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.accept = np.full(size, -1, np.int32)
        self._used = np.zeros(size, bool)
        self._claim = np.zeros(size, np.int32)
        self._state = np.zeros(nodes, np.int64)
        rng = np.random.default_rng(0)
        # Large families first, so that small ones fill the gaps between their children.
        for part in (True, False):
            for family in families:
                self._place(*family, part, rng)
        for parents, symbols, children, *_ in families:
            self.check[self._state[children]] = self._state[parents]
            self.base[self._state[parents]] = self._state[children] - symbols
        self.accept[self._state[node]] = np.arange(n)
        del self._used, self._claim, self._state

    def _place(self, parents, symbols, children, heads, sizes, large: bool, rng) -> None:
        """Gives the children of the large or of the small families of a level their states."""
        if large:
            for k in np.flatnonzero(sizes >= _LARGE):
                own = symbols[heads[k] : heads[k] + sizes[k]]
                self._settle(children[heads[k] : heads[k] + sizes[k]], self._at + own - own[0])
                self._at += int(own[-1] - own[0]) + 1
            return
        waiting = np.flatnonzero(sizes < _LARGE)
        waiting = waiting[np.argsort(-sizes[waiting], kind="stable")]
        while len(waiting):
            now = waiting[: max(4096, len(waiting) // 4)]
            count = sizes[now]
            family = np.repeat(np.arange(len(now)), count)
            links = np.repeat(heads[now] - np.cumsum(count) + count, count) + np.arange(len(family))
            slots = rng.integers(SYMBOLS, len(self.base) - SYMBOLS, len(now))[family] + symbols[links]
            self._claim[slots] = family
            refused = np.bincount(
                family[(self._claim[slots] != family) | self._used[slots]], minlength=len(now)) > 0
            fits = ~refused[family]
            self._settle(children[links[fits]], slots[fits])
            waiting = np.concatenate((now[refused], waiting[len(now) :]))

    def _settle(self, children: np.ndarray, slots: np.ndarray) -> None:
        self._used[slots] = True
        self._state[children] = slots

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the states after a symbol each, whether they exist)."""
        after = self.base[states] + symbols
        return after, self.check[after] == states

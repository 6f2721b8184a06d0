"""A double-array trie over dense ids, built level by level from many sequences at once.

State s goes to BASE[s] + id, if CHECK there is s. A state with one child takes the next free place; for a state with several, the free places are
searched for the first where all its children fit. BASE may be negative; ids are dense, frequent ones small, so the arrays stay close to the number of states.
"""

from __future__ import annotations

import numpy as np

#: Free places looked at in one go for a state with several children.
_WINDOW = 2048


class DoubleArray:
    """States: 0 is the root, others are places of the arrays. ``levels`` has the states of each depth, ``check`` the parent of each (-1: free)."""

    def __init__(self) -> None:
        self.base, self.check = np.zeros(16, np.int64), np.full(16, -1, np.int64)
        self.check[0] = 0
        self.end = 1  # all places from here on are free
        self.holes = np.zeros(0, np.int64)  # free places before the end, ascending
        self.levels: list[np.ndarray] = [np.zeros(1, np.int64)]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _take(self, places: np.ndarray, parents: np.ndarray) -> None:
        top = int(places.max()) + 1
        self._grow(top)
        if top > self.end:
            gap = np.setdiff1d(np.arange(self.end, top), places, assume_unique=True)
            self.holes, self.end = np.concatenate([self.holes[self.check[self.holes] < 0], gap]), top
        self.check[places] = parents

    def _room(self, ids: np.ndarray) -> int:
        """The first base, by the place of the smallest id, at which all ids find free places."""
        self.holes = self.holes[self.check[self.holes] < 0]
        self._grow(self.end + int(ids[-1] - ids[0]) + 1)
        for begin in range(0, len(self.holes), _WINDOW):
            base = self.holes[begin:begin + _WINDOW] - ids[0]
            top = int(base[-1] + ids[-1]) + 1
            self._grow(top)
            fits = np.ones(len(base), bool)
            for i in ids[1:].tolist():
                fits &= self.check[base + i] < 0
            if fits.any():
                return int(base[int(fits.argmax())])
        return self.end - int(ids[0])

    def extend(self, parents: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Add the next level: children (parent, id), which may repeat. Returns the state of each pair."""
        span = np.int64(ids.max()) + 1
        pair, which = np.unique(parents * span + ids, return_inverse=True)
        parent, own = pair // span, pair % span
        first = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
        sizes = np.diff(np.append(first, len(parent)))
        place = np.empty(len(pair), np.int64)
        for k in np.flatnonzero(sizes > 1)[np.argsort(-sizes[sizes > 1], kind="stable")].tolist():
            children = slice(first[k], first[k] + sizes[k])
            base = self._room(own[children])
            place[children] = base + own[children]
            self.base[parent[first[k]]] = base
            self._take(place[children], parent[children])
        alone = first[sizes == 1]
        if len(alone):
            self.holes = self.holes[self.check[self.holes] < 0]
            free = np.concatenate([self.holes[:len(alone)], np.arange(self.end, self.end + max(0, len(alone) - len(self.holes)))])
            place[alone] = free
            self.base[parent[alone]] = free - own[alone]
            self._take(free, parent[alone])
        self.levels.append(place)
        return place[which]

    def go(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The state that each id leads to, -1 where there is none."""
        to = self.base[states] + ids
        inside = (to > 0) & (to < len(self.check))
        out = np.full(len(to), -1)
        own = np.flatnonzero(inside)
        own = own[self.check[to[own]] == states[own]]
        out[own] = to[own]
        return out

"""Words and word shingles of texts as 64-bit hashes, computed on arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return;
A-Z count as a-z. Everything else of the text, case of other letters included, is kept as it is.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_VALUES = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_PIECE = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the public murmur3 finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _piece_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    inside = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
    terms = _VALUES[_LOWER[data[~space]]] * powers(_BASE, int(lengths.max()))[inside]
    return starts, mix(np.add.reduceat(terms, at) + lengths.astype(np.uint64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word. Long texts are handled piece by piece, cut between words."""
    if len(data) <= _PIECE:
        return _piece_hashes(data)
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + _PIECE)
        while end < len(data):
            spaces = np.flatnonzero(_SPACE[data[at:end]])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
                break
            end = min(len(data), end + _PIECE)  # a word longer than a piece
        starts, hashes = _piece_hashes(data[at:end])
        found.append((starts + at, hashes))
        at = end
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def words_by_text(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, bounds): the words of text i are hashes[bounds[i]:bounds[i + 1]]."""
    if len(offsets) == 2:
        _, hashes = word_hashes(data)
        return hashes, np.array([0, len(hashes)])
    n = len(offsets) - 1
    parted = np.full(len(data) + n, 0x20, np.uint8)  # a space after each text
    place = np.ones(len(parted), bool)
    place[offsets[1:] + np.arange(n)] = False
    parted[place] = data
    starts, hashes = word_hashes(parted)
    return hashes, np.searchsorted(starts, offsets + np.arange(n + 1))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; with fewer words (but some), of the whole sequence."""
    take = min(width, len(words))
    if not take:
        return np.zeros(0, np.uint64)
    total = np.full(len(words) - take + 1, take, np.uint64)
    for k in range(take):
        total = total * _STEP + words[k:len(words) - take + 1 + k]
    return mix(total)

"""Minimal perfect hashing of 64-bit keys: hash and displace, in shards of some 16,000 keys.

A shard's keys are dealt to small buckets. The largest buckets first, each gets the first seed that sends its keys to free slots; a bucket of one
key names its slot outright (a negative seed). n keys take the slots 0 to n - 1, so counts need no keys beside them; :class:`Table` keeps the keys
all the same and answers only for keys that it holds.
"""

from __future__ import annotations

import numpy as np

from strata.llm.words import mix

#: Mean keys of a shard and of a bucket.
SHARD_KEYS = 16_384
BUCKET_KEYS = 4
_TRIED = 64  # seeds tried at a time
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_INNER = np.uint64(0xD6E8FEB86659FD93)


def shard_hash(keys: np.ndarray) -> np.ndarray:
    """A non-negative bigint; a key's shard is this modulo the number of shards."""
    return (mix(keys ^ _INNER) >> np.uint64(1)).astype(np.int64)


def _buckets(h: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.maximum(1, np.asarray(n) // BUCKET_KEYS).astype(np.uint64)).astype(np.int64)


def _slots(h: np.ndarray, seed: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    shuffled = mix(h + seed.astype(np.uint64) * _GOLDEN)
    return np.where(seed < 0, -1 - seed, (shuffled % np.asarray(n).astype(np.uint64)).astype(np.int64))


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seed of each bucket, slot of each key) for distinct keys (uint64)."""
    n = len(keys)
    h = mix(keys)
    bucket = _buckets(h, n)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=max(1, n // BUCKET_KEYS))
    begin = np.cumsum(sizes) - sizes
    seeds, slot, taken = np.zeros(len(sizes), np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    by_size = np.argsort(-sizes, kind="stable")
    for b in by_size[:int((sizes > 1).sum())].tolist():
        members = order[begin[b]:begin[b] + sizes[b]]
        first = 0
        while True:
            tried = np.arange(first, first + _TRIED)
            to = _slots(h[members][None, :], tried[:, None], n)
            apart = np.sort(to, axis=1)
            good = ~taken[to].any(axis=1) & (apart[:, 1:] != apart[:, :-1]).all(axis=1)
            if good.any():
                which = int(good.argmax())
                break
            first += _TRIED
        seeds[b], slot[members] = first + which, to[which]
        taken[to[which]] = True
    single = np.flatnonzero(sizes == 1)
    free = np.flatnonzero(~taken)
    slot[order[begin[single]]] = free
    seeds[single] = -1 - free
    return seeds, slot


class Table:
    """Shards (numbers, seeds, keys by slot, counts by slot) of a hashed table of ``shards`` shards in all; others count as empty."""

    def __init__(self, shards: int, parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> None:
        parts = sorted(parts, key=lambda p: p[0])
        self.shards = max(1, shards)
        self.sizes = np.zeros(self.shards, np.int64)
        self.first_seed = np.zeros(self.shards, np.int64)
        number = [p[0] for p in parts]
        self.sizes[number] = [len(p[2]) for p in parts]
        many = np.zeros(self.shards, np.int64)
        many[number] = [len(p[1]) for p in parts]
        self.first_seed, self.first_slot = np.cumsum(many) - many, np.cumsum(self.sizes) - self.sizes
        self.seeds, self.keys, self.counts = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, t) for k, t in ((1, np.int64), (2, np.uint64), (3, np.int64)))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key among all slots, -1 for keys that are not held."""
        out = np.full(len(keys), -1)
        shard = shard_hash(keys) % self.shards
        there = np.flatnonzero(self.sizes[shard])
        shard, h = shard[there], mix(keys[there])
        n = self.sizes[shard]
        at = self.first_slot[shard] + _slots(h, self.seeds[self.first_seed[shard] + _buckets(h, n)], n)
        own = self.keys[at] == keys[there]
        out[there[own]] = at[own]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Count of each key, 0 for keys that are not held."""
        at = self.index(keys)
        out = np.zeros(len(keys), np.int64)
        out[at >= 0] = self.counts[at[at >= 0]]
        return out

"""Token ids of whole texts by a byte-level BPE tokenizer file, fast for texts that repeat their words.

The tokenizer splits a text before a single space that stands between two visible characters, whatever
comes next to them; the pieces between such places are encoded independently of each other. So the
distinct pieces of a block are encoded once and their ids are dealt out to all places. Pieces that begin
or end a text in another way than such places do are encoded one by one, as they are.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from strata.llm.common import flat
from strata.llm.words import mix, powers

_BASE = np.uint64(0xA0761D6478BD642F)
#: Bytes of pieces that are hashed or encoded at a time: both make some 50 bytes of arrays or tokens for each.
CHUNK = 256 << 10


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=4)
def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(maxsize=4)
def byte_lengths(path: str) -> np.ndarray:
    """Bytes that each id stands for. A byte-level vocabulary writes every byte as one character."""
    vocabulary = load(path).get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        out[i] = len(token)
    return out


def _encode(path: str, texts: list[bytes]) -> list[np.ndarray]:
    found = load(path).encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
    return [np.array(e.ids, np.uint32) for e in found]


def _splits(data: np.ndarray) -> np.ndarray:
    """Places of single spaces between visible characters (ASCII or two-byte letters; those are never spaces)."""
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 1) & (at < len(data) - 1)]
    before, lead, after = data[at - 1], data[at - 2], data[at + 1]
    left = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (before < 0xC0) & (lead >= 0xC3) & (lead < 0xE0))
    right = ((after > 0x20) & (after < 0x7F)) | ((after >= 0xC3) & (after < 0xE0))
    return at[left & right]


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs [first, last) of pieces with about CHUNK bytes together."""
    reach = np.cumsum(sizes) // CHUNK
    edges = np.flatnonzero(np.concatenate(([True], reach[1:] != reach[:-1], [True]))).tolist() if len(sizes) else []
    yield from zip(edges[:-1], edges[1:], strict=True)


def _keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each piece; the pieces follow each other without a gap."""
    out, table, power = np.empty(len(starts), np.uint64), mix(np.arange(1, 257, dtype=np.uint64)), powers(_BASE, int(lengths.max()))
    for a, b in _chunks(lengths):
        own, first = data[starts[a]:starts[b - 1] + lengths[b - 1]], starts[a:b] - starts[a]
        place = np.arange(len(own)) - np.repeat(first, lengths[a:b])
        out[a:b] = np.add.reduceat(table[own] * power[place], first)
    return mix(out + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Known:
    """Pieces that this process has encoded: their keys (sorted, with their rows in ``at``), bytes and ids. Holds MOST pieces or BYTES bytes, then keeps those it has."""

    MOST = 600_000
    BYTES = 16 << 20

    def __init__(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.row = np.zeros(0, np.int32)
        self.at = np.zeros((0, 4), np.int32)  # first byte, bytes, first id, ids
        self.data = np.zeros(0, np.uint8)
        self.ids = np.zeros(0, np.uint32)

    def full(self) -> bool:
        return len(self.keys) > self.MOST or len(self.data) > self.BYTES

    def find(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Row of each piece in ``at``, -1 if it is not known. Bytes are compared, so equal keys of different pieces do no harm."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        row = self.row[place]
        hit = np.flatnonzero((self.keys[place] == keys) & (self.at[row, 1] == lengths))
        sizes = lengths[hit]
        equal = self.data[flat(self.at[row[hit], 0], sizes)] == data[flat(starts[hit], sizes)]
        same = np.logical_and.reduceat(equal, np.cumsum(sizes) - sizes) if len(hit) else np.zeros(0, bool)
        out = np.full(len(keys), -1)
        out[hit[same]] = row[hit[same]]
        return out

    def add(self, keys: np.ndarray, joined: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        fresh = np.column_stack([np.cumsum(sizes) - sizes + len(self.data), sizes, np.cumsum(counts) - counts + len(self.ids), counts]).astype(np.int32)
        self.data, self.ids = np.concatenate([self.data, joined]), np.concatenate([self.ids, ids])
        place = np.searchsorted(self.keys, keys) + np.arange(len(keys))
        old = np.ones(len(self.keys) + len(keys), bool)
        old[place] = False
        for name, values in (("keys", keys), ("row", np.arange(len(self.at), len(old), dtype=np.int32))):
            both = np.empty(len(old), values.dtype)
            both[place], both[old] = values, getattr(self, name)
            setattr(self, name, both)
        self.at = np.concatenate([self.at, fresh])


_KNOWN: dict[str, Known] = {}


def encode(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of several texts: (ids, bounds), the ids of text i are ids[bounds[i]:bounds[i + 1]]."""
    n = len(offsets) - 1
    edge = np.zeros(len(data) + 2, bool)
    edge[offsets] = True
    at = _splits(data)
    begin_here = edge.copy()
    begin_here[at[~edge[at] & ~edge[at + 1]]] = True
    begin_here[len(data):] = False
    starts = np.flatnonzero(begin_here)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
    ends = np.append(starts[1:], len(data))
    plain = ~edge[starts] & ~edge[ends]  # begins with " x" and is followed by " x"
    lengths = ends - starts
    key = _keys(data, starts, lengths)
    which = np.flatnonzero(plain)
    keys, chosen, same = np.unique(key[which], return_index=True, return_inverse=True)
    chosen = which[chosen]
    counts = np.zeros(len(starts), np.int64)
    begin = np.zeros(len(starts), np.int64)
    known = _KNOWN.setdefault(path, Known())
    row = known.find(keys, data, starts[chosen], lengths[chosen])
    own_counts, own_begin = known.at[row, 3] if len(known.at) else np.zeros(len(row), np.int64), known.at[row, 2] if len(known.at) else np.zeros(len(row), np.int64)
    pool: list[np.ndarray] = [known.ids]
    filled_to = len(known.ids)
    new = np.flatnonzero(row < 0)
    if len(new):
        sizes = lengths[chosen[new]]
        joined = data[flat(starts[chosen[new]], sizes)]
        reach = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.concatenate([_encode(path, [joined[reach[a]:reach[b]].tobytes()])[0] for a, b in _chunks(sizes)])
        reach = np.concatenate(([0], np.cumsum(byte_lengths(path)[ids])))
        if reach[-1] != len(joined):
            raise ValueError("the tokenizer changes its texts; byte-level files are needed")
        cut = np.searchsorted(reach, np.concatenate(([0], np.cumsum(sizes))))
        own_counts[new], own_begin[new] = np.diff(cut), cut[:-1] + filled_to
        pool.append(ids)
        filled_to += len(ids)
        if known.full() and 2 * len(new) > len(row):  # the texts have changed: start anew
            known = _KNOWN[path] = Known()
        if not known.full() and len(joined) <= Known.BYTES:
            known.add(keys[new], joined, sizes, ids, np.diff(cut))
    counts[which], begin[which] = own_counts[same], own_begin[same]
    rest = np.flatnonzero(~plain)
    for i, ids in zip(rest, _encode(path, [data[starts[i]:ends[i]].tobytes() for i in rest]), strict=True):
        counts[i], begin[i] = len(ids), filled_to
        pool.append(ids)
        filled_to += len(ids)
    ids = np.concatenate(pool)[flat(begin, counts)]
    reach = np.concatenate(([0], np.cumsum(counts)))
    return ids, reach[np.searchsorted(starts, offsets)]

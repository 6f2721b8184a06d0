"""Bloom filters over 64-bit keys, made by tasks and of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mapped
from strata.llm.words import mix

CHUNKS = 64
#: Bits of a filter at most (64 MB). With more keys than fit it lets more pass; it never holds back a key.
MOST_BITS = 1 << 29
_SALTS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


class Bloom:
    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits  # (CHUNKS, bytes)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """For every key (uint64) whether it may be in the set; False is certain."""
        chunk, places = _places(keys, self.bits.shape[1] * 8)
        out = np.ones(len(keys), bool)
        for p in places:
            out &= self.bits[chunk, p >> 3] >> (p & 7).astype(np.uint8) & 1 == 1
        return out


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    chunk = (mix(keys) % np.uint64(CHUNKS)).astype(np.int64)
    return chunk, [(mix(keys ^ salt) & np.uint64(bits - 1)).astype(np.int64) for salt in _SALTS]


def build(keys: DataFrame, column: str, count: int) -> Bloom:
    """The filter of a bigint column with about ``count`` keys. Every chunk is filled by one task; MOST_BITS / 8 bytes at most reach the driver."""
    bits = max(1 << 10, min(MOST_BITS, 1 << max(1, 12 * count).bit_length()) // CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            chunk, places = _places(values, bits)
            for c in np.unique(chunk).tolist():
                field = own.setdefault(c, np.zeros(bits // 8, np.uint8))
                at = chunk == c
                for p in places:
                    np.bitwise_or.at(field, p[at] >> 3, np.uint8(1) << (p[at] & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int32()), pa.array([f.tobytes() for f in own.values()], pa.binary())], ["chunk", "bits"])

    dealt = keys.select(F.col(column).alias("key"))
    by_chunk = mapped(dealt, _with_chunk, "key bigint, chunk int").repartition(CHUNKS, "chunk").select("key")
    rows = mapped(by_chunk, run, "chunk int, bits binary").collect()
    out = np.zeros((CHUNKS, bits // 8), np.uint8)
    for r in rows:
        out[r["chunk"]] |= np.frombuffer(r["bits"], np.uint8)
    return Bloom(out)


def _with_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy().view(np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((mix(values) % np.uint64(CHUNKS)).astype(np.int32))], ["key", "chunk"])

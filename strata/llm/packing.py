"""Packing of documents into sequences: first-fit decreasing with a tournament tree, in randomised groups."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mapped, text_blocks
from strata.llm.tokens import default_tokenizer, encode

#: Bytes of text that a task tokenises at a time; its arrays take some 50 bytes for each.
BLOCK_BYTES = 512 << 10
SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class Tournament:
    """First bin with room: a complete binary tree whose inner nodes hold the larger capacity of their two children."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.width = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.width)
        self.left = [capacity] * self.width

    def first_fit(self, size: int) -> int:
        """Put an item of ``size`` into the first bin that holds it and return the bin's number; there has to be one."""
        room, node = self.room, 1
        while node < self.width:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        leaf = node - self.width
        while node > 1:
            node //= 2
            top = max(room[2 * node], room[2 * node + 1])
            if room[node] == top:
                break
            room[node] = top
        return leaf


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of every item; items are taken by falling size, equal ones in their given order."""
    bins = np.zeros(len(sizes), np.int64)
    if len(sizes):
        tree = Tournament(len(sizes), capacity)
        for i in np.argsort(-sizes, kind="stable").tolist():
            bins[i] = tree.first_fit(int(sizes[i]))
    return bins


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def _tokenise(path: str, end_id: int, capacity: int):
    """Rows (doc_id, part, ids): full sequences carry their checksum only, the rest of a document its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets, _ in text_blocks(batches, "text", BLOCK_BYTES):
            ids, bounds = encode(path, data, offsets)
            out = ([], [], [], [], [], [], [])
            names = rows.column("doc_id").to_pylist()
            groups = rows.column("group").to_pylist()
            for i, (name, group) in enumerate(zip(names, groups, strict=True)):
                own = np.append(ids[bounds[i]:bounds[i + 1]], np.uint32(end_id)).astype("<u4")
                whole = len(own) // capacity * capacity
                for start in range(0, whole, capacity):
                    for column, value in zip(out, (group, name, start, capacity, _crc(own[start:start + capacity]), len(own), None),
                                             strict=True):
                        column.append(value)
                if whole < len(own):
                    for column, value in zip(out, (group, name, whole, len(own) - whole, None, len(own), own[whole:].tobytes()), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                             ["group", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return run


def _binary_parts(size: int) -> list[int]:
    return [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]


Piece = tuple[int, int, int]  # row, start within the row, length


def fill_gaps(bins: list[list[Piece]], capacity: int, padding: int) -> list[list[Piece]]:
    """Fill bins that first-fit decreasing left with more than ``padding`` free places, by cutting.

    The emptiest bins are poured into the gaps of the fullest ones, piece by piece, until one bin with a gap is left.
    """
    fill = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda i: (-fill[i], i))
    done = [bins[i] for i in order if capacity - fill[i] <= padding]
    gaps = [(bins[i], capacity - fill[i]) for i in order if capacity - fill[i] > padding]
    low, high = 0, len(gaps) - 1
    if gaps:
        into, room = list(gaps[0][0]), gaps[0][1]
        while high > low:
            for row, start, length in gaps[high][0]:
                while length:
                    if not room:
                        done.append(into)
                        low += 1
                        into, room = (list(gaps[low][0]), gaps[low][1]) if low < high else ([], capacity)
                    take = min(room, length)
                    into.append((row, start, take))
                    start, length, room = start + take, length - take, room - take
            high -= 1
            if low > high:
                break
        done.append(into)
    return done


def _pack_group(rows: pa.Table, capacity: int, padding: int) -> dict[str, list]:
    """Pack one group. Rows: full pieces (without ids) get sequences of their own; the others go first-fit decreasing.

    Bins are padded by at most ``padding`` places; larger gaps are filled (:func:`fill_gaps`). The one bin
    that stays short is cut where its length, written in binary, has a digit: lengths that are powers of two need no padding.
    """
    out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
    group = rows.column("group")[0].as_py()
    base, used = group << 32, 0

    def put(*values) -> None:
        for column, value in zip(out.values(), values, strict=True):
            column.append(value)

    names, starts, sizes, sums, totals, ids = (rows.column(k).to_pylist() for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"))
    open_rows = []
    for i, content in enumerate(ids):
        if content is None:
            put(names[i], starts[i], sizes[i], sums[i], totals[i], base + used, 0)
            used += 1
        else:
            open_rows.append(i)
    placed = first_fit_decreasing(np.array([sizes[i] for i in open_rows], np.int64), capacity)
    bins: list[list[Piece]] = [[] for _ in range(int(placed.max()) + 1 if len(placed) else 0)]
    for i, b in zip(open_rows, placed.tolist(), strict=True):
        bins[b].append((i, 0, sizes[i]))
    for pieces in fill_gaps(bins, capacity, padding):
        fill = sum(p[2] for p in pieces)
        cuts = [fill] if capacity - fill <= padding else _binary_parts(fill)
        part, offset = 0, 0
        for i, start, length in pieces:
            own, done = np.frombuffer(ids[i], "<u4")[start:start + length], 0
            while done < length:
                take = min(length - done, cuts[part] - offset)
                put(names[i], starts[i] + start + done, take, _crc(own[done:done + take]), totals[i], base + used + part, offset)
                done, offset = done + take, offset + take
                if offset == cuts[part]:
                    part, offset = part + 1, 0
        used += len(cuts)
    return out


def pack(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 0, group_documents: int = 4096,
         padding: int = 8) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` token ids.

    A document is the ids of its whole text and then ``end_id``. Pieces of ``capacity`` ids are cut off as
    sequences of their own where the document is tokenised; what remains goes, with the remainders of about
    ``group_documents`` other documents drawn by a hash of the row's number, through first-fit decreasing. Groups are
    independent, so the work is one shuffle of the remainders and no task holds more than a few groups at a time.

    Returns one row per piece: doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens,
    sequence_id, offset. A null or empty text is the end id alone; rows that repeat (also the doc_id) are
    packed once each; a null doc_id stays null; an empty table gives no rows; other columns are ignored.
    """
    path = tokenizer or default_tokenizer()
    total = docs.count()
    groups = max(1, -(-total // group_documents))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("group"))
    parts = mapped(rows, _tokenise(path, end_id, capacity),
                   "group bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def one(table: pa.Table) -> pa.Table:
        found = _pack_group(table, capacity, padding)
        return pa.table({k: pa.array(found[k], pa.int64()) for k in names})

    return parts.groupBy("group").applyInArrow(one, SCHEMA)

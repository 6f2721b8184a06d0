"""Alignment of two tokenizers over a corpus: which tokens of one end where tokens of the other end, and how often.

A text's tokens are laid side by side by the bytes they stand for. Both tokenizers treat the parts of a text that begin with a single space between
visible characters apart from each other (no piece of the second file holds a space behind another character; that is checked), so each distinct part
is encoded and aligned once per process, and a document is the sequence of its parts.

The first pass writes every task's distinct id pairs with their counts. The distinct pairs get a minimal perfect hash (``perfect``), shard by
shard; the tasks' counts become dense vectors indexed by it, which are added up a tree of FAN branches a level. The second pass aligns the
documents again and looks the counts up; keys kept beside the hash verify every answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import perfect, tokens
from strata.llm.common import flat, mapped, staged, text_blocks
from strata.llm.words import mix, powers

#: Tasks (or vectors) whose counts are added at a time.
FAN = 16
#: Pairs that are broadcast at a time, with key and count (17 bytes each); beyond, the documents are passed once for each slice of so many.
MOST_PAIRS = 4_000_000
#: Distinct parts that a process keeps (some 300 bytes each).
MOST_PARTS = 600_000
#: Distinct pairs that a task of the first pass gathers before it hands them on.
MOST_GATHERED = 2_000_000
_BASE = np.uint64(0xA0761D6478BD642F)
_SPACE_MARK = "▁"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _table(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(e) for e in entries], np.int64)
    return np.frombuffer(b"".join(entries), np.uint8), np.cumsum(lengths) - lengths, lengths


@lru_cache(maxsize=2)
def byte_level(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths) of a byte-level vocabulary: printable bytes stand for themselves, the others for 256, 257, ... in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    vocabulary = tokens.load(path).get_vocab()
    entries = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        entries[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    return _table(entries)


@lru_cache(maxsize=2)
def piece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def piece_level(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    model, entries = piece_model(path), []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if _SPACE_MARK in piece.lstrip(_SPACE_MARK):
            raise ValueError("a piece holds a space behind another character; parts of a text would not be independent")
        entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(_SPACE_MARK, " ").encode())
    return _table(entries)


def _written(n: int, behind: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The decimal ids 0 to n - 1, each with the first and with the second of the characters ``behind`` it."""
    return _table([b"%d%c" % (i, c) for i in range(n) for c in behind])


def text_parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the parts of texts that each begin with a space, and the parts before each text."""
    begin = np.zeros(len(data) + 1, bool)
    begin[tokens._splits(data)] = True
    begin[offsets] = True
    starts = np.flatnonzero(begin[:-1])
    return starts, np.searchsorted(starts, offsets)


class Aligned:
    """The parts that this process has aligned, for one pair of files: both passes and all their tasks share them."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a_path, self.b_path = a_path, b_path
        self.a, self.b = byte_level(a_path), piece_level(b_path)
        self.written = _written(len(self.a[1]), b",|"), _written(len(self.b[1]), b",;")
        self.clear()

    def clear(self) -> None:
        self.strange = False  # most parts of the last block were new
        self.row: dict[bytes, int] = {}
        self.numbers = np.zeros((0, 4), np.int64)  # equal (0 or 1), A tokens, B tokens, groups
        self.pairs, self.first_pair = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # each group's link
        self.shown, self.shown_at = np.zeros(0, np.uint8), np.zeros((0, 2), np.int64)  # groups as text, each with a ; behind it

    def rows(self, parts: list[bytes]) -> np.ndarray:
        """Row of each part; new ones are aligned."""
        self._trim()
        new = [p for p in dict.fromkeys(parts) if p not in self.row]
        self.strange = 2 * len(new) > len(parts)
        if new:
            self._add(new)
        return np.fromiter(map(self.row.__getitem__, parts), np.int64, len(parts))

    def _trim(self) -> None:
        """Keep the MOST_PARTS that came first, which hold the frequent ones; if the texts have changed since, start anew."""
        if len(self.row) > MOST_PARTS and self.strange:
            self.clear()
        for _ in range(len(self.row) - MOST_PARTS):
            self.row.popitem()
        n = len(self.row)
        if n < len(self.numbers):
            self.pairs, self.shown = self.pairs[:self.first_pair[n]].copy(), self.shown[:self.shown_at[n, 0]].copy()
            self.numbers, self.first_pair, self.shown_at = self.numbers[:n].copy(), self.first_pair[:n].copy(), self.shown_at[:n].copy()

    def _encoded(self, new: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A ids of parts, and their numbers. Parts that begin and end as those inside a text do are encoded in one go."""
        tokenizer = tokens.load(self.a_path)
        inner = np.fromiter((0x20 < p[-1] and 0x20 < p[1] for p in new), bool, len(new))
        together, rest = np.flatnonzero(inner), np.flatnonzero(~inner)
        ids = np.array(tokenizer.encode_batch_fast([b"".join(new[k] for k in together.tolist()).decode()], add_special_tokens=False)[0].ids, np.int64)
        alone = [e.ids for e in tokenizer.encode_batch_fast([new[k].decode() for k in rest.tolist()], add_special_tokens=False)]
        n = np.zeros(len(new), np.int64)
        n[together] = np.diff(np.searchsorted(np.cumsum(self.a[2][ids]), np.concatenate(([0], np.cumsum(sizes[together]))), "right"))
        n[rest] = np.fromiter(map(len, alone), np.int64, len(alone))
        out, begin = np.zeros(int(n.sum()), np.int64), np.cumsum(n) - n
        out[flat(begin[together], n[together])] = ids
        out[flat(begin[rest], n[rest])] = np.fromiter(chain.from_iterable(alone), np.int64, int(n[rest].sum()))
        return out, n

    def _add(self, new: list[bytes]) -> None:
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        a, n_a = self._encoded(new, sizes)
        of_b = piece_model(self.b_path).encode([p[1:].decode() for p in new], num_threads=1)
        n_b = np.fromiter(map(len, of_b), np.int64, len(new))
        b = np.fromiter(chain.from_iterable(of_b), np.int64, int(n_b.sum()))
        whole = np.frombuffer(b"".join(new), np.uint8)
        equal = self._equal(a, n_a, sizes, whole, self.a) & self._equal(b, n_b, sizes, whole, self.b)
        part_a, part_b = np.repeat(np.arange(len(new)), n_a), np.repeat(np.arange(len(new)), n_b)
        keep_a, keep_b = equal[part_a], equal[part_b]
        a, part_a, b, part_b = a[keep_a], part_a[keep_a], b[keep_b], part_b[keep_b]
        end_a, end_b = np.cumsum(self.a[2][a]), np.cumsum(self.b[2][b])  # over the parts that are equal, which both cover alike
        at_a = np.flatnonzero(np.isin(end_a, end_b, assume_unique=True, kind="table"))
        at_b = np.searchsorted(end_b, end_a[at_a])
        n_groups = np.bincount(part_a[at_a], minlength=len(new))
        self._show(a, b, at_a, at_b, np.bincount(part_a, minlength=len(new)) + np.bincount(part_b, minlength=len(new)))
        self.first_pair = np.concatenate([self.first_pair, np.cumsum(n_groups) - n_groups + len(self.pairs)])
        self.pairs = np.concatenate([self.pairs, (a[at_a].astype(np.uint64) << np.uint64(32)) | b[at_b].astype(np.uint64)])
        self.row |= {p: len(self.numbers) + k for k, p in enumerate(new)}
        self.numbers = np.concatenate([self.numbers, np.column_stack([equal, n_a, n_b, n_groups])])

    def _show(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, tokens_of: np.ndarray) -> None:
        """Write the groups a1,a2|b1;a3|b2,b3; of parts: every token with what stands behind it, those of B after those of A of its group."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[at_a] = last_b[at_b] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        place_a = np.arange(len(a)) + np.concatenate(([0], at_b + 1))[group_a]
        place_b = np.arange(len(b)) + np.append(at_a + 1, 0)[group_b]
        (data_a, start_a, size_a), (data_b, start_b, size_b) = self.written
        start, size = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.int64)
        start[place_a], size[place_a] = start_a[2 * a + last_a], size_a[2 * a + last_a]
        start[place_b], size[place_b] = start_b[2 * b + last_b] + len(data_a), size_b[2 * b + last_b]
        fresh = np.concatenate([data_a, data_b])[flat(start, size)]
        reach = np.concatenate(([0], np.cumsum(size)))
        until = np.cumsum(tokens_of)
        begin, end = reach[until - tokens_of], reach[until]
        self.shown_at = np.concatenate([self.shown_at, np.column_stack([begin + len(self.shown), end - begin])])
        self.shown = np.concatenate([self.shown, fresh])

    def looked_up(self, rows: np.ndarray, counts: perfect.Table, best: np.ndarray) -> np.ndarray:
        """Of each part: links that are the best of their B id, and the sum of its links' counts."""
        row, which = np.unique(rows, return_inverse=True)
        many = self.numbers[row, 3]
        pairs = self.pairs[flat(self.first_pair[row], many)]
        found, owner = counts.find(pairs), np.repeat(np.arange(len(row)), many)
        is_best = (found > 0) & (found == best[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)])
        sums = np.zeros(len(row), np.int64)
        np.add.at(sums, owner, found)
        return np.column_stack([np.bincount(owner, is_best, len(row)).astype(np.int64), sums])[which]

    def digests(self, parts: np.ndarray, bounds: np.ndarray) -> list[str]:
        """SHA-256 of the groups of texts, text i made of the parts parts[bounds[i]:bounds[i + 1]]."""
        sizes = self.shown_at[parts, 1]
        data = memoryview(self.shown[flat(self.shown_at[parts, 0], sizes)])
        reach = np.concatenate(([0], np.cumsum(sizes)))[bounds].tolist()
        return [hashlib.sha256(data[i:j - 1]).hexdigest() for i, j in zip(reach, reach[1:], strict=False)]

    @staticmethod
    def _equal(ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, whole: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Are the joined bytes of each part's ids the part itself?"""
        data, starts, lengths = table
        owner = np.repeat(np.arange(len(n)), n)
        same = np.bincount(owner, lengths[ids], len(n)).astype(np.int64) == sizes
        kept = ids[same[owner]]
        joined, own = data[flat(starts[kept], lengths[kept])], np.repeat(same, sizes)
        of = np.repeat(np.arange(len(n)), sizes)[own]
        same[of[joined != whole[own]]] = False
        return same

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, which of them have tokens, and for those: row of each part, bounds of each text's parts, sums of ``numbers``."""
        for batch, data, offsets, nulls in text_blocks(batches, "text"):
            full = np.flatnonzero((np.diff(offsets) > 0) & ~nulls)
            sizes = np.diff(offsets)[full]
            bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
            spaced = np.full(int(bounds[-1]), 0x20, np.uint8)
            spaced[flat(bounds[:-1] + 1, sizes)] = data[flat(offsets[full], sizes)]
            starts, cut = text_parts(spaced, bounds)
            rows = self._rows_of(spaced, starts) if len(starts) else np.zeros(0, np.int64)
            yield batch, full, rows, cut, per_text(self.numbers[rows], cut)

    def _rows_of(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        ends = np.append(starts[1:], len(data))
        lengths = ends - starts
        place = np.arange(len(data)) - np.repeat(starts, lengths)
        terms = mix(np.arange(1, 257, dtype=np.uint64))[data] * powers(_BASE, int(lengths.max()))[place]
        key = mix(np.add.reduceat(terms, starts) + lengths.astype(np.uint64))
        _, chosen, same = np.unique(key, return_index=True, return_inverse=True)
        stand_in = chosen[same]
        view = memoryview(data)
        if (lengths == lengths[stand_in]).all() and (data == data[flat(starts[stand_in], lengths)]).all():
            return self.rows([view[starts[i]:ends[i]].tobytes() for i in chosen.tolist()])[same]
        return self.rows([view[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)])  # two parts share a key


def per_text(numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the parts' numbers for each text."""
    reach = np.concatenate((np.zeros((1, numbers.shape[1]), np.int64), np.cumsum(numbers, axis=0)))
    return reach[bounds[1:]] - reach[bounds[:-1]]


_KNOWN: dict[tuple[str, str], Aligned] = {}


def known_parts(a: str, b: str) -> Aligned:
    if (a, b) not in _KNOWN:
        _KNOWN[a, b] = Aligned(a, b)
    return _KNOWN[a, b]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, which, np.concatenate(counts))
    return key, total


def _task_counts(docs: DataFrame, a: str, b: str) -> DataFrame:
    """task, hash, pair, n: the id pairs of every task, once each (or once for each MOST_GATHERED of them)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task = known_parts(a, b), TaskContext.get().partitionId()
        keys, counts, waiting = [], [], 0

        def handed_on() -> pa.RecordBatch:
            key, n = _summed(keys, counts)
            columns = [pa.array(np.full(len(key), task, np.int32)), pa.array(perfect.shard_hash(key)), pa.array(key.view(np.int64)), pa.array(n)]
            return pa.RecordBatch.from_arrays(columns, ["task", "hash", "pair", "n"])

        for _, _, rows, cut, numbers in known.blocks(batches):
            good = np.repeat(numbers[:, 0] == np.diff(cut), np.diff(cut))
            part, times = np.unique(rows[good], return_counts=True)
            many = known.numbers[part, 3]
            if not many.any():
                continue
            key, n = _summed([known.pairs[flat(known.first_pair[part], many)]], [np.repeat(times, many)])
            keys, counts, waiting = [*keys, key], [*counts, n], waiting + len(key)
            if waiting > MOST_GATHERED:
                key, n = _summed(keys, counts)
                keys, counts, waiting = [key], [n], len(key)
                if waiting > MOST_GATHERED // 2:
                    yield handed_on()
                    keys, counts, waiting = [], [], 0
        if keys:
            yield handed_on()

    return mapped(docs.select("text"), run, "task int, hash bigint, pair bigint, n bigint")


def _binary(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array([x.tobytes()], pa.binary()) for x in arrays]


def _long(column: pa.ChunkedArray | pa.Array, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(column[0].as_py(), kind)


def _functions(keys: DataFrame) -> DataFrame:
    """shard, seeds, keys: the minimal perfect hash of each shard, and its keys in the order of their slots."""
    def run(table: pa.Table) -> pa.Table:
        key = np.sort(table.column("pair").to_numpy().view(np.uint64))
        seeds, slot = perfect.build(key)
        by_slot = np.empty(len(key), np.uint64)
        by_slot[slot] = key
        return pa.table([table.column("shard")[:1], *_binary(seeds, by_slot)], names=["shard", "seeds", "keys"])

    return keys.groupBy("shard").applyInArrow(run, "shard bigint, seeds binary, keys binary")


def _leaf(counts: pa.Table, function: pa.Table) -> pa.Table:
    """A dense vector of the counts of up to FAN tasks, indexed by the hash."""
    seeds, keys = _long(function.column("seeds")), _long(function.column("keys"), np.uint64)
    one = perfect.Table(1, [(0, seeds, keys, np.zeros(len(keys), np.int64))])
    at = one.index(counts.column("pair").to_numpy().view(np.uint64))
    if (at < 0).any():
        raise ValueError("a pair is not among the keys of its hash")
    vector = np.zeros(len(keys), np.int64)
    np.add.at(vector, at, counts.column("n").to_numpy())
    return pa.table([function.column("of_shard"), function.column("of_branch"), *_binary(vector)], names=["shard", "branch", "counts"])


def _added(vectors: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_py(), np.int64) for v in vectors.column("counts"))
    return pa.table([vectors.column("shard")[:1], vectors.column("branch")[:1], *_binary(total)], names=["shard", "branch", "counts"])


def pair_table(docs: DataFrame, a: str, b: str) -> tuple[DataFrame, int, int]:
    """(shard, seeds, keys, counts; number of shards; number of pairs): the counts of all id pairs of the corpus, by minimal perfect hash."""
    partial = staged(_task_counts(docs, a, b))
    distinct = staged(partial.select("hash", "pair").distinct())
    size, tasks = distinct.count(), (partial.agg(F.max("task")).first()[0] or 0) + 1
    shards = max(1, -(-size // perfect.SHARD_KEYS))
    in_shard = (F.col("hash") % shards).alias("shard")
    functions = staged(_functions(distinct.select(in_shard, "pair")))
    branches = -(-tasks // FAN)
    leaves = partial.select(in_shard, (F.col("task") / FAN).cast("int").alias("branch"), "pair", "n")
    wanted = leaves.select("shard", "branch").distinct().join(functions, "shard").withColumnsRenamed({"shard": "of_shard", "branch": "of_branch"})
    vector = "shard bigint, branch int, counts binary"
    level = leaves.groupBy("shard", "branch").cogroup(wanted.groupBy("of_shard", "of_branch")).applyInArrow(_leaf, vector)
    while branches > 1:
        level = level.withColumn("branch", (F.col("branch") / FAN).cast("int")).groupBy("shard", "branch").applyInArrow(_added, vector)
        branches = -(-branches // FAN)
    return staged(functions.join(level.drop("branch"), "shard")), shards, size


def pair_counts(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """a_id, b_id, links: how many links of the corpus hold each pair of ids."""
    table, _, _ = pair_table(docs, a or tokens.default_tokenizer(), b or default_pieces())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, counts = _long(batch.column("keys")[i:i + 1], np.uint64), _long(batch.column("counts")[i:i + 1])
                ids = [pa.array((keys >> np.uint64(32)).astype(np.int32)), pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(counts)], ["a_id", "b_id", "links"])

    return mapped(table, run, "a_id int, b_id int, links bigint")


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _looked_up(rows: DataFrame, a: str, b: str, table: perfect.Table, best: np.ndarray, last: bool) -> DataFrame:
    """The second pass over one slice of the counts; what the slices before it found is added."""
    shared = rows.sparkSession.sparkContext.broadcast((table, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (counts, most) = known_parts(a, b), shared.value
        for batch, full, parts, cut, numbers in known.blocks(batches):
            whole = numbers[:, 0] == np.diff(cut)
            out = np.zeros((batch.num_rows, 6), np.int64)
            out[full[whole]] = np.column_stack([numbers[:, [1, 2, 3, 3]], per_text(known.looked_up(parts, counts, most), cut)])[whole]
            for k in (4, 5):
                out[:, k] += batch.column(_NUMBERS[k]).to_numpy()
            sha = [""] * batch.num_rows
            if last:
                kept = np.diff(cut) * whole
                found = known.digests(parts[np.repeat(whole, np.diff(cut))], np.concatenate(([0], np.cumsum(kept[whole]))))
                for i, digest in zip(full[whole].tolist(), found, strict=True):
                    sha[i] = digest
            text = pa.nulls(batch.num_rows, pa.string()) if last else batch.column("text").cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text, *[pa.array(c) for c in out.T], pa.array(sha)],
                                             ["doc_id", "text", *_NUMBERS, "groups_sha256"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return mapped(rows.select("doc_id", "text", *_NUMBERS), run, f"doc_id {kind}, text string, {', '.join(f'{n} bigint' for n in _NUMBERS)}, groups_sha256 string")


def align(docs: DataFrame, a: str | None = None, b: str | None = None, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a`` is the file of a byte-level BPE tokenizer, ``b`` that of a sentence-piece model that puts a space before a text; a text is encoded
    with that space by both. Byte offsets where tokens of both end cut the tokens into groups; the two tokens that end there are a link. n_best counts the
    links whose pair is, over all documents, the most frequent of its second id (ties included), count_sum adds up the counts of all links.

    Null and empty texts, and those that either tokenizer gives back with other bytes, have no tokens: zeros and an empty string, and no part in the
    counts. Rows that repeat count each; ids may be null or repeat. Columns other than doc_id and text are not read. An empty table gives an empty result.
    """
    a, b = a or tokens.default_tokenizer(), b or default_pieces()
    table, shards, size = pair_table(docs, a, b)

    def peaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                second = (_long(batch.column("keys")[i:i + 1], np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.int64)
                top = np.zeros(int(second.max()) + 1, np.int64)
                np.maximum.at(top, second, _long(batch.column("counts")[i:i + 1]))
                held = np.flatnonzero(top)
                yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(top[held])], ["id", "most"])

    best = np.zeros(len(piece_level(b)[1]), np.int64)  # as long as the vocabulary
    for r in mapped(table.select("keys", "counts"), peaks, "id int, most bigint").groupBy("id").agg(F.max("most").alias("most")).collect():
        best[r["id"]] = r["most"]

    slices = max(1, -(-size // most_pairs))
    rows = docs.select("doc_id", "text", *[F.lit(0).cast("bigint").alias(n) for n in _NUMBERS])
    for k in range(slices):
        parts = table.where((F.col("shard") >= shards * k // slices) & (F.col("shard") < shards * (k + 1) // slices)).collect()
        held = perfect.Table(shards, [(r["shard"], np.frombuffer(r["seeds"], np.int64), np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64))
                                      for r in parts])
        rows = _looked_up(rows, a, b, held, best, k == slices - 1)
        rows = rows if k == slices - 1 else staged(rows)
    return rows.select("doc_id", *_NUMBERS, "groups_sha256")

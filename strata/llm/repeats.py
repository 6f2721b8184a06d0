"""Exact removal of long repeated byte strings, by prefix-free parsing.

The corpus is parsed into phrases where a rolling hash triggers: where the hash of the next bytes is the least among RADIUS
neighbours on either side. A trigger depends on the bytes around it alone, so equal strings are parsed equally, whatever stands
before and after them. Every string of LENGTH bytes has an anchor: the first trigger in it that its own bytes decide. The string is then a
suffix of the phrases before the anchor and a prefix of the text after it, and two strings are equal when their
suffixes and their prefixes are. That is how suffix arrays of the dictionary (phrase suffixes) and of the
parse (what follows an anchor) combine to the order of the corpus, here to a depth of LENGTH bytes, which is all the question needs. LENGTH and what depends on it are one :class:`Depth`.

Anchored strings are handled in blocks of neighbouring starts. All strings of a block hold its core, so blocks whose core occurs
once hold no repeated string; that rules out most of a corpus by one count. Blocks that are equal as a whole
(copies) hold repeated strings only. For the rest the suffix arrays are built among the blocks with the same core. Strings without an
anchor (trigger-free stretches: short periods) are counted as they are, each a block of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import bloom
from strata.llm.common import discard, flat, mapped, staged, text_blocks
from strata.llm.words import mix

LENGTH = 400
GRAM = 8


@dataclass(frozen=True)
class Depth:
    """Length of the strings that are looked for, and how texts are parsed for them."""

    length: int

    def __post_init__(self) -> None:
        if not 64 <= self.length <= 600:  # shorter: hardly a trigger inside; longer: distances leave the 8 bits they have in a shape
            raise ValueError("strings of 64 to 600 bytes")

    @property
    def radius(self) -> int:
        return self.length * 3 // 25

    @property
    def near(self) -> int:
        """Least distance from a string's start to its anchor that its own bytes decide."""
        return self.radius

    @property
    def far(self) -> int:
        return self.length - self.radius - GRAM

    @property
    def blocks(self) -> tuple[tuple[int, int], tuple[int, int]]:
        """Distances of the blocks [a, b)."""
        middle = (self.near + self.far) // 2 + 2
        return (self.near, middle), (middle, self.far + 1)


#: The depth of op10.
WHOLE = Depth(LENGTH)
#: Members with one core that a task compares at a time; above, their strings are counted one by one.
CROWD = 20_000
ALONE = 2  # block number of strings without anchor


def triggers(data: np.ndarray, radius: int) -> np.ndarray:
    """Sorted places whose hash is less than those of the ``radius`` places before and at most those of the ``radius`` places behind."""
    if len(data) < 2 * radius + GRAM + 1:
        return np.zeros(0, np.int64)
    grams = np.lib.stride_tricks.as_strided(data, (len(data) - GRAM + 1, GRAM), (1, 1))
    words = np.ascontiguousarray(grams).view(np.uint64).ravel()
    g = (mix(words) >> np.uint64(32)).astype(np.uint32)
    least, width = g, 1
    while 2 * width <= radius:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:len(g) - radius + 1], least[radius - width:radius - width + len(g) - radius + 1])
    middle = g[radius:len(g) - radius]
    n = len(middle)
    return np.flatnonzero((middle < least[:n]) & (middle <= least[radius + 1:radius + 1 + n])) + radius


def parse(data: np.ndarray, offsets: np.ndarray, depth: Depth) -> dict[str, np.ndarray]:
    """Blocks of the strings of several texts: doc, block, anchor (or the string's start), d0, d1 (least and largest distance)."""
    radius, length, far = depth.radius, depth.length, depth.far
    at = triggers(data, radius)
    doc = np.searchsorted(offsets, at, "right") - 1
    inside = (at - radius >= offsets[doc]) & (at + radius + GRAM <= offsets[doc + 1])
    at, doc = at[inside], doc[inside]
    begin, end = offsets[doc], offsets[doc + 1]
    same = np.concatenate(([False], doc[1:] == doc[:-1])) if len(doc) else np.zeros(0, bool)
    before = np.concatenate(([0], at[:-1])) if len(at) else at
    first = np.where(same, before - radius + 1, begin)  # first start whose anchor this may be
    low = np.maximum(depth.near, at - (end - length))
    high = np.minimum(far, at - first)
    found = {k: [] for k in ("doc", "block", "at", "d0", "d1")}
    for j, (a, b) in enumerate(depth.blocks):
        d0, d1 = np.maximum(low, a), np.minimum(high, b - 1)
        ok = d0 <= d1
        for k, v in zip(found, (doc[ok], np.full(int(ok.sum()), j), at[ok], d0[ok], d1[ok]), strict=True):
            found[k].append(v)
    # starts without anchor: too far ahead of the next trigger, or behind the last one
    last = np.searchsorted(at, offsets[1:], "left") - 1
    n = len(offsets) - 1
    has = (last >= 0) & (np.where(last >= 0, doc[last] if len(doc) else 0, -1) == np.arange(n))
    tail = np.where(has, (at[last] if len(at) else 0) - radius + 1, offsets[:-1])
    starts = np.concatenate([first, np.maximum(tail, offsets[:-1])])
    stops = np.concatenate([np.minimum(at - far, end - length + 1), offsets[1:] - length + 1])
    owner = np.concatenate([doc, np.arange(n)])
    runs = np.maximum(0, stops - starts)
    alone = flat(starts, runs)
    for k, v in zip(found, (np.repeat(owner, runs), np.full(len(alone), ALONE), alone, np.zeros(len(alone), np.int64), np.zeros(len(alone), np.int64)),
                    strict=True):
        found[k].append(v)
    return {k: np.concatenate(v).astype(np.int64) for k, v in found.items()}


def _bounds(p: dict[str, np.ndarray], depth: Depth) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Core and cover of blocks: [c0, c1), [v0, v1). The cover holds all strings of the block, the core is in all of them."""
    near = np.array([a for a, _ in depth.blocks] + [0])[p["block"]]
    far = np.array([b for _, b in depth.blocks] + [1])[p["block"]]
    return p["at"] - near, p["at"] + depth.length + 1 - far, p["at"] - p["d1"], p["at"] + depth.length - p["d0"]


def _keyed(data: np.ndarray, offsets: np.ndarray, depth: Depth) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Blocks, the two halves of their cores' hashes, and the hashes of their covers (which tell d0 and d1, too)."""
    p = parse(data, offsets, depth)
    c0, c1, v0, v1 = (x.tolist() for x in _bounds(p, depth))
    view = memoryview(data)
    whole, part = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
    core = np.frombuffer(b"".join([whole(view[a:b]) for a, b in zip(c0, c1, strict=True)]), ">u8").astype(np.uint64).reshape(-1, 2)
    cover = np.fromiter((part(view[a:b]) for a, b in zip(v0, v1, strict=True)), np.uint64, len(v0))
    core = mix(core + (p["block"] + 1).astype(np.uint64)[:, None])
    return p, core, mix(cover ^ (p["d0"] * 1024 + p["d1"]).astype(np.uint64))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def count_cores(docs: DataFrame, depth: Depth) -> DataFrame:
    """core, mixed: the cores that occur more than once; mixed says that their covers differ."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets, _ in text_blocks(batches, "text"):
            _, core, cover = _keyed(data, offsets, depth)
            if len(core):
                yield pa.RecordBatch.from_arrays([_signed(core[:, 0]), _signed(cover)], ["core", "cover"])

    rows = mapped(_texts(docs).where(F.octet_length("text") >= depth.length), run, "core bigint, cover bigint")
    return rows.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("cover").alias("c1"), F.max("cover").alias("c2")).where("n > 1").select(
        "core", (F.col("c1") != F.col("c2")).alias("mixed"))


_OCCURRENCE = ("core bigint, core2 bigint, cover bigint, shape int, hi bigint, lo bigint, first bigint, left binary, right binary")


def occurrences(docs: DataFrame, same: bloom.Bloom, mixed: bloom.Bloom, depth: Depth) -> DataFrame:
    """Blocks whose core may occur more than once, with the text's name (hi, lo) and their first string's start.

    For cores with different covers the bytes around the core go along: left (before it) and right (after it).
    """
    shared = docs.sparkSession.sparkContext.broadcast((same, mixed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, parted = shared.value
        for _, data, offsets, _ in text_blocks(batches, "text"):
            p, core, cover = _keyed(data, offsets, depth)
            fringed = parted.may_hold(core[:, 0])
            keep = np.flatnonzero(fringed | whole.may_hold(core[:, 0]))
            if not len(keep):
                continue
            fringed = fringed[keep]
            p = {k: v[keep] for k, v in p.items()}
            c0, c1, v0, v1 = _bounds(p, depth)
            view = memoryview(data)
            left = [view[a:b].tobytes() if f else None for a, b, f in zip(v0.tolist(), c0.tolist(), fringed.tolist(), strict=True)]
            right = [view[a:b].tobytes() if f else None for a, b, f in zip(c1.tolist(), v1.tolist(), fringed.tolist(), strict=True)]
            names = {d: xxhash.xxh3_128_digest(view[offsets[d]:offsets[d + 1]]) for d in np.unique(p["doc"]).tolist()}
            name = np.frombuffer(b"".join([names[d] for d in p["doc"].tolist()]), ">i8").astype(np.int64).reshape(-1, 2)
            near = np.array([a for a, _ in depth.blocks] + [0])[p["block"]]
            shape = p["block"] << 16 | (p["d0"] - near) << 8 | (p["d1"] - near)
            yield pa.RecordBatch.from_arrays(
                [_signed(core[keep, 0]), _signed(core[keep, 1]), _signed(cover[keep]), pa.array(shape.astype(np.int32)), pa.array(name[:, 0]),
                 pa.array(name[:, 1]), pa.array(v0 - offsets[p["doc"]]), pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                ["core", "core2", "cover", "shape", "hi", "lo", "first", "left", "right"])

    return mapped(_texts(docs).where(F.octet_length("text") >= depth.length), run, _OCCURRENCE)


def suffix_ranks(group: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of strings within their groups, and for each place the length shared with the place before (-1: new group)."""
    order = np.array(sorted(range(len(strings)), key=lambda i: (group[i], strings[i])), np.int64)
    width = max(1, max((len(s) for s in strings), default=1))
    table = np.frombuffer(b"".join([strings[i].ljust(width, b"\0") for i in order]), np.uint8).reshape(-1, width)
    sizes = np.array([len(strings[i]) for i in order])
    differ = table[1:] != table[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    lcp = np.minimum(lcp, np.minimum(sizes[1:], sizes[:-1]))
    lcp[group[order][1:] != group[order][:-1]] = -1
    return order, np.concatenate(([-1], lcp))


def repeated_strings(group: np.ndarray, left: list[bytes], right: list[bytes], x0: np.ndarray, x1: np.ndarray, width: np.ndarray,
                     copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, x) of strings that occur more than once among members with one core.

    A member has strings x0..x1; string x is the last x bytes of ``left``, the core, and the first width - 1 - x bytes of
    ``right``. Sorted by their reversed left parts and by their right parts, members that share a suffix or a
    prefix of some length are neighbours; the two ranks at that length together name the string.
    """
    n = len(group)
    names = group.tolist()
    by_left, shared_left = suffix_ranks(np.asarray(names), [s[::-1] for s in left])
    by_right, shared_right = suffix_ranks(np.asarray(names), right)
    members, places = [], []
    rank_left, rank_right = np.empty(n, np.int64), np.empty(n, np.int64)
    for w in np.unique(width).tolist():
        for x in range(int(x0[width == w].min()), int(x1[width == w].max()) + 1):
            active = np.flatnonzero((width == w) & (x0 <= x) & (x <= x1))
            if not len(active):
                continue
            rank_left[by_left] = np.cumsum(shared_left < x)
            rank_right[by_right] = np.cumsum(shared_right < w - 1 - x)
            name = rank_left[active] * np.int64(n + 1) + rank_right[active]
            _, which = np.unique(name, return_inverse=True)
            often = np.bincount(which, copies[active])[which] > 1
            members.append(active[often])
            places.append(np.full(int(often.sum()), x))
    if not members:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(members), np.concatenate(places)


def _widths(shape: np.ndarray, depth: Depth) -> np.ndarray:
    return np.array([b - a for a, b in depth.blocks] + [1])[shape >> 16]


_FLAGGED = "core bigint, core2 bigint, cover bigint, shape int, xa int, xb int"


def _solve(members: DataFrame, depth: Depth) -> DataFrame:
    """Ranges xa..xb of repeated strings of members (core, core2, cover, shape, left, right, n), core by core."""
    names = ["core", "core2", "cover", "shape", "left", "right", "n"]

    def solved(table: pa.Table) -> pa.RecordBatch | None:
        core, core2, cover, shape, n = (table.column(c).to_numpy() for c in ("core", "core2", "cover", "shape", "n"))
        group = np.cumsum(np.concatenate(([0], (core[1:] != core[:-1]) | (core2[1:] != core2[:-1]))))
        x0, x1 = shape >> 8 & 255, shape & 255
        member, x = repeated_strings(group, table.column("left").to_pylist(), table.column("right").to_pylist(), x0, x1, _widths(shape, depth), n)
        if not len(member):
            return None
        order = np.lexsort((x, member))
        member, x = member[order], x[order]
        begin = np.concatenate(([True], (member[1:] != member[:-1]) | (x[1:] != x[:-1] + 1)))
        stop = np.concatenate((begin[1:], [True]))
        m = member[begin]
        return pa.RecordBatch.from_arrays([pa.array(core[m]), pa.array(core2[m]), pa.array(cover[m]), pa.array(shape[m].astype(np.int32)),
                                           pa.array(x[begin].astype(np.int32)), pa.array(x[stop].astype(np.int32))],
                                          ["core", "core2", "cover", "shape", "xa", "xb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            core, core2 = (held.column(c).to_numpy() for c in ("core", "core2"))
            edge = np.flatnonzero((core[1:] != core[:-1]) | (core2[1:] != core2[:-1]))
            if len(edge) and held.num_rows >= 2 * CROWD:
                cut = int(edge[-1]) + 1
                if (out := solved(held.slice(0, cut))) is not None:
                    yield out
                held = held.slice(cut)
        if held is not None and (out := solved(held)) is not None:
            yield out

    ordered = members.select(*names).repartition("core", "core2").sortWithinPartitions("core", "core2", "cover", "shape")
    return mapped(ordered, run, _FLAGGED)


def _count_strings(members: DataFrame, depth: Depth) -> DataFrame:
    """The same as :func:`_solve` for cores that crowds of members share: every string is a row, counted by its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shape = batch.column("shape").to_numpy()
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            width = _widths(shape, depth)
            row, xs, names = [], [], []
            for i in range(batch.num_rows):
                for x in range(int(shape[i]) >> 8 & 255, (int(shape[i]) & 255) + 1):
                    row.append(i)
                    xs.append(x)
                    names.append(xxhash.xxh3_128_digest(left[i][len(left[i]) - x:] + b"|" + right[i][:int(width[i]) - 1 - x]))
            taken = batch.select(["core", "core2", "cover", "shape", "n"]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(xs, pa.int32()), pa.array(names, pa.binary())],
                                             ["core", "core2", "cover", "shape", "n", "x", "name"])

    strings = mapped(members, run, "core bigint, core2 bigint, cover bigint, shape int, n bigint, x int, name binary")
    often = strings.groupBy("core", "core2", "x", "name").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    return strings.join(often, ["core", "core2", "x", "name"]).select("core", "core2", "cover", "shape", F.col("x").alias("xa"), F.col("x").alias("xb"))


def repeated_spans(docs: DataFrame, crowd: int = CROWD, depth: Depth = WHOLE) -> DataFrame:
    """hi, lo (name of a text), starts: ranges (first, last) of starts of repeated strings in it. A staged table."""
    cores = staged(count_cores(docs, depth))
    sizes = {r["mixed"]: r["count"] for r in cores.groupBy("mixed").count().collect()}
    filters = [bloom.build(cores.where(F.col("mixed") == m), "core", sizes.get(m, 0)) for m in (False, True)]
    found = staged(occurrences(docs, *filters, depth).join(cores, "core"))

    string_range = F.struct(F.col("first").alias("first"), F.col("last").alias("last"))
    whole = found.where("not mixed").select("hi", "lo", "first", (F.col("first") + F.col("shape").bitwiseAND(255) - F.shiftright("shape", 8).bitwiseAND(255)).alias("last"))

    key = ["core", "core2", "cover", "shape"]
    members = staged(found.where("mixed").groupBy(*key).agg(F.first("left").alias("left"), F.first("right").alias("right"), F.count(F.lit(1)).alias("n")))
    per_core = members.groupBy("core", "core2").agg(F.count(F.lit(1)).alias("covers"), F.sum("n").alias("times")).where("times > 1")
    sized = members.join(per_core, ["core", "core2"])
    flagged = _solve(sized.where(F.col("covers") <= crowd), depth).unionByName(_count_strings(sized.where(F.col("covers") > crowd), depth))
    partly = found.where("mixed").select(*key, "hi", "lo", "first").join(flagged, key).select(
        "hi", "lo", (F.col("first") + F.col("shape").bitwiseAND(255) - F.col("xb")).alias("first"),
        (F.col("first") + F.col("shape").bitwiseAND(255) - F.col("xa")).alias("last"))
    spans = staged(whole.unionByName(partly).groupBy("hi", "lo").agg(F.collect_set(string_range).alias("starts")))
    discard(cores, found, members)
    return spans


#: White space of any script; what stands between it are words.
_GAP = re.compile(rb"(?:[\t-\r\x1c-\x20]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80)+")


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text's UTF-8 form."""
    gaps = np.array([m.span() for m in _GAP.finditer(data)], np.int64).reshape(-1, 2)
    starts, ends = np.concatenate(([0], gaps[:, 1])), np.concatenate((gaps[:, 0], [len(data)]))
    some = starts < ends
    return starts[some], ends[some]


def _names(texts: list[memoryview] | list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(t) for t in texts]), ">i8").astype(np.int64).reshape(-1, 2)


def _run_texts(docs: DataFrame, depth: Depth, crowd: int) -> DataFrame:
    """hi, lo, text, n (its rows), first, last, longest: texts with repeated strings, each once, and the longest run that these cover. A staged table."""
    spans = repeated_spans(docs, crowd, depth)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longest = []
            for first, last in zip(batch.column("first"), batch.column("last"), strict=True):
                a, b = covered(np.asarray(first.values), np.asarray(last.values) + depth.length)
                longest.append(int((b - a).max()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(longest, pa.int64())], [*batch.schema.names, "longest"])

    runs = staged(mapped(spans.select("hi", "lo", "starts.first", "starts.last"), measure,
                         "hi bigint, lo bigint, first array<bigint>, last array<bigint>, longest bigint"))
    discard(spans)
    shared = docs.sparkSession.sparkContext.broadcast(bloom.build(runs, "hi", runs.count()))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets, _ in text_blocks(batches, "text"):
            view = memoryview(data)
            key = _names([view[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
            keep = pa.array(np.flatnonzero(shared.value.may_hold(key[:, 0].view(np.uint64))))
            yield pa.RecordBatch.from_arrays([pa.array(key[:, 0]).take(keep), pa.array(key[:, 1]).take(keep), block.column("text").take(keep)],
                                             ["hi", "lo", "text"])

    texts = mapped(_texts(docs).where(F.octet_length("text") >= depth.length), name, "hi bigint, lo bigint, text string")
    texts = staged(texts.groupBy("hi", "lo").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n")).join(runs, ["hi", "lo"]))
    discard(runs)
    return texts


def _passages(texts: DataFrame, words: int, depth: Depth) -> DataFrame:
    """hi, lo (name of a text), cuts: (first, stop) of its passages of ``words`` words that occur more than once.

    Such a passage has 2 * words - 1 bytes at least, so it lies within a run that repeated strings of this length (``depth``) cover. In
    these runs every passage of ``words`` words is counted as a whole. A staged table.
    """
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column("text")[i].as_py().encode()
                a, b = covered(np.asarray(batch.column("first")[i].values), np.asarray(batch.column("last")[i].values) + depth.length)
                starts, ends = word_bounds(data)
                lows, highs = np.searchsorted(starts, a), np.searchsorted(ends, b, "right")
                first = flat(lows, np.maximum(0, highs - lows - words + 1))
                view = memoryview(data)
                for at in range(0, len(first), CROWD):
                    x, y = starts[first[at:at + CROWD]], ends[first[at:at + CROWD] + words - 1]
                    found = _names([view[p:q] for p, q in zip(x.tolist(), y.tolist(), strict=True)])
                    row = pa.array(np.full(len(x), i))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in ("hi", "lo", "n")), pa.array(x), pa.array(y),
                                                      pa.array(found[:, 0]), pa.array(found[:, 1])],
                                                     ["hi", "lo", "n", "first", "stop", "w1", "w2"])

    every = staged(mapped(texts.select("hi", "lo", "text", "n", "first", "last"), windows,
                          "hi bigint, lo bigint, n bigint, first bigint, stop bigint, w1 bigint, w2 bigint"))
    often = every.groupBy("w1", "w2").agg(F.sum("n").alias("times")).where("times > 1").select("w1", "w2")
    cuts = staged(every.join(often, ["w1", "w2"]).groupBy("hi", "lo").agg(F.collect_set(F.struct("first", "stop")).alias("cuts")))
    discard(every)
    return cuts


def _repeated_within(docs: DataFrame, length: int, words: int, crowd: int) -> DataFrame:
    """hi, lo, cuts: repeated strings of ``length`` bytes and repeated passages of ``words`` words, from one parse of the whole corpus.

    A string of ``length`` bytes that repeats lies in a run that repeated strings of fewer bytes cover. So only texts with a run that
    long are parsed for it; of a text with several rows two take part, which is enough to make all its strings repeat.
    """
    depth = Depth(2 * words - 1)
    texts = _run_texts(docs, depth, crowd)
    passages = _passages(texts, words, depth)
    if depth.length <= length:
        twice = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(2)).cast("int")))
        parsed = texts.where(F.col("longest") >= length).select(twice.alias("copy"), "text").select(F.lit(None).alias("doc_id"), "text")
    else:
        parsed = docs
    spans = repeated_spans(parsed, crowd, Depth(length))
    cuts = staged(_string_cuts(spans, length).unionByName(passages).groupBy("hi", "lo").agg(F.flatten(F.collect_list("cuts")).alias("cuts")))
    discard(texts, passages, spans)
    return cuts


def _string_cuts(spans: DataFrame, length: int) -> DataFrame:
    cut = F.transform("starts", lambda x: F.struct(x["first"].alias("first"), (x["last"] + length).alias("stop")))
    return spans.select("hi", "lo", cut.alias("cuts"))


def covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [a, b) covered by intervals [start, end)."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[fresh], ends[np.concatenate((fresh[1:], [True]))]


def remove_repeats(docs: DataFrame, keep_text: bool = False, crowd: int = CROWD, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """Remove every byte that a repeated string of ``length`` bytes covers from every text of ``docs`` (doc_id, text).

    With ``words`` (33 to 300) also every repeated passage of that many words, however short they are; it is whole words and the
    white space between them, compared as bytes.

    Strings are compared as UTF-8 bytes, all of them and on the input, within a text and across texts; they never cross
    texts. What stays is a function of the text, so equal texts share one result. A null text is empty; an empty or shorter text is
    left alone; rows that repeat are texts each (so long ones go); a null doc_id stays null; an empty table gives no rows.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept (bytes that stay); with ``keep_text`` all columns of ``docs`` and
    the remaining bytes as text (bytes of a code point that was cut are left out) and n_removed, which takes the place of a column of that name.
    """
    if words is not None:
        spans = _repeated_within(docs, length, words, crowd)
    else:
        spans = _string_cuts(repeated_spans(docs, crowd, Depth(length)), length)
    names = bloom.build(spans, "hi", spans.count())
    shared = docs.sparkSession.sparkContext.broadcast(names)
    others = [c for c in docs.columns if c != "text"] if keep_text else ["doc_id"]
    rows = docs.select(F.struct(*[docs[c] for c in others]).alias("row"), F.coalesce(docs["text"], F.lit("")).alias("text"), docs["text"].isNull().alias("none"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets, _ in text_blocks(batches, "text"):
            view = memoryview(data)
            texts = [view[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            key = _names(texts)
            touched = shared.value.may_hold(key[:, 0].view(np.uint64))
            digest = [None if t else hashlib.sha256(x).hexdigest() for t, x in zip(touched, texts, strict=True)] if not keep_text else [None] * len(texts)
            text = block.column("text") if keep_text else pa.array([x.tobytes().decode() if t else None for t, x in zip(touched, texts, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([block.column("row"), text, block.column("none"), pa.array(key[:, 0]), pa.array(key[:, 1]),
                                              pa.array(np.diff(offsets)), pa.array(digest, pa.string())],
                                             ["row", "text", "none", "hi", "lo", "n_bytes", "sha"])

    row_type = rows.schema["row"].dataType.simpleString()
    named = mapped(rows, name, f"row {row_type}, text string, none boolean, hi bigint, lo bigint, n_bytes bigint, sha string")
    joined = named.join(spans, ["hi", "lo"], "left").select("row", "text", "none", "n_bytes", "sha", "cuts.first", "cuts.stop")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, digests = batch.column("text"), batch.column("sha").to_pylist()
            firsts, stops = batch.column("first"), batch.column("stop")
            removed, runs, kept = [], [], []
            for i in range(batch.num_rows):
                first, stop = firsts[i].values, stops[i].values
                text = texts[i].as_py() if first is not None or digests[i] is None else None
                if first is None or not len(first):
                    removed.append(0)
                    runs.append(0)
                    kept.append(text)
                    if digests[i] is None:
                        digests[i] = hashlib.sha256(text.encode()).hexdigest()
                    continue
                data = text.encode()
                a, b = covered(np.asarray(first), np.asarray(stop))
                pieces = [data[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True)]
                rest = b"".join(pieces)
                removed.append(int((b - a).sum()))
                runs.append(len(a))
                digests[i] = hashlib.sha256(rest).hexdigest()
                kept.append("".join([x.decode("utf-8", "ignore") for x in pieces]))
            columns = [batch.column("row"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string())]
            fields = ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                none = batch.column("none").to_pylist()
                columns.append(pa.array([None if n else k for n, k in zip(none, kept, strict=True)], pa.string()))
                fields.append("text")
            yield pa.RecordBatch.from_arrays(columns, fields)

    done = mapped(joined, cut, f"row {row_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", text string" if keep_text else ""))
    if keep_text:
        return done.select(*[F.col("row")[c].alias(c) if c != "text" else F.col("text") for c in docs.columns if c != "n_removed"], "n_removed")
    return done.select(F.col("row")["doc_id"].cast("bigint").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256",
                       (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"))

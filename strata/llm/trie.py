"""Prefix trie of conversations: every distinct beginning is a node, with what its subtree adds up to.

Conversations are cut by position, not gathered: turns are numbered and prefixes are named by running hashes (two of 64 bits, of turn and place) in chunks
of a range partitioning, so a conversation of any length is spread over tasks until it enters its shard. Equal conversations are folded to one with a
count. A prefix that more than ``most`` different conversations share is an upper node; what hangs below the upper nodes are prefix shards. A
task packs shards into a double array (``doublearray``) over dense turn ids, walks every conversation through it and sums up subtrees level by
level. What the shards find for their tops is then added to the upper nodes they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import mapped, staged
from strata.llm.doublearray import DoubleArray

#: Different conversations below one shard.
MOST = 2000
#: Rows of whole shards that are packed into one double array (a larger shard goes alone).
ROWS = 100_000
#: Characters of ids that are joined before they go to the task that hashes them.
JOINED = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, head, t1, t2 (hashes of role and text), words. Rows without conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), F.substring(text, 1, 32).alias("head"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit("second"), text, role).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))


def _carried(rows: DataFrame, totals: dict[str, str]) -> DataFrame:
    """``rows`` (conv_id, chunk, ...) with what the chunks before theirs add up to: totals = {new column: SQL aggregate of a chunk}."""
    chunks = rows.groupBy("conv_id", "chunk").agg(*[F.expr(sql).alias(name) for name, sql in totals.items()])
    before = W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)  # a row for each range partition
    outer = {name: F.coalesce((F.sum if sql.startswith("count") else F.bit_xor)(name).over(before), F.lit(0)) for name, sql in totals.items()}
    carry = chunks.select("conv_id", "chunk", *[c.alias(name) for name, c in outer.items()])
    return rows.join(carry, ["conv_id", "chunk"])


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, chunk, pos (from 1), t1, t2, words: turns in their order, null first; of one turn number by role, text (32 characters), hash."""
    order = ["turn", "role", "head", "t1", "t2"]
    dealt = turns_of(conversations).repartitionByRange("conv_id", *order).withColumn("chunk", F.spark_partition_id())
    placed = staged(dealt.withColumn("place", F.row_number().over(W.partitionBy("conv_id", "chunk").orderBy(*order)))
                    .select("conv_id", "chunk", "place", "t1", "t2", "words"))
    return _carried(placed, {"ahead": "count(1)"}).select("conv_id", "chunk", (F.col("place") + F.col("ahead")).alias("pos"), "t1", "t2", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, chunk, d, t1, t2, words; conv_id, len): the first h turns of conversation c - c % 20, then the own ones after the first h.

    h is the CRC-32 of the decimal conv_id modulo 4. Remainders of negative ids are SQL's (-7 % 20 is -7).
    """
    totals = staged(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")))
    lead = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("lead")
    convs = totals.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 20).alias("root_id"), lead)
    convs = convs.join(totals.select(F.col("conv_id").alias("root_id"), F.col("n").alias("root_n")), "root_id", "left")
    convs = convs.withColumn("take", F.least("lead", F.coalesce("root_n", F.lit(0))))
    own = turns.join(convs.select("conv_id", "lead", "take"), "conv_id").where("pos > lead").select(
        "conv_id", "chunk", (F.col("pos") - F.col("lead") + F.col("take")).alias("d"), "t1", "t2", "words")
    taken = turns.where("pos <= 3").select(F.col("conv_id").alias("root_id"), F.col("pos").alias("d"), "t1", "t2", "words")
    taken = convs.select("conv_id", "root_id", "take").join(taken, "root_id").where("d <= take")
    rows = taken.select("conv_id", F.lit(-1).alias("chunk"), "d", "t1", "t2", "words").unionByName(own)
    return rows, convs.select("conv_id", (F.col("take") + F.greatest(F.col("n") - F.col("lead"), F.lit(0))).alias("len"))


def named(rows: DataFrame) -> DataFrame:
    """Rows with p1, p2, the name of the sequence up to them, and q1, q2, that of the one before."""
    rows = staged(rows.withColumns({"x1": F.xxhash64("d", "t1", "t2"), "x2": F.xxhash64("t2", "d", "t1")}))
    so_far = W.partitionBy("conv_id", "chunk").orderBy("d").rowsBetween(W.unboundedPreceding, 0)
    running = rows.withColumns({"r1": F.bit_xor("x1").over(so_far), "r2": F.bit_xor("x2").over(so_far)})
    carried = _carried(running, {"c1": "bit_xor(x1)", "c2": "bit_xor(x2)"})
    p1, p2 = F.col("r1").bitwiseXOR(F.col("c1")), F.col("r2").bitwiseXOR(F.col("c2"))
    return carried.select("conv_id", "d", "t1", "t2", "words", p1.alias("p1"), p2.alias("p2"), p1.bitwiseXOR(F.col("x1")).alias("q1"),
                          p2.bitwiseXOR(F.col("x2")).alias("q2"))


def _runs(batch: pa.RecordBatch | pa.Table, *names: str) -> np.ndarray:
    """Where runs of equal values begin, and the number of rows."""
    change = np.zeros(max(0, batch.num_rows - 1), bool)
    for name in names:
        values = batch.column(name).to_numpy()
        change |= values[1:] != values[:-1]
    return np.concatenate(([0], np.flatnonzero(change) + 1, [batch.num_rows]))


def ends(members: DataFrame) -> DataFrame:
    """rep, ends_sha256 of members (conv_id, p1, p2): per sequence the digest of its ascending conv_ids, comma-joined; rep is the smallest.

    The ids of a sequence are joined where the sort has put them, so that the one task that hashes them in order reads few, long rows, one by one.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p1, p2, ids = (batch.column(c).to_numpy() for c in ("p1", "p2", "conv_id"))
            begin = _runs(batch, "p1", "p2")[:-1] if batch.num_rows else np.zeros(0, np.int64)
            shown = [",".join(map(str, part.tolist())) for part in np.split(ids, begin[1:])] if len(begin) else []
            yield pa.RecordBatch.from_arrays([pa.array(p1[begin]), pa.array(p2[begin]), pa.array(ids[begin]), pa.array(shown, pa.string())], ["p1", "p2", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rep, state = None, 0, None
        for batch in batches:
            reps, found = [], []
            for p1, p2, first, ids in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "first", "ids")), strict=True):
                if (p1, p2) == name:
                    state.update(b"," + ids.encode())
                    continue
                if name is not None:
                    reps.append(rep)
                    found.append(state.hexdigest())
                name, rep, state = (p1, p2), first, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(found, pa.string())], ["rep", "ends_sha256"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([rep], pa.int64()), pa.array([state.hexdigest()])], ["rep", "ends_sha256"])

    order = ["p1", "p2", "conv_id"]
    parts = mapped(members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order), joined, "p1 bigint, p2 bigint, first bigint, ids string")
    return mapped(parts.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first"), hashed, "rep bigint, ends_sha256 string")


def _dense(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ids of pairs of numbers, the most frequent pair 0."""
    _, one = np.unique(first, return_inverse=True)
    _, two, counts = np.unique(one * np.int64(len(first)) + np.unique(second, return_inverse=True)[1], return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    return rank[two]


_NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, end_rep bigint, "
         "q1 bigint, q2 bigint")


def pack(rows: pa.Table) -> pa.RecordBatch:
    """Nodes of whole shards. Rows (rep, copies, d, len, cut, words, k1, k2, q1, q2) are sorted by conversation and depth; k1, k2 name a turn or, at the cut, the shard."""
    rep, copies, d, length, cut, words = (rows.column(c).to_numpy() for c in ("rep", "copies", "d", "len", "cut", "words"))
    ids = _dense(rows.column("k1").to_numpy(), rows.column("k2").to_numpy())
    begin = _runs(rows, "rep")
    sizes = np.diff(begin)
    first = begin[:-1]
    trie, here = DoubleArray(), np.zeros(len(first), np.int64)
    by_length = np.argsort(-sizes, kind="stable")
    many = np.searchsorted(-sizes[by_length], -np.arange(int(sizes.max())), "left")  # conversations with more than 0, 1, ... rows below the cut
    for level, n in enumerate(many.tolist()):
        active = by_length[:n]
        here[active] = trie.extend(here[active], ids[first[active] + level])
    here[:] = 0
    node = np.empty(len(ids), np.int64)
    for level, n in enumerate(many.tolist()):
        active = by_length[:n]
        here[active] = trie.go(here[active], ids[first[active] + level])
        node[first[active] + level] = here[active]
    if (node < 0).any():
        raise ValueError("a conversation leaves the trie made of it")
    size = len(trie.check)
    n_convs, smallest, end = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.full(size, -1)
    np.add.at(n_convs, node, copies)
    np.minimum.at(smallest, node, rep)
    last_words, depth, example = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    last_words[node], depth[node], example[node] = words, d, np.arange(len(node))
    ended = np.flatnonzero(d == length)
    end[node[ended]] = ended
    states = np.concatenate(trie.levels[1:])
    children = np.bincount(trie.check[states], minlength=size)
    leaves, saved = (children == 0).astype(np.int64), (n_convs - 1) * last_words
    for level in trie.levels[:1:-1]:
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])
    top = trie.check[states] == 0
    return pa.RecordBatch.from_arrays([
        pa.array(smallest[states]), pa.array(depth[states]), pa.array(smallest[trie.check[states]], mask=top), pa.array(n_convs[states]), pa.array(children[states]),
        pa.array(leaves[states]), pa.array(saved[states]), pa.array(rep[np.maximum(end[states], 0)], mask=end[states] < 0),
        *[pa.array(rows.column(q).to_numpy()[example[states]], mask=~top) for q in ("q1", "q2")]],
        ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_rep", "q1", "q2"])


def _packed(lower: DataFrame) -> DataFrame:
    names = ["s1", "s2", "rep", "d", "copies", "len", "cut", "words", "k1", "k2", "q1", "q2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= ROWS:
                table = pa.Table.from_batches(held).combine_chunks()
                cut = int(_runs(table, "s1", "s2")[-2])
                if cut:
                    yield pack(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                waiting = table.num_rows - cut
        if waiting:
            yield pack(pa.Table.from_batches(held).combine_chunks())

    return mapped(lower.select(*names).repartition("s1", "s2").sortWithinPartitions("s1", "s2", "rep", "d"), run, _NODE)


def nodes(conversations: DataFrame, most: int = MOST) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rebuilt first (:func:`rebuilt`). Null roles and texts are empty ones. Rows without conv_id belong to no conversation and take no part; rows
    that repeat are turns each. Columns other than conv_id, turn, role and text are not read. An empty table has no node, not even a root. A single
    conversation has to fit into a task's memory (some 200 bytes a turn) where its shard is packed; groups of conversations need not.
    """
    rows, lengths = rebuilt(staged(numbered(conversations)))
    paths = staged(named(rows).join(lengths, "conv_id"))
    none = lengths.where("len = 0").select("conv_id", "len", F.lit(0).cast("bigint").alias("p1"), F.lit(0).cast("bigint").alias("p2"))
    members = staged(paths.where("d = len").select("conv_id", "len", "p1", "p2").unionByName(none))
    sequences = staged(members.groupBy("p1", "p2", "len").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("copies")).select("rep", "copies", "len"))

    each = paths.withColumnRenamed("conv_id", "rep").join(sequences.select("rep", "copies"), "rep")
    wide = each.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > most).select("p1", "p2", F.lit(True).alias("upper"))
    each = staged(each.join(wide, ["p1", "p2"], "left"))
    cuts = each.where("upper is null").groupBy("rep").agg(F.min(F.struct("d", "p1", "p2")).alias("top")).select(
        "rep", F.col("top.d").alias("cut"), F.col("top.p1").alias("s1"), F.col("top.p2").alias("s2"))
    at_cut = F.col("d") == F.col("cut")
    lower = each.where("upper is null").join(cuts, "rep").withColumns({
        "k1": F.when(at_cut, F.col("s1")).otherwise(F.col("t1")), "k2": F.when(at_cut, F.col("s2")).otherwise(F.col("t2"))})
    below = staged(_packed(lower))

    zero = [F.lit(0).cast("bigint").alias(c) for c in ("d", "words", "p1", "p2")]
    root = sequences.select("rep", "copies", "len", *zero, *[F.lit(None).cast("bigint").alias(c) for c in ("q1", "q2")])
    shared = staged(each.where("upper").select("rep", "copies", "len", "d", "words", "p1", "p2", "q1", "q2").unionByName(root))
    uppers = shared.groupBy("p1", "p2").agg(
        F.min("rep").alias("conv_id"), F.min("d").alias("depth"), F.sum("copies").alias("n_convs"), F.min(F.when(F.col("d") == F.col("len"), F.col("rep"))).alias("end_rep"),
        F.max("words").alias("words"), F.min("q1").alias("q1"), F.min("q2").alias("q2"))
    uppers = staged(uppers)
    tops = below.where("q1 is not null")
    gains = tops.select(F.col("conv_id").alias("rep"), "depth", "n_leaves", "saved_tokens").unionByName(
        uppers.select(F.col("conv_id").alias("rep"), "depth", F.lit(0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")))
    sums = gains.join(shared.select("rep", "d", "p1", "p2"), "rep").where("d <= depth").groupBy("p1", "p2").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    children = tops.select("q1", "q2").unionByName(uppers.where("depth > 0").select("q1", "q2")).groupBy("q1", "q2").agg(F.count(F.lit(1)).alias("n_children"))
    children = children.withColumnsRenamed({"q1": "p1", "q2": "p2"})
    parents = uppers.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("above"))

    n_children = F.coalesce("n_children", F.lit(0)).cast("bigint")
    above = uppers.join(sums, ["p1", "p2"]).join(children, ["p1", "p2"], "left").select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs", n_children.alias("n_children"),
        F.when(n_children == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("bigint").alias("n_leaves"), F.col("saved_tokens").cast("bigint").alias("saved_tokens"), "end_rep",
        "q1", "q2")
    found = below.unionByName(above).join(parents, ["q1", "q2"], "left")
    found = found.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    found = found.join(ends(members).withColumnRenamed("rep", "end_rep"), "end_rep", "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))

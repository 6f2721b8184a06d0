"""Approximate nearest neighbours by cosine: a forest of sorted hash strings with variable-length prefixes.

A tree gives every vector a string of LENGTH bits, the signs of its products with random directions. Sorted, the
vectors that share a prefix with a query stand together. A query descends to its place in every tree and looks at the vectors around
it, which share its longest prefixes; from the nearness found there follows how far it has to ascend: to the prefix
length, in so many trees, at which a vector as near as the worst kept one shares the query's prefix in at least one of them
with the wanted probability and the fewest candidates are expected. It then ascends in those trees together, to that length. Where no
prefix promises fewer candidates than the table has rows, that is the root of a single tree, and the answer is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import mapped, staged

LENGTH = 31
#: Products of a block of queries with the vectors of a cell that are held at a time.
PRODUCTS = 4 << 20
#: Cosines by products of unit vectors are this exact at least; what is within it of the k-th best is computed anew.
ROUGH = 1e-9


def directions(tree: int, size: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, tree]).standard_normal((size, LENGTH))


def strings(vectors: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Hash strings of one tree as numbers; the first bit of the string is the highest of LENGTH bits."""
    bits = vectors @ directions(tree, vectors.shape[1], seed) > 0
    return bits @ (1 << np.arange(LENGTH - 1, -1, -1, dtype=np.int64))


def ascent(cosine: float, trees: int, recall: float) -> tuple[int, int]:
    """(prefix length, number of trees) that meet a vector of this cosine with probability ``recall`` among the fewest candidates.

    A bit is shared with probability 1 - angle / pi, a prefix of n bits with its n-th power, and t trees hold 2^-n t of the
    rows under such prefixes if strings are even. Length 0 is the root of one tree: all rows.
    """
    one_bit = 1 - np.arccos(np.clip(cosine, -1.0, 1.0)) / np.pi
    lengths = np.arange(1, LENGTH + 1)
    shared = one_bit ** lengths
    with np.errstate(divide="ignore"):
        needed = np.maximum(1, np.ceil(np.log(1 - recall) / np.log1p(-np.minimum(shared, 1 - 1e-16)) - 1e-9))
    part = np.where(needed <= trees, needed * 2.0 ** -lengths, np.inf)
    best = int(np.argmin(part))
    return (int(lengths[best]), int(needed[best])) if part[best] < 1 else (0, 1)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v: the rows that take part. Out are null vectors and ids, null or non-finite components, and zero vectors."""
    value = F.col("embedding").cast("array<double>")
    good = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), value.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(good, F.lit(False)))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of vectors of one length as rows of an array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their largest component first so that squares stay in range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision, from vectors scaled by their largest component so that squares stay in range."""
    q = query / np.abs(query).max()
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return np.clip((v * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum(axis=1))), -1.0, 1.0)


class Forest:
    """An index over vectors: per tree, cells of neighbouring strings.

    A cell is (tree, first ``depth`` bits, salt); the salt splits a prefix that more than ``cell_rows`` vectors share (copies share
    all their bits) by a hash of the row. ``cells`` counts them and is as long as the index has cells, trees * rows / cell_rows about.
    Strings are cheaper to compute than to store beside their vectors: a search computes those of the trees it visits.

    ``vectors``: vec_id, embedding; other columns are ignored, rows that take no part are those :func:`usable` leaves out. A
    cosine needs vectors of one length: a table of several is refused with a ValueError.
    """

    def __init__(self, vectors: DataFrame, trees: int = 24, cell_rows: int = 8192, seed: int = 11) -> None:
        self.trees, self.seed, self.cell_rows = trees, seed, cell_rows
        self.vectors = staged(usable(vectors).withColumn("key", F.monotonically_increasing_id()))
        size = self.vectors.agg(F.max(F.size("v")).alias("size"), F.min(F.size("v")).alias("least"), F.count(F.lit(1)).alias("n")).first()
        if size["n"] and size["size"] != size["least"]:
            raise ValueError("vectors of different lengths")
        self.size, self.count = size["size"] or 0, size["n"]
        self.depth = min(LENGTH - 1, max(0, (-(-self.count // cell_rows) - 1).bit_length() if self.count else 0))
        sizes = self._coded(self.vectors.select("v"), range(trees)).groupBy("tree", "top").agg(F.count(F.lit(1)).alias("n"))
        self.cells = staged(sizes.select("tree", "top", F.ceil(F.col("n") / F.lit(cell_rows)).cast("int").alias("salts")))

    def _coded(self, rows: DataFrame, trees: range | list[int]) -> DataFrame:
        """tree, top, code of every row in the given trees, with its columns; without its vector where that is the only one."""
        seed, wanted = self.seed, [int(t) for t in trees]
        carried = [] if rows.columns == ["v"] else rows.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column("v"))
                    for tree in wanted:
                        columns = [pa.array(np.full(len(x), tree, np.int32)), pa.array(strings(x, tree, seed)), *[batch.column(c) for c in carried]]
                        yield pa.RecordBatch.from_arrays(columns, ["tree", "code", *carried])

        kinds = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carried)
        return mapped(rows, run, f"tree int, code bigint{kinds}").withColumn("top", F.shiftright("code", LENGTH - self.depth).cast("int"))

    def _visit(self, asked: DataFrame, k: int, window: int | None) -> DataFrame:
        """Bring queries (query_id, q, tree, code, length) to the cells whose strings may share ``length`` bits, and look there.

        A group is a cell and at most about ``cell_rows`` of its queries. Returns query_id, key, vec_id, score: the k nearest
        by group. With ``window`` only so many vectors before and after the query's place are looked at.
        """
        depth = self.depth
        open_bits = F.greatest(F.lit(0), F.lit(depth) - F.col("length"))
        low = F.call_function("shiftleft", F.call_function("shiftright", F.shiftright("code", LENGTH - depth), open_bits), open_bits)
        high = low + F.call_function("shiftleft", F.lit(1).cast("bigint"), open_bits) - 1
        goes = F.explode(F.sequence(low.cast("int"), high.cast("int"))).alias("top")
        met = asked.select("tree", goes).groupBy("tree", "top").agg(F.ceil(F.count(F.lit(1)) / F.lit(self.cell_rows)).cast("int").alias("parts"))
        met = staged(self.cells.join(met, ["tree", "top"]))
        visited = [r["tree"] for r in met.select("tree").distinct().collect()]  # at most all trees
        left = asked.select("*", goes).join(met, ["tree", "top"]).withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
        left = left.select("tree", "top", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "part", "query_id", "q", "code", "length")
        right = self._coded(self.vectors, visited).join(met, ["tree", "top"]).withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")).cast("int"))
        right = right.select("tree", "top", "salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "code", "key", "vec_id", "v")
        by = ["tree", "top", "salt", "part"]
        return left.groupBy(by).cogroup(right.groupBy(by)).applyInArrow(_looker(k, window), "query_id bigint, key bigint, vec_id bigint, score double")

    def search(self, queries: DataFrame, k: int = 5, recall: float = 0.97, around: int = 64) -> DataFrame:
        """The ``k`` nearest found for every query (vec_id, embedding), all rows with the query's own id left out.

        ``recall``: probability with which each true neighbour should be met, by the rule in the module's text. Fewer than
        k vectors looked at in the descent mean ascending to the root, so short tables give all candidates. Returns query_id,
        rank (from 1), vec_id, score, nearest first, ties to the smaller vec_id. Rows that repeat are candidates each; queries that
        share an id are one query at each of their places. An empty table of either gives no rows.
        """
        trees = self.trees
        asked = staged(usable(queries).select(F.col("vec_id").alias("query_id"), "v"))
        placed = self._coded(asked, range(trees)).drop("top").withColumnRenamed("v", "q")
        # A row may come from every tree: so many of the nearest hold k different ones. The limit acts before the shuffle, too.
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "key")

        def merged(found: DataFrame) -> DataFrame:
            near = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k * trees)
            best = F.sort_array(F.collect_set(F.struct((-F.col("score")).alias("minus"), "vec_id", "key")))
            return near.groupBy("query_id").agg(F.slice(best, 1, k).alias("best"))

        seen = merged(self._visit(placed.withColumn("length", F.lit(self.depth)), k, around))

        @F.pandas_udf("length int, trees int")
        def rule(worst: pd.Series) -> pd.DataFrame:
            found = [(0, 1) if c is None or np.isnan(c) else ascent(c, trees, recall) for c in worst]
            return pd.DataFrame(found, columns=["length", "trees"]).astype("int32")

        worst = F.when(F.size("best") >= k, -F.element_at("best", -1)["minus"])
        goal = staged(seen.select("query_id", rule(worst.cast("double")).alias("rule")).select("query_id", "rule.length", F.col("rule.trees").alias("wanted")))
        second = placed.join(goal, "query_id", "left").withColumn("length", F.coalesce("length", F.lit(0)))
        found = merged(self._visit(second.where(F.col("tree") < F.coalesce("wanted", F.lit(1))).drop("wanted"), k, None))
        return found.select("query_id", F.posexplode("best").alias("at", "hit")).select(
            "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))


def _looker(k: int, window: int | None):
    """The function that finds the k nearest of a group's queries among the vectors of its cell."""

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            codes, keys, ids = (right.column(c).to_numpy() for c in ("code", "key", "vec_id"))
            order = np.argsort(codes, kind="stable")
            codes, keys, ids, x = codes[order], keys[order], ids[order], matrix(right.column("v"))[order]
            scaled, q = unit(x), matrix(left.column("q"))
            asked, own, length = (left.column(c).to_numpy() for c in ("query_id", "code", "length"))
            asked_scaled = unit(q)

            def nearest(i: int, low: int, high: int, rough: np.ndarray) -> None:
                other = np.flatnonzero(ids[low:high] != asked[i])
                rough = rough[other]
                if len(other) > k:
                    other = other[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - ROUGH]
                at = low + other
                score = cosines(q[i], x[at])
                best = np.lexsort((keys[at], ids[at], -score))[:k]
                found.append((np.full(len(best), asked[i]), keys[at[best]], ids[at[best]], score[best]))

            if window is not None:
                place = np.searchsorted(codes, own)
                lows, highs = np.maximum(0, place - window), np.minimum(len(codes), place + window)
            else:
                free = LENGTH - length.astype(np.int64)
                base = own >> free << free
                lows, highs = np.searchsorted(codes, base), np.searchsorted(codes, base + (1 << free))
            whole = (lows == 0) & (highs == len(codes))
            for i in np.flatnonzero(~whole):
                nearest(i, lows[i], highs[i], scaled[lows[i]:highs[i]] @ asked_scaled[i])
            rest = np.flatnonzero(whole)
            step = max(1, PRODUCTS // len(codes))
            for start in range(0, len(rest), step):
                block = rest[start:start + step]
                for i, rough in zip(block, asked_scaled[block] @ scaled.T, strict=True):
                    nearest(i, 0, len(codes), rough)
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0)] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c.astype(t.to_pandas_dtype()), t) for n, c, t in zip(("query_id", "key", "vec_id", "score"), columns, kinds, strict=True)})

    return look

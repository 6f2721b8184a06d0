"""SimHash fingerprints and exact search by Hamming distance through permuted block tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import mapped, text_blocks
from strata.llm.words import shingles, words_by_text

BITS = 64
WIDTH = 3
#: Fingerprints at most this many bits apart are near.
RADIUS = 3


def fingerprints(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """64-bit fingerprints of several texts.

    The terms of a text are its runs of ``width`` words (all words if there are fewer). A term that occurs t times weighs
    1 + ln t; every bit of its hash votes with that weight, and a bit of the fingerprint is set where the votes for it are
    more than those against. A text without words has the fingerprint 0.
    """
    words, bounds = words_by_text(data, offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    for i in range(len(out)):
        terms, counts = np.unique(shingles(words[bounds[i]:bounds[i + 1]], width), return_counts=True)
        if not len(terms):
            continue
        weights = (1 + np.log(counts)).astype(np.float32)
        votes = np.zeros(BITS, np.float64)
        for at in range(0, len(terms), 1 << 16):  # bounds the memory of the bit matrix
            bits = np.unpackbits(terms[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            votes += weights[at:at + (1 << 16)] @ bits.astype(np.float32)
        out[i] = np.packbits(2 * votes > float(weights.sum(dtype=np.float64))).view(">u8")[0]
    return out


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 where all bits differ."""
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def block_plan(radius: int, rows: int) -> tuple[list[int], int]:
    """Sizes of the blocks and how many of them a table keys on.

    Two fingerprints within ``radius`` agree on all but ``radius`` blocks, so on one set of blocks - radius of them at
    least; there is a table per such set. More blocks make longer keys (fewer false candidates) and more tables; taken is
    the smallest number whose keys have as many bits as the number of rows, so that a key meets few rows by chance.
    """
    wanted = max(1, rows).bit_length()
    for blocks in range(radius + 1, radius + 6):
        if BITS * (blocks - radius) // blocks >= wanted:
            break
    return [BITS // blocks + (i < BITS % blocks) for i in range(blocks)], blocks - radius


def _keys(value: Column, sizes: list[int], keep: int) -> list[Column]:
    parts, at = [], BITS
    for size in sizes:
        at -= size
        parts.append(F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << size) - 1)) if size < BITS else value)
    out = []
    for chosen in combinations(range(len(sizes)), keep):
        key = F.lit(0).cast("bigint")
        for k in chosen:
            key = F.shiftleft(key, sizes[k]).bitwiseOR(parts[k])
        out.append(key)
    return out


def within_radius(queries: DataFrame, table: DataFrame, radius: int = RADIUS, rows: int | None = None) -> DataFrame:
    """All pairs (query, fingerprint, distance) of distinct fingerprints at most ``radius`` bits apart, equal ones too.

    ``queries`` and ``table`` have a column fingerprint (bigint). Both are made distinct first, so copies cost nothing. A pair is verified in
    the join and comes from the first table in which it meets, so no pair is made twice.
    """
    distinct = table.select("fingerprint").where("fingerprint is not null").distinct()
    sizes, keep = block_plan(radius, rows if rows is not None else distinct.count())

    def dealt(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("fingerprint").alias(name), F.posexplode(F.array(*_keys(F.col("fingerprint"), sizes, keep))).alias("no", "key"))

    left = dealt(queries.select("fingerprint").where("fingerprint is not null").distinct(), "query").withColumnsRenamed({"no": "no_q", "key": "key_q"})
    right = dealt(distinct, "fingerprint")
    pairs = zip(_keys(F.col("query"), sizes, keep), _keys(F.col("fingerprint"), sizes, keep), strict=True)
    first = F.array_position(F.array(*[(a == b) for a, b in pairs]), F.lit(True)) - 1
    meet = (F.col("no_q") == F.col("no")) & (F.col("key_q") == F.col("key")) & (distance(F.col("query"), F.col("fingerprint")) <= radius)
    return left.join(right, meet & (first == F.col("no"))).select("query", "fingerprint", distance(F.col("query"), F.col("fingerprint")).alias("distance"))


def with_near(docs: DataFrame, asked: Column, radius: int = RADIUS) -> DataFrame:
    """``docs`` (column own, a fingerprint) and n_near: for rows where ``asked`` holds, how many rows have a fingerprint within ``radius`` bits.

    The row itself and its copies count; n_near is null for rows not asked for (``asked`` false or null) or without fingerprint. Rows are folded to distinct
    fingerprints before they meet, so copies cost nothing. ``docs`` is read several times: stage it before.
    """
    sizes = docs.where("own is not null").groupBy("own").agg(F.count(F.lit(1)).alias("near_rows"))
    table = sizes.select(F.col("own").alias("fingerprint"), "near_rows")
    pairs = within_radius(docs.where(asked).select(F.col("own").alias("fingerprint")), table, radius, docs.count())
    near = pairs.join(table, "fingerprint").groupBy(F.col("query").alias("near_own")).agg(F.sum("near_rows").alias("near_rows"))
    row = docs.select(F.struct(*docs.columns).alias("row"), F.when(asked, F.col("own")).alias("near_own"))
    # Rows that are not asked for have no key and stay out of the join, whose keys would all be null.
    met = row.where("near_own is not null").join(near, "near_own").select("row", "near_rows")
    left = row.where("near_own is null").select("row", F.lit(None).cast("bigint").alias("near_rows"))
    return met.unionByName(left).select(*[F.col("row")[c].alias(c) for c in docs.columns], F.col("near_rows").alias("n_near"))


_PAIRED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
                        T.StructField("own", T.LongType()), T.StructField("edited", T.LongType()), T.StructField("next", T.LongType())])


def edited_neighbours(docs: DataFrame, bucket_rows: int = 8192, width: int = WIDTH) -> DataFrame:
    """Fingerprints of every text, of the next document's text, and of the text edited with the next one's beginning.

    Documents are ordered by falling doc_id (null ones last; equal ones by a hash of their texts); after the last comes the first. In the
    edited text the last floor(n / 3) code points are replaced by the first as many (or all) of the next text.

    Ids are cut into ranges of about ``bucket_rows`` documents; a range is one group of the only shuffle of the texts. The first
    document of a range is sent to the range before, too. Returns doc_id, n_chars, edited_sha256, own, edited,
    next (fingerprints). Null texts are empty; rows that repeat follow each other; an empty table gives no rows;
    other columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("id"), F.col("doc_id").isNull().alias("none"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    buckets = min(20_000, -(-rows.count() // bucket_rows))
    if not buckets:
        return docs.sparkSession.createDataFrame([], _PAIRED)
    cuts = sorted(set(rows.approxQuantile("id", [i / buckets for i in range(1, buckets)], 0.2 / buckets))) if buckets > 1 else []
    edges = np.array([int(c) for c in cuts], np.int64)

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series((len(edges) - np.searchsorted(edges, ids.to_numpy(), "right")).astype(np.int32))

    rows = rows.withColumns({"bucket": bucket("id"), "tie": F.xxhash64("text")})
    # One row per range, of which there are at most 20,000: the place of its first document.
    heads = sorted(tuple(r) for r in rows.groupBy("bucket").agg(F.max(F.struct("id", "tie")).alias("head")).select("bucket", "head.id", "head.tie").collect())
    sent = [(heads[k - 1][0], heads[k][1], heads[k][2]) for k in range(len(heads))]  # the first goes to the last
    spark = docs.sparkSession
    target = spark.createDataFrame(sent, "to int, id bigint, tie bigint")
    border = rows.join(F.broadcast(target), ["id", "tie"]).dropDuplicates(["to"]).select("id", "none", "text", F.col("to").alias("bucket"), "tie", F.lit(1).alias("border"))
    both = rows.withColumn("border", F.lit(0)).unionByName(border)
    ordered = both.repartition("bucket").sortWithinPartitions("bucket", "border", F.desc("id"), F.desc("tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last document seen, whose next one is still to come

        def pair(item: tuple, following: tuple) -> tuple:
            text = item[2].decode()
            cut = len(text) // 3
            edited = text[:len(text) - cut] + following[2].decode()[:cut]
            return item, len(text), edited.encode(), following[3]

        def flush(done: list[tuple]) -> pa.RecordBatch:
            edited = [d[2] for d in done]
            marks = fingerprints(np.frombuffer(b"".join(edited), np.uint8), np.concatenate(([0], np.cumsum([len(e) for e in edited]))), width)
            columns = [[None if d[0][1] else d[0][0] for d in done], [d[1] for d in done], [hashlib.sha256(e).hexdigest() for e in edited],
                       [d[0][3] for d in done], marks.view(np.int64), [d[3] for d in done]]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _PAIRED.fieldNames())

        for block, data, offsets, _ in text_blocks(batches, "text"):
            own = fingerprints(data, offsets, width).view(np.int64)
            ids, none, group, edge = (block.column(c).to_pylist() for c in ("id", "none", "bucket", "border"))
            done = []
            for i in range(block.num_rows):
                item = (ids[i], none[i], data[offsets[i]:offsets[i + 1]].tobytes(), int(own[i]), group[i])
                if held is not None and held[4] == item[4]:
                    done.append(pair(held, item))
                held = None if edge[i] else item
            if done:
                yield flush(done)

    return mapped(ordered.select("id", "none", "text", "bucket", "border"), run, _PAIRED)


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))

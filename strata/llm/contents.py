"""Exact duplicates by a content sort, in DataFrame operations only.

Texts are normalised (white space deleted) and dealt to range partitions by splitters that Spark samples from their first characters and
hashes; inside a partition an external sort on the whole normalised text puts equals side by side, and a window over the run of equals
compares each text with its neighbour as a whole. Inside a run the row with the longest original text, then the smallest id, stands first.

A content that holds more rows than a quarter of a mean partition is cut into pieces, told apart by a hash of the row's id, so that
no task gets a large group of copies. The splitters see the piece's number, so pieces of one content are neighbours that may lie in several partitions.
The first rows of the pieces are then compared as whole texts again; there are fewer such contents than four times the partitions, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import staged

#: What does not count when texts are compared: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
#: Characters of a content that Spark's splitters see; the rest of the order comes from its hash.
SPLITTER_CHARS = 24
#: Contents with more than 1/PARTS of a mean partition's rows are cut into pieces of that size.
PARTS = 4


def normalised(text: Column) -> Column:
    """``text`` without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for character in WHITE:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def exact_copies(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (id of the row that stays), group_size, kept, text_sha256 (of the normalised text).

    Only ``doc_id`` and ``text`` are read; other columns, whatever their names, don't matter. Null texts are empty texts, and equal to
    texts of white space. Of equal texts the one with the most characters stays, then the smallest id; rows without id come last, and of rows
    that tie in both exactly one stays. An empty table gives an empty result. Texts of any length are compared whole.
    """
    parts = PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = normalised(F.col("text"))
    rows = docs.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars"), body.alias("body"))
    rows = rows.withColumn("mark", F.xxhash64("body"))

    each = max(1, docs.count() // parts)  # rows of a piece
    counts = rows.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > each)  # of these there are fewer than 2 * parts
    large = counts.select("mark", F.ceil(F.col("n") / each).cast("int").alias("pieces"))
    spread = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("doc_id"))
    piece = F.when(F.col("pieces").isNotNull(), F.pmod(spread, F.col("pieces"))).otherwise(F.lit(-1)).cast("int")
    dealt = rows.join(F.broadcast(large), "mark", "left").select(
        "doc_id", "n_chars", "body", "mark", piece.alias("piece"), F.substring("body", 1, SPLITTER_CHARS).alias("head"))
    ranged = dealt.repartitionByRange("head", "mark", "piece")

    run = W.partitionBy("head", "mark", "piece", "body")  # neighbours with equal texts; the range partitions hold them already
    order = run.orderBy(F.desc("n_chars"), F.asc_nulls_last("doc_id"))
    split, first = F.col("piece") >= 0, F.col("place") == 1
    runs = ranged.withColumns({"place": F.row_number().over(order), "run_size": F.count(F.lit(1)).over(run), "first_id": F.first("doc_id").over(order)})
    found = staged(runs.select(
        "doc_id", "n_chars", "place", "run_size", "first_id", "piece", F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"),
        F.when(split & first, F.col("body")).alias("split_body")))

    rank = F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("nameless"), "doc_id", "piece")
    whole = found.where(F.col("split_body").isNotNull()).groupBy("split_body", "text_sha256").agg(
        F.min(rank).alias("best"), F.sum("run_size").alias("size"))
    whole = whole.select(F.col("text_sha256"), F.lit(True).alias("parted"), F.col("best.doc_id").alias("best_id"), F.col("best.piece").alias("best_piece"), "size")
    joined = found.drop("split_body").join(F.broadcast(whole), "text_sha256", "left")  # fewer rows than contents that were cut
    parted = F.col("parted").isNotNull()
    return joined.select(
        "doc_id", F.when(parted, F.col("best_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.when(parted, F.col("size")).otherwise(F.col("run_size")).cast("bigint").alias("group_size"),
        (first & (~parted | (F.col("piece") == F.col("best_piece")))).alias("kept"), "text_sha256")

"""Overlap and containment of date intervals without comparing pairs.

Both operators fold rows to one per (key, date) before any ordering, so a window partition holds at most
as many rows as there are dates, whatever the size of the key's group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import stage


def with_previous(rows: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """``name``: the ``value`` of the row before in the ``order`` of all rows (NULL for the first), without a task that sees them all.

    Rows are dealt to range partitions; a window looks back inside each, and the last value of every partition is carried on to the next one that has
    rows: one row a partition. ``order`` must be total, or rows that tie may take each other's place.
    """
    placed = stage(rows.repartitionByRange(*order).withColumn("__chunk", F.spark_partition_id()))
    inside = Window.partitionBy("__chunk").orderBy(*order)
    last = placed.groupBy("__chunk").agg(F.max_by(value, F.struct(*order)).alias("__last"))
    carried = last.select("__chunk", F.lag("__last").over(Window.partitionBy(F.lit(0)).orderBy("__chunk")).alias("__carried"))
    looked = placed.withColumns({"__place": F.row_number().over(inside), name: F.lag(value).over(inside)}).join(F.broadcast(carried), "__chunk")
    return looked.withColumn(name, F.when(F.col("__place") == 1, F.col("__carried")).otherwise(F.col(name))).select(*rows.columns, name)


def _yes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def contained(points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str,
              end: str, weight: str | None = None) -> DataFrame:
    """Per (keys, date) of ``points``: row count, whether the key has any interval at all (``known``),
    and whether some interval of the key holds the date (``inside``). Bounds belong to the interval.
    ``weight`` names a count column when ``points`` holds folded rows."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    seen = points.groupBy(*keys, F.col(at).alias("day")).agg(n.alias("n"))
    starts = intervals.groupBy(*keys, F.col(start).alias("day")).agg(F.max(end).alias("reach"))
    line = seen.withColumn("reach", F.lit(None).cast("date")).unionByName(
        starts.withColumn("n", F.lit(None).cast("bigint")).withColumn("reach", F.col("reach").cast("date"))
    )
    line = line.withColumn("is_start", F.col("n").isNull())
    # Starts come before points of the same day; an interval that starts earlier and reaches the day holds it.
    group = Window.partitionBy(*keys)
    so_far = group.orderBy("day", F.col("is_start").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return (
        line.withColumn("furthest", F.max("reach").over(so_far))
        .withColumn("known", F.max("is_start").over(
            group.orderBy("day", F.col("is_start").desc())
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .where(~F.col("is_start"))
        .select(*keys, "day", "n", "known", F.coalesce(F.col("furthest") >= F.col("day"), F.lit(False)).alias("inside"))
    )


def overlapping(intervals: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Per distinct (keys, start, end): row count ``n`` and ``overlaps``, true when another row of the same
    key satisfies ``start <= other end and other start <= end``. Inverted intervals follow the same rule.

    For an interval [s, e] the rule asks for another row that starts by e and ends at s or later:
    * a proper interval (s <= e) is met by a row that starts before s and reaches s, by a second proper row
      starting at s, by a proper row starting after s but by e, or by an inverted row with s <= end, start <= e;
    * an inverted interval is met by any row that starts by e and reaches s.
    """
    shapes = stage(
        intervals.select(*keys, F.col(start).alias("s"), F.col(end).alias("e"))
        .where("s is not null and e is not null")
        .groupBy(*keys, "s", "e").agg(F.count(F.lit(1)).alias("n"))
    )
    proper = F.col("s") <= F.col("e")
    starts = shapes.groupBy(*keys, F.col("s").alias("day")).agg(
        F.coalesce(F.sum(F.when(proper, F.col("n"))), F.lit(0)).alias("proper_rows"),
        F.max("e").alias("reach"),
        F.max(F.when(~proper, F.col("e"))).alias("inverted_reach"),
    )
    ends = shapes.select(*keys, F.col("e").alias("day")).distinct()
    line = starts.withColumn("is_start", F.lit(True)).unionByName(
        ends.withColumn("is_start", F.lit(False)), allowMissingColumns=True
    )
    order = Window.partitionBy(*keys).orderBy("day", F.col("is_start").desc())
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    swept = line.select(
        *keys, "day", "is_start", "proper_rows",
        F.max("reach").over(so_far).alias("reach_by"),
        F.max("inverted_reach").over(so_far).alias("inverted_reach_by"),
        F.max("reach").over(before).alias("reach_before"),
        F.min(F.when(F.col("proper_rows") > 0, F.col("day"))).over(after).alias("next_proper_start"),
    )
    at_start = swept.where("is_start").select(
        *keys, F.col("day").alias("s"), "proper_rows", "reach_before", "next_proper_start")
    at_end = swept.where("not is_start").select(
        *keys, F.col("day").alias("e"), "reach_by", "inverted_reach_by")
    s, e = F.col("s"), F.col("e")
    hit = F.when(
        proper,
        _yes(F.col("reach_before") >= s) | _yes(F.col("proper_rows") > 1)
        | _yes(F.col("next_proper_start") <= e) | _yes(F.col("inverted_reach_by") >= s),
    ).otherwise(_yes(F.col("reach_by") >= s))
    return (
        shapes.join(at_start, [*keys, "s"]).join(at_end, [*keys, "e"])
        .select(*keys, "s", "e", "n", hit.alias("overlaps"))
    )


def overlap_counts(intervals: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """One row: keys with several intervals, keys with an overlap, rows in overlaps."""
    sizes = intervals.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    hits = overlapping(intervals, keys, start, end).where("overlaps").groupBy(*keys).agg(F.sum("n").alias("hit"))
    hits = hits.select(*[F.col(k).alias(f"__{k}") for k in keys], "hit")
    condition = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return sizes.join(hits, condition, "left").agg(
        F.count_if(F.col("rows") > 1).alias("repeated_groups"),
        F.count_if(F.col("hit") > 0).alias("overlapping_groups"),
        F.coalesce(F.sum("hit"), F.lit(0)).alias("rows_in_overlaps"),
    )

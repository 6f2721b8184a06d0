"""Exact quantiles and ranks over any number of distinct values."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import stage


class ValueCounts:
    """Staged distinct values with their counts, cut into buckets of neighbouring values.

    There are as many buckets as a bucket has values, the square root of the distinct values, so both grow slowly; ``buckets``
    sets another number. The cut points are plain numbers taken once to the driver, so recomputing a lost task always
    assigns a value to the same bucket. They only steer the work; results are exact for every number of buckets.
    """

    def __init__(self, df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None,
                 buckets: int | None = None) -> None:
        self.by = list(by)
        counted = (
            df.select(*self.by, F.col(value).alias("value"), (F.col(weight) if weight else F.lit(1)).alias("w"))
            .where("value is not null")
            .groupBy(*self.by, "value").agg(F.sum("w").alias("n"))
        )
        self.frame = stage(counted)
        position = F.col("value").cast("double")
        size = self.frame.agg(
            F.count(F.lit(1)).alias("distinct_values"), F.sum("n").alias("rows"),
        ).first()
        self.distinct_values, self.rows = size.distinct_values, size.rows or 0
        buckets = buckets or math.isqrt(self.distinct_values) + 1
        shares = [i / buckets for i in range(1, buckets)] or [0.5]
        cuts = self.frame.agg(F.percentile_approx(position, shares, 10 * buckets)).first()[0] or []
        splits = [float("-inf"), *(sorted({c for c in cuts if math.isfinite(c)}) or [0.0]), float("inf")]
        self.frame = (
            Bucketizer(splits=splits, inputCol="__pos", outputCol="bucket", handleInvalid="keep")  # NaN: behind all
            .transform(self.frame.withColumn("__pos", position)).drop("__pos")
        )

    def offsets(self) -> DataFrame:
        """Rows in each bucket, in the buckets before it, and in the whole group."""
        group = Window.partitionBy(*self.by) if self.by else Window.partitionBy(F.lit(0))
        earlier = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        return (
            self.frame.groupBy(*self.by, "bucket").agg(F.sum("n").alias("in_bucket"))
            .withColumn("before", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)))
            .withColumn("total", F.sum("in_bucket").over(group))
        )

    def _running(self, frame: DataFrame, inside: Sequence[str]) -> DataFrame:
        """Rows with a smaller value in the same partition of the window."""
        window = Window.partitionBy(*inside) if inside else Window.partitionBy(F.lit(0))
        earlier = window.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        return frame.withColumn("smaller", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    def _join(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Join by group and bucket; the group of NULL is a group like any other."""
        keys = [*self.by, "bucket"]
        other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        return left.join(other, same).drop(*[f"__{k}" for k in keys])

    def ranked(self) -> DataFrame:
        """Each distinct value with its count and the average rank of its rows (ties share the mean)."""
        keys = [*self.by, "bucket"]
        frame = self._join(self._running(self.frame, keys), self.offsets().select(*keys, "before"))
        frame = frame.withColumn("smaller", F.col("smaller") + F.col("before")).drop("before", "bucket")
        return frame.withColumn("rank", F.col("smaller") + (F.col("n") + 1) / 2).drop("smaller")

    def quantiles(self, shares: Sequence[float]) -> DataFrame:
        """``quantiles``: array of linearly interpolated quantiles per group."""
        targets = F.array(*[self._target(i, share) for i, share in enumerate(shares)])
        wanted = (
            self.offsets().withColumn("target", F.explode(F.flatten(targets)))
            .where("target.position >= before and target.position < before + in_bucket")
        )
        keys = [*self.by, "bucket"]
        near = self._running(self._join(self.frame, wanted.select(*keys).distinct()), keys)
        hits = self._join(near, wanted).where(
            "before + smaller <= target.position and target.position < before + smaller + n"
        )
        pairs = hits.groupBy(*self.by, "target.which").agg(
            F.max(F.when(F.col("target.low"), F.col("value").cast("double"))).alias("low"),
            F.max(F.when(~F.col("target.low"), F.col("value").cast("double"))).alias("high"),
            F.max("target.fraction").alias("fraction"),
        )
        value = F.col("low") * (1 - F.col("fraction")) + F.col("high") * F.col("fraction")
        return pairs.groupBy(*self.by).agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("which", value.alias("v")))), lambda s: s["v"]
            ).alias("quantiles")  # one entry per requested share
        )

    @staticmethod
    def _target(which: int, share: float) -> Column:
        spot = (F.col("total") - 1) * F.lit(float(share))
        low, high = F.floor(spot), F.ceil(spot)
        return F.array(*[
            F.struct(F.lit(which).alias("which"), F.lit(is_low).alias("low"), end.alias("position"),
                     (spot - low).alias("fraction"))
            for is_low, end in ((True, low), (False, high))
        ])


def exact_quantiles(df: DataFrame, value: str, shares: Sequence[float], names: Sequence[str],
                    by: Sequence[str] = (), digits: int | None = 4, weight: str | None = None,
                    **sizes: int) -> DataFrame:
    """One column per share and group, rounded like the audits print it. Without groups always one row.

    ``weight`` names a count column when ``df`` holds folded rows.
    """
    table = ValueCounts(df, value, by, weight, **sizes).quantiles(shares)
    columns = []
    for i, name in enumerate(names):
        column = F.get(F.col("quantiles"), F.lit(i))
        columns.append((F.round(column, digits) if digits is not None else column).alias(name))
    if not by:  # an empty input still gives one row of NULLs
        table = table.agg(F.max("quantiles").alias("quantiles"))
    return table.select(*by, *columns)


def quantile_edges(df: DataFrame, value: str, parts: int = 10, weight: str | None = None, **sizes: int) -> list[float]:
    """The distinct edges of ``parts`` equally filled bins: at most parts + 1 numbers."""
    row = ValueCounts(df, value, weight=weight, **sizes).quantiles([i / parts for i in range(parts + 1)]).first()
    return sorted(set(row[0])) if row and row[0] else []


def bin_by_edges(value: Column, edges: Sequence[float]) -> Column:
    """Number of the right-closed bin of a value; the lowest edge belongs to the first bin."""
    inner = [F.when(value.cast("double") > F.lit(e), 1).otherwise(0) for e in edges[1:-1]]
    number = sum(inner, F.lit(0))
    return F.when(value.isNotNull() & F.lit(len(edges) > 1), number)

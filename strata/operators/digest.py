"""Order-free digests of a table's rows, taken in the pass that writes or reads them.

A digest is the number of rows and two sums of 64-bit row hashes. Rows that are lost, added, doubled or changed change it; their order and
partitioning don't. Digests add up: that of two batches together is the sum of theirs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Digest:
    rows: int
    first: Decimal
    second: Decimal

    @staticmethod
    def of(metrics: dict) -> Digest:
        return Digest(metrics["rows"], metrics["first"] or Decimal(0), metrics["second"] or Decimal(0))


def metrics(columns: Sequence[str]) -> list[Column]:
    """Aggregates ``rows``, ``first`` and ``second``. NULL differs from every value, wherever it stands."""
    values = [F.array(*[F.col(f"`{c}`").isNull() for c in columns]), *[F.col(f"`{c}`") for c in columns]]

    def total(*salted: Column) -> Column:
        return F.coalesce(F.sum(F.xxhash64(*salted).cast("decimal(20,0)")), F.lit(Decimal(0))).cast("decimal(38,0)")

    return [F.count(F.lit(1)).alias("rows"), total(*values).alias("first"), total(F.lit("second"), *values).alias("second")]


def observed(df: DataFrame, columns: Sequence[str] | None = None, *more: Column) -> tuple[DataFrame, Observation]:
    """``df`` whose digest (and other aggregates) the observation has once an action has gone over all its rows."""
    watch = Observation()
    return df.observe(watch, *metrics(columns or df.columns), *more), watch


def digest(df: DataFrame, columns: Sequence[str] | None = None) -> Digest:
    return Digest.of(df.agg(*metrics(columns or df.columns)).first().asDict())


def same(found: Sequence[str], wanted: Digest) -> Column:
    """Aggregate: 0 if the rows have the digest, else 1."""
    rows, first, second = metrics(found)
    equal = (rows == wanted.rows) & (first == F.lit(wanted.first)) & (second == F.lit(wanted.second))
    return F.when(equal, 0).otherwise(1)

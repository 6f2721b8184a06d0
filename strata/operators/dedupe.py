"""Duplicate groups: size flags, survivors, counts of rows in groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.lookup import attach_group


def flag_duplicates(rows: DataFrame, keys: Sequence[str], name: str, nulls_match: bool = True,
                    row_id: Sequence[str] = ()) -> DataFrame:
    """Boolean column: does another row share the keys? NULL keys equal each other unless told otherwise."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    flag = F.col("__n") > 1
    if not nulls_match:
        for key in keys:
            flag = flag & F.col(key).isNotNull()
    return attach_group(rows, groups, keys, "__n", row_id).withColumn(name, F.coalesce(flag, F.lit(False))).drop("__n")


def pick_survivor(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], row_id: str,
                  duplicate: str, survivor: str) -> DataFrame:
    """Flag rows of groups larger than one, and the one row per group that comes first in ``order``.

    ``order`` must end with a unique column so that the choice is total.
    """
    first = F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(row_id).alias("id")))
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), first.getField("id").alias("__first"))
    return (
        attach_group(rows, groups, keys, "__n", [row_id])
        .withColumn(duplicate, F.col("__n") > 1)
        .withColumn(survivor, F.col(row_id) == F.col("__first"))
        .drop("__n", "__first")
    )


def duplicate_counts(rows: DataFrame, keys: Sequence[str], prefix: str = "") -> DataFrame:
    """One row: groups, groups with more than one row, rows in those, surplus copies."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    many = F.col("n") > 1
    return sizes.agg(
        F.count(F.lit(1)).alias(f"{prefix}groups"),
        F.count_if(many).alias(f"{prefix}duplicate_groups"),
        F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias(f"{prefix}rows_in_duplicate_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(f"{prefix}surplus_rows"),
    )

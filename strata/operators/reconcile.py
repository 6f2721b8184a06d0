"""Header amounts against the sums of their details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def detail_sums(details: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Sum and presence of detail rows per header key, aggregated before any join."""
    return details.groupBy(F.col(key).alias("__key")).agg(F.sum(amount).alias(name)).withColumn(
        f"has_{name}", F.lit(True))


def attach_sums(headers: DataFrame, key: str, *sums: DataFrame) -> DataFrame:
    """Headers with their detail sums; NULL sum and false presence where there is no detail.

    Headers and sums have one row per key, so no partition of these joins can be hot.
    """
    for table in sums:
        flag = next(c for c in table.columns if c.startswith("has_"))
        headers = (
            headers.join(table, F.col(key) == F.col("__key"), "left").drop("__key")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
        )
    return headers

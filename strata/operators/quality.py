"""Checks and gates: every rule becomes a counted row, a gate raises when one fails."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A measured number and the number it must equal.

    ``measure`` is an aggregate over ``frame``; checks on the same frame share one pass.
    """

    section: str
    label: str
    frame: DataFrame
    measure: Column
    expected: int | Column


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, list(frames))


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """One row per check: section, label, got, expected, ok."""
    frames: dict[int, tuple[DataFrame, list[Check]]] = {}
    for check in checks:
        frames.setdefault(id(check.frame), (check.frame, []))[1].append(check)
    parts = []
    for frame, group in frames.values():
        entries = [
            F.struct(
                F.lit(c.section).alias("section"), F.lit(c.label).alias("label"),
                F.coalesce(c.measure.cast("bigint"), F.lit(0)).alias("got"),
                (c.expected if isinstance(c.expected, Column) else F.lit(c.expected)).cast("bigint").alias("expected"),
            )
            for c in group
        ]
        parts.append(frame.agg(F.array(*entries).alias("e")).select(F.inline("e")))
    return union_all(parts).withColumn("ok", F.col("got").eqNullSafe(F.col("expected")))


class GateError(RuntimeError):
    """A layer did not pass its checks."""


def gate(results: DataFrame, title: str) -> int:
    """Raise when a check failed; otherwise the number of checks. Check tables are short by construction."""
    rows = results.orderBy("section", "label").collect()
    failed = [f"{r.section}: {r.label}: got {r.got}, expected {r.expected}" for r in rows if not r.ok]
    if failed:
        raise GateError(f"{title}: {len(failed)} of {len(rows)} checks failed\n" + "\n".join(failed))
    return len(rows)


def rule_violations(df: DataFrame, rules: Sequence[tuple[str, Column]], table: str) -> DataFrame:
    """Rows that break each rule, in one pass. A NULL outcome passes, as in a CHECK constraint."""
    entries = [
        F.struct(F.lit(label).alias("rule"), F.count_if(~F.coalesce(rule, F.lit(True))).alias("violations"))
        for label, rule in rules
    ]
    return df.agg(F.array(*entries).alias("e")).select(F.lit(table).alias("table_name"), F.inline("e"))


def null_counts(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in columns
    ]
    return df.agg(F.array(*entries).alias("e")).select(F.lit(table).alias("table_name"), F.inline("e"))


def long_form(one_row: DataFrame, *dims: str) -> DataFrame:
    """Columns of a metric frame as (dims..., metric, value) rows."""
    metrics = [c for c in one_row.columns if c not in dims]
    entries = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metrics
    ])
    return one_row.select(*dims, F.inline(entries))


def same_rows(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: do two frames hold the same rows the same number of times? No order, no global sort.

    Rows are counted per distinct content on both sides; a difference shows as an unequal count.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))

    a, b = counted(left, "a"), counted(right, "b").select(*[F.col(c).alias(f"__{c}") for c in columns], "b")
    both = a.join(b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns], "full")
    return both.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.abs(F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0)))), F.lit(0)).alias("differing_rows"),
    )

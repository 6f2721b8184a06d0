"""Key and reference checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.money import percent
from strata.operators.quality import union_all
from strata.operators.stats import expected_empty


Relation = tuple[str, str, str, str]  # child table, child column, parent table, parent column


def label(relation: Relation) -> str:
    child, fk, parent, pk = relation
    return f"{child}.{fk} -> {parent}.{pk}"


def key_census(tables: Mapping[str, DataFrame], relations: Sequence[Relation]) -> DataFrame:
    """relation (its number), k, children, copies: how often each key occurs on either side of each relation.

    Every table is read once, whatever it is child or parent of: its rows give one tagged key for each relation they take part in, and one shuffle
    counts them all, after each task has counted its own. Every relation has at least the row of the NULL key.
    """
    sides: dict[str, list[Column]] = {}
    for number, (child, fk, parent, pk) in enumerate(relations):
        for table, column, is_child in ((child, fk, 1), (parent, pk, 0)):
            sides.setdefault(table, []).append(F.struct(F.lit(number).alias("relation"), F.col(column).cast("string").alias("k"),
                                                        F.lit(is_child).alias("child"), F.lit(1 - is_child).alias("parent")))
    spark = next(iter(tables[t] for t in sides)).sparkSession
    seeds = spark.createDataFrame([(n, None, 0, 0) for n in range(len(relations))], "relation int, k string, child int, parent int")
    tagged = union_all([seeds, *[tables[t].select(F.inline(F.array(*tags))) for t, tags in sides.items()]])
    return tagged.groupBy("relation", "k").agg(F.sum("child").alias("children"), F.sum("parent").alias("copies"))


def orphans(tables: Mapping[str, DataFrame], relations: Sequence[Relation]) -> DataFrame:
    """relation (its label), orphans, blanks: child rows with a key that the parent does not have, and without a key."""
    lost = F.col("k").isNotNull() & (F.col("copies") == 0)
    counted = key_census(tables, relations).groupBy("relation").agg(
        F.coalesce(F.sum(F.when(lost, F.col("children"))), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("children"))), F.lit(0)).alias("blanks"))
    return counted.withColumn("relation", _labels(relations))


def _labels(relations: Sequence[Relation]) -> Column:
    return F.get(F.array(*[F.lit(label(r)) for r in relations]), F.col("relation"))


def fk_audit(tables: Mapping[str, DataFrame], relations: Sequence[Relation]) -> DataFrame:
    """One row of reference metrics per relation.

    Children are counted per key first, so a parent with many children costs one row. The
    quantiles run over (number of children -> number of parents); there are at most about the square
    root of twice the child rows different numbers of children.
    """
    linked = F.col("k").isNotNull() & (F.col("children") > 0) & (F.col("copies") > 0)
    sizes = key_census(tables, relations).select(
        "relation", F.col("children").alias("n"), F.when(F.col("k").isNotNull(), F.col("copies")).otherwise(0).alias("copies"), linked.alias("linked"),
        F.col("k").isNull().alias("is_null"),
    ).groupBy("relation", "n", "copies", "linked", "is_null").agg(F.count(F.lit(1)).alias("keys"))
    rows = F.col("n") * F.col("keys")
    weight = F.when(F.col("linked"), F.col("keys")).otherwise(0)
    m = sizes.groupBy("relation").agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(F.col("is_null"), rows)), F.lit(0)).alias("null_fk"),
        F.coalesce(F.sum(F.when(~F.col("linked") & ~F.col("is_null"), rows)), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum(F.col("copies") * F.col("keys")), F.lit(0)).alias("parent_rows"),
        F.sum(weight).alias("referenced_parents"),
        F.coalesce(F.sum(F.when(F.col("linked"), rows)), F.lit(0)).alias("linked_rows"),
        F.percentile(F.when(F.col("linked"), F.col("n")), [0.5, 0.95], F.greatest(weight, F.lit(0))).alias("q"),
        F.coalesce(F.max(F.when(F.col("linked"), F.col("n"))), F.lit(0)).alias("max_children"),
    )
    unused = F.col("parent_rows") - F.col("referenced_parents")
    filled = F.col("child_rows") - F.col("null_fk")
    empty = expected_empty(F.col("parent_rows"), filled)
    return m.select(
        _labels(relations).alias("relation"), "child_rows", filled.alias("non_null_fk"), "null_fk", "orphans",
        "parent_rows", "referenced_parents", unused.alias("unreferenced_parents"),
        F.coalesce(percent(F.col("referenced_parents"), F.col("parent_rows"), 2), F.lit(0).cast("decimal(38,2)"))
        .alias("parent_coverage_pct"),
        F.round(F.try_divide(F.col("linked_rows").cast("double"), F.col("referenced_parents").cast("double")), 2)
        .alias("avg_children"),
        F.round(F.get("q", F.lit(0)), 2).alias("median_children"),
        F.round(F.get("q", F.lit(1)), 2).alias("p95_children"),
        "max_children",
        F.round(empty, 2).alias("expected_unreferenced"),
        (F.round(unused - empty, 2) + F.lit(0.0)).alias("observed_minus_expected"),  # never -0.0
    )


def key_check(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """One row: total rows, rows that share their key with another row, rows with a NULL key part."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_in_duplicate_keys"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("rows_with_null_key"),
    ).select(F.lit(table).alias("table_name"), "*")

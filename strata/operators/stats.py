"""Association statistics. Each returns a frame of one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.lookup import attach_group
from strata.operators.quantiles import ValueCounts, bin_by_edges, quantile_edges
from strata.session import stage


def pearson(x: Column, y: Column, digits: int = 4) -> Column:
    """Correlation over rows with both values; NULL below two rows or with a constant side."""
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull()
    kept_x, kept_y = F.when(both, x), F.when(both, y)
    varies = (F.min(kept_x) < F.max(kept_x)) & (F.min(kept_y) < F.max(kept_y))
    # corr() itself raises on a constant side, guarded or not.
    value = F.try_divide(F.covar_pop(kept_x, kept_y), F.stddev_pop(kept_x) * F.stddev_pop(kept_y))
    return F.when(varies, F.round(value, digits))


def spearman(df: DataFrame, x: str, y: str, name: str = "spearman", digits: int = 4, weight: str | None = None,
             **sizes: int) -> DataFrame:
    """Rank correlation with average ranks for ties, over rows with both values.

    ``weight`` names a count column when ``df`` holds folded rows.
    """
    pairs = df.select(
        F.col(x).alias("x"), F.col(y).alias("y"), (F.col(weight) if weight else F.lit(1)).alias("w")
    ).where("x is not null and y is not null")
    folded = stage(pairs.groupBy("x", "y").agg(F.sum("w").alias("n")))  # the input is read once
    counted = ValueCounts(folded, "x", weight="n", **sizes), ValueCounts(folded, "y", weight="n", **sizes)
    for axis, table in zip("xy", counted):
        ranks = table.ranked().select(
            F.col("value").alias(axis), F.col("rank").alias(f"r{axis}"), F.col("n").alias(f"n{axis}")
        )
        folded = attach_group(folded, ranks, [axis], f"n{axis}").drop(f"n{axis}")
    middle = (counted[0].rows + 1) / 2  # the mean of all average ranks
    dx, dy, n = F.col("rx") - F.lit(middle), F.col("ry") - F.lit(middle), F.col("n")
    sums = folded.agg(
        F.sum(n * dx * dy).alias("xy"), F.sum(n * dx * dx).alias("xx"), F.sum(n * dy * dy).alias("yy")
    )
    varies = (F.col("xx") > 0) & (F.col("yy") > 0)
    return sums.select(
        F.when(varies, F.round(F.col("xy") / F.sqrt(F.col("xx")) / F.sqrt(F.col("yy")), digits)).alias(name)
    )


def safe_corr(df: DataFrame, x: str, y: str, method: str = "pearson", name: str = "value") -> DataFrame:
    if method == "spearman":
        return spearman(df, x, y, name)
    return df.agg(pearson(F.col(x), F.col(y)).alias(name))


def cramers_v(df: DataFrame, a: str, b: str, name: str = "cramers_v", digits: int = 4,
              weight: str | None = None) -> DataFrame:
    """Association of two categories from the filled cells of their table; NULL when a side has one level.

    ``weight`` names a count column when ``df`` holds folded rows.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    cells = (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(n.cast("double").alias("n"))
    )
    rows = cells.groupBy("a").agg(F.sum("n").alias("row_n"))
    cols = cells.groupBy("b").agg(F.sum("n").alias("col_n"))
    totals = (
        cells.join(rows, "a").join(cols, "b")
        .agg(
            F.sum(F.col("n") * F.col("n") / (F.col("row_n") * F.col("col_n"))).alias("s"),
            F.countDistinct("a").alias("r"), F.countDistinct("b").alias("c"),
        )
    )
    sides = F.least(F.col("r"), F.col("c")) - 1
    value = F.sqrt(F.greatest(F.col("s") - 1, F.lit(0.0)) / F.when(sides > 0, sides))
    return totals.select(F.round(value, digits).alias(name))


def add_decile(df: DataFrame, value: str, name: str = "decile", weight: str | None = None, **sizes: int) -> DataFrame:
    """Number of the tenth of the rows a value falls in; repeated edges merge bins."""
    return df.withColumn(name, bin_by_edges(F.col(value), quantile_edges(df, value, 10, weight, **sizes)))


def decile_association(df: DataFrame, category: str, value: str, name: str) -> DataFrame:
    """Association of a category with the tenths of a value. The input is read once."""
    folded = stage(df.groupBy(category, value).agg(F.count(F.lit(1)).alias("__n")))
    return cramers_v(add_decile(folded, value, "__decile", "__n"), category, "__decile", name, weight="__n")


def share_match(left: DataFrame, a: str, right: DataFrame, b: str, name: str = "probability") -> DataFrame:
    """Chance that independent draws from two columns agree: sum of the products of the shares."""
    def shares(df: DataFrame, column: str, value: str) -> DataFrame:
        counts = df.select(F.col(column).alias("k")).where("k is not null").groupBy("k").agg(
            F.count(F.lit(1)).alias(value))
        return counts.withColumn(f"{value}_all", F.lit(counts.agg(F.sum(value)).scalar()))

    joined = shares(left, a, "p").join(shares(right, b, "q"), "k")
    product = (F.col("p") / F.col("p_all")) * (F.col("q") / F.col("q_all"))
    return joined.agg(F.coalesce(F.sum(product), F.lit(0.0)).alias(name))


def expected_empty(parents: Column, children: Column) -> Column:
    """Parents left without a child when children pick parents uniformly."""
    p = parents.cast("double")
    return F.when(parents > 0, p * F.pow((p - 1) / p, children.cast("double"))).otherwise(F.lit(0.0))


def histogram(df: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """Counts in equally wide bins between minimum and maximum; the maximum belongs to the last bin."""
    x = F.col(value).cast("double")
    low, high = df.agg(F.min(x)).scalar(), df.agg(F.max(x)).scalar()
    number = F.least(F.lit(bins), F.floor((x - low) / ((high - low) / F.lit(float(bins)))) + 1)
    return (
        df.where(F.col(value).isNotNull()).select(F.when(high > low, number).otherwise(1).cast("bigint").alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )

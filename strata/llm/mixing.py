"""Mixing sources to target weights: temperature, exponent by bisection, realised as budgeted block permutations."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import staged


def tempered(shares: Sequence[float], exponent: float) -> list[float]:
    """Shares raised to ``exponent`` and normalised; 1 leaves them as they are, 0 makes all equal."""
    logs = [exponent * math.log(s) for s in shares]
    top = max(logs)
    raw = [math.exp(x - top) for x in logs]
    total = math.fsum(raw)
    return [x / total for x in raw]


def entropy(weights: Sequence[float]) -> float:
    return -math.fsum(w * math.log(w) for w in weights if w > 0)


def spread(shares: Sequence[float], weights: Sequence[float]) -> float:
    """How many times more often the most repeated source is read than the least repeated one."""
    passes = [w / s for w, s in zip(weights, shares, strict=True)]
    return max(passes) / min(passes)


def bisect_exponent(shares: Sequence[float], reached: Callable[[list[float]], bool], steps: int = 60) -> float:
    """Largest exponent in [0, 1] (nearest to the natural shares) whose weights satisfy ``reached``.

    ``reached`` has to hold below some exponent and not above it. 0 if it holds nowhere, 1 if everywhere.
    """
    if reached(tempered(shares, 1.0)):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        if reached(tempered(shares, middle)):
            low = middle
        else:
            high = middle
    return low


def exponent_for_entropy(shares: Sequence[float], target: float) -> float:
    """``target``: entropy as a part of the largest possible one, ln(number of sources)."""
    most = math.log(len(shares)) if len(shares) > 1 else 0.0
    return bisect_exponent(shares, lambda w: entropy(w) >= target * most - 1e-12)


def exponent_for_repetition(shares: Sequence[float], limit: float) -> float:
    """Smallest exponent, so flattest mixture, in which no source is read more than ``limit`` times as often as another."""
    if spread(shares, tempered(shares, 0.0)) <= limit:
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if spread(shares, tempered(shares, middle)) <= limit:
            high = middle
        else:
            low = middle
    return high


@dataclass(frozen=True)
class Mixture:
    """Per source (null is a source of its own): tokens, weight, budget in tokens, number of blocks."""

    sources: list[str | None]
    tokens: list[int]
    weights: list[float]
    budgets: list[int]
    blocks: list[int]
    exponent: float


def plan_mixture(totals: Sequence[tuple[str | None, int]], budget: int | None = None, entropy_part: float | None = None,
                 repetition: float | None = None, block_tokens: int = 1 << 20) -> Mixture:
    """Weights by temperature and the tokens to take from each source.

    One of ``entropy_part`` and ``repetition`` sets the exponent. Without ``budget`` the budget is the smallest one that reads every source
    at least once as a whole, so that no document is lost.
    """
    known = [(s, t) for s, t in totals if t > 0]
    if not known:
        return Mixture([], [], [], [], [], 1.0)
    total = sum(t for _, t in known)
    shares = [t / total for _, t in known]
    exponent = exponent_for_entropy(shares, entropy_part) if entropy_part is not None else exponent_for_repetition(
        shares, repetition if repetition is not None else 1.0)
    weights = tempered(shares, exponent)
    if budget is None:
        wanted = max(t / w for (_, t), w in zip(known, weights, strict=True))
        budgets = [max(t, round(w * wanted)) for (_, t), w in zip(known, weights, strict=True)]
    else:
        budgets = [round(w * budget) for w in weights]
    return Mixture([s for s, _ in known], [t for _, t in known], weights, budgets, [max(1, -(-t // block_tokens)) for _, t in known], exponent)


def word_count(text: Column) -> Column:
    """Tokens of a text where a tokenizer would be too dear: runs of visible characters, at least one per document."""
    return F.greatest(F.lit(1), F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^ \\t\\n\\x0B\\f\\r]+"))).cast("bigint")


def source_totals(docs: DataFrame, tokens: Column) -> list[tuple[str | None, int]]:
    """Tokens per source, one row per source; that number has to be small (it is checked), the rows may be many."""
    rows = docs.groupBy("source").agg(F.sum(tokens).alias("tokens")).limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("more than 100,000 sources; group them first")
    return sorted(((r["source"], r["tokens"] or 0) for r in rows), key=lambda r: (r[0] is not None, r[0] or ""))


def mix(docs: DataFrame, budget_part: float | None = None, entropy_part: float | None = None, repetition: float | None = None,
        tokens: Column | None = None, block_tokens: int = 1 << 20, seed: int = 1) -> DataFrame:
    """Realise a mixture: ``docs`` (doc_id, text, source, ...) with every row as often as its source's budget reads it.

    Documents of a source are dealt into blocks of about ``block_tokens`` by a hash. Every pass over a source takes its blocks in another order, drawn
    by a hash of seed, pass, source and block; documents of a block follow in the order of a hash as well. Whole passes take
    every document. In the last, partial pass blocks are taken in its order while they fit the rest of the budget, and of the next
    block the documents that still fit, so the budget is kept to within one document, never above it.

    Added columns: mix_tokens, mix_pass (from 0), mix_block, mix_order (position of the row within its pass is by block order, then hash).
    Existing columns of these names are replaced; all others may have any name. ``budget_part``: budget as a part of all tokens (None: see
    :func:`plan_mixture`). A null source is a source, a null text has one token, rows that repeat are documents each, an empty table gives no rows.
    ``tokens`` that are null or negative count as 0; a source without tokens costs nothing and is read once.
    """
    own = [c for c in docs.columns if c.lower() not in ("mix_tokens", "mix_pass", "mix_block", "mix_order")]
    cost = F.greatest(F.lit(0), F.coalesce(tokens, F.lit(0))).cast("bigint") if tokens is not None else word_count(F.col("text"))
    counted = docs.select(
        *[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(own)], F.col("source"), F.col("doc_id"), cost.alias("mix_tokens"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("mix_place"), F.xxhash64(F.lit(seed + 1), "doc_id", "text").alias("mix_deal"))
    totals = source_totals(counted, F.col("mix_tokens"))
    budget = None if budget_part is None else int(budget_part * sum(t for _, t in totals))
    plan = plan_mixture(totals, budget, entropy_part, repetition, block_tokens)
    spark = docs.sparkSession
    # One row per source, fewer than 100,000 as checked above.
    sources = F.broadcast(spark.createDataFrame(
        [*zip(plan.sources, plan.tokens, plan.budgets, plan.blocks, strict=True), *((s, 1, 0, 1) for s, t in totals if not t)],
        "mix_source string, mix_total bigint, mix_budget bigint, mix_blocks bigint"))
    dealt = counted.join(sources, F.col("source").cast("string").eqNullSafe(F.col("mix_source"))).withColumn(
        "mix_block", F.pmod("mix_deal", F.col("mix_blocks")).cast("int"))
    last = F.col("mix_budget").cast("bigint") - F.expr("mix_budget div mix_total") * F.col("mix_total")
    # The partial pass: blocks in its order with the tokens before them. One row per block and source.
    sizes = dealt.groupBy("mix_source", "mix_block").agg(F.sum("mix_tokens").alias("size"), F.first("mix_budget").alias("mix_budget"),
                                                         F.first("mix_total").alias("mix_total"))
    whole = F.expr("mix_budget div mix_total")
    drawn = F.xxhash64(F.lit(seed + 2), whole, "mix_source", "mix_block")
    line = Window.partitionBy("mix_source").orderBy("drawn", "mix_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = staged(sizes.withColumns({"drawn": drawn, "passes": whole, "rest": last}).withColumn("before", F.coalesce(F.sum("size").over(line), F.lit(0))).select(
        F.col("mix_source").alias("s"), F.col("mix_block").alias("b"), "passes", "rest", "before",
        (F.col("before") + F.col("size") <= F.col("rest")).alias("fits")))
    # The one block per source that fits in part: its documents one after the other.
    same = F.col("mix_source").eqNullSafe(F.col("s")) & (F.col("mix_block") == F.col("b"))
    partly = blocks.where(~F.col("fits") & (F.col("before") < F.col("rest")))
    inner = Window.partitionBy("s", "b").orderBy("mix_place", "doc_id").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    edge = dealt.select("mix_source", "mix_block", "mix_place", "doc_id", "mix_tokens").join(F.broadcast(partly), same).withColumn(
        "upto", F.sum("mix_tokens").over(inner)).where(F.col("before") + F.col("upto") <= F.col("rest")).groupBy("s", "b").agg(F.max(
            F.struct("mix_place", "doc_id")).alias("until"))
    cut = blocks.join(edge.withColumnsRenamed({"s": "s2", "b": "b2"}), F.col("s").eqNullSafe(F.col("s2")) & (F.col("b") == F.col("b2")), "left").select(
        "s", "b", "passes", "fits", F.col("until.mix_place").alias("until_place"), F.col("until.doc_id").alias("until_id"))
    taken = dealt.join(cut, same)
    key = F.struct(F.col("mix_place"), F.col("doc_id"))
    extra = F.col("fits") | F.coalesce(key <= F.struct(F.col("until_place").alias("mix_place"), F.col("until_id").alias("doc_id")), F.lit(False))
    times = F.col("passes") + extra.cast("bigint")
    repeated = taken.withColumn("mix_pass", F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("bigint"), times - 1)).otherwise(F.array().cast("array<bigint>"))))
    order = F.struct(F.xxhash64(F.lit(seed + 2), "mix_pass", "mix_source", "mix_block").alias("block"),
                     F.xxhash64("mix_pass", "mix_place").alias("row"))
    return repeated.select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(own)], "mix_tokens", "mix_pass", "mix_block", order.alias("mix_order"))

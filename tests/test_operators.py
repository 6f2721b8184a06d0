"""Operators on small literal or random frames, against brute force."""

from __future__ import annotations

import datetime as dt
import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.functions.dates import calendar
from strata.functions.money import cents, payment_band, pct, percent, ratio, within
from strata.functions.text import has_outer_space, is_email, row_hash, strip, trailing_number
from strata.operators.dedupe import duplicate_counts, flag_duplicates, pick_survivor
from strata.operators.intervals import contained, overlap_counts, overlapping, with_previous
from strata.operators.lookup import HeavyKeys, lookup, mark_exists, shares, with_slots
from strata.operators.quality import Check, GateError, gate, run_checks, same_rows
from strata.operators.quantiles import ValueCounts, bin_by_edges, exact_quantiles, quantile_edges
from strata.operators.relations import fk_audit, key_check
from strata.operators.stats import cramers_v, histogram, pearson, share_match, spearman


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# ------------------------------------------------------------------ expressions

def test_money(table):
    df = table("p string, t string", ("10.01", "10.00"), ("10.02", "10.00"), ("9.98", "10.00"), ("9.99", "10.00"), (None, "10.00"))
    df = df.select(F.col("p").cast("decimal(12,2)").alias("p"), F.col("t").cast("decimal(12,2)").alias("t"))
    bands = [r[0] for r in df.select(payment_band(F.col("p"), F.col("t"))).collect()]
    assert bands == ["full", "overpaid", "partial", "full", "unpaid"]
    assert [r[0] for r in df.select(cents(F.col("p"))).collect()] == [1001, 1002, 998, 999, None]


def test_weight_tolerance(table):
    df = table("w string", "0.99", "1.00", "1.01", "0.989", "1.011").select(F.col("w").cast("decimal(6,3)").alias("w"))
    one = F.lit(1).cast("decimal(6,3)")
    assert [r[0] for r in df.select(within(F.col("w"), one)).collect()] == [True, True, True, False, False]


def test_shares(table):
    df = table("a int, b int", (1, 3), (1, 8), (0, 0))
    assert [float(r[0]) if r[0] is not None else None for r in df.select(percent(F.col("a"), F.col("b"))).collect()] == [33.3, 12.5, None]
    assert [float(r[0]) for r in df.select(pct(F.col("a"), F.col("b"))).collect()] == [33.33, 12.5, 0.0]
    half = table("a string, b int", ("2.345", 1), ("-2.345", 1)).select(ratio(F.col("a").cast("decimal(10,3)"), F.col("b"), 2).alias("r"))
    assert [float(r[0]) for r in half.collect()] == [2.35, -2.35]


def test_text(table):
    df = table("s string", " a ", "a", "\tb")
    assert [r[0] for r in df.select(strip(F.col("s"))).collect()] == ["a", "a", "b"]
    assert [r[0] for r in df.select(has_outer_space(F.col("s"))).collect()] == [True, False, True]
    mails = table("s string", " Ana@x.org", "a@b", "a b@c.de", "a@@b.de")
    assert [r[0] for r in mails.select(is_email(F.col("s"))).collect()] == [True, False, False, False]
    ids = table("s string", "CUS-00012", "x", "9a10")
    assert [r[0] for r in ids.select(trailing_number(F.col("s"))).collect()] == [12, None, 10]


def test_row_hash_is_sha256_of_compact_json(table):
    import hashlib
    import json
    rows = [("a", 'q"uote', "line\nbreak"), ("é😀", "", "back\\slash\t")]
    got = [r[0] for r in table("x string, y string, z string", *rows).select(row_hash(["x", "y", "z"])).collect()]
    want = [hashlib.sha256(json.dumps(list(r), ensure_ascii=False, separators=(",", ":")).encode()).hexdigest() for r in rows]
    assert got == want


def test_calendar(table):
    span = table("a string, b string", ("2005-01-01", "2027-12-31")).select(
        F.to_date("a").alias("first_day"), F.to_date("b").alias("last_day"))
    days = calendar(span)
    assert days.count() == 8400
    sunday = days.where("date_key = date '2024-06-30'").first()
    assert (sunday.year, sunday.quarter, sunday.month, sunday.month_name, sunday.day, sunday.day_of_week, sunday.is_weekend) == (
        2024, 2, 6, "June", 30, 7, True)


# ------------------------------------------------------------------ groups and joins

@pytest.mark.parametrize("kind", ["int", "string"])
def test_heavy_keys_are_dealt_out_by_their_size(spark, kind):
    """A third of the rows with one key, a tenth without, one key just above a share, the rest small: every sub-key gets at most about a share."""
    n, share = 64_000, 64_000 // shares(spark.range(1))
    key = (F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 10 == 1, F.lit(None)).when(F.col("id") < 6 * share, F.lit(2)).otherwise(F.col("id") % 9000 + 10))
    rows = spark.range(n).select("id", key.cast(kind).alias("k"), (F.col("id") % 7).cast(kind).alias("other"))
    heavy = HeavyKeys(rows, "k", "other", ("k", "other"))
    assert len(heavy.heavy[("k",)]) == 2 and heavy.blank[("k",)] > 1 and len(heavy.heavy[("other",)]) == 7
    most = with_slots(rows, ["k"], heavy, ["id"]).groupBy("k", "__slot").count().agg(F.max("count")).first()[0]
    assert most <= 1.4 * share
    parent = spark.range(9010).select(F.col("id").cast(kind).alias("p"), (F.col("id") * 2).alias("v")).where("p <> 11")
    got = lookup(rows, parent, [("k", "p")], {"v": "v"}, row_id=["id"], heavy=heavy)
    assert got.count() == n
    wrong = got.where(~F.col("v").eqNullSafe(F.when(F.col("k") != F.lit("11").cast(kind), F.col("k").cast("bigint") * 2)))
    assert wrong.isEmpty()
    assert lookup(rows, parent, [("k", "p")], {"v": "v"}, "inner", ["id"]).count() == n - rows.where(F.col("k").isNull() | (F.col("k") == F.lit("11").cast(kind))).count()
    marked = mark_exists(rows, "k", parent, "p", "there")
    assert marked.count() == n and marked.where("not there").count() == rows.where(F.col("k").isNull() | (F.col("k") == F.lit("11").cast(kind))).count()


def test_lookup_without_heavy_keys_is_a_plain_join(spark):
    rows = spark.range(20_000).select("id", (F.col("id") * 7 % 20_011).alias("k"))
    plan = lookup(rows, rows.select(F.col("k").alias("p"), "id"), [("k", "p")], {"id": "v"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Generate" not in plan
    empty = lookup(rows.where("id < 0"), rows, [("k", "k")], {"id": "v"})
    assert empty.count() == 0 and empty.columns == ["id", "k", "v"]


def test_duplicates_and_survivor_with_hot_key(spark):
    """One key holds a third of the rows; flags and survivor equal the window definition."""
    rng = random.Random(7)
    rows = [(i, 0 if i % 3 == 0 else rng.randrange(2500), rng.choice(["b", "a", None])) for i in range(6000)]
    df = spark.createDataFrame(rows, "id int, k int, s string")
    got = pick_survivor(df, ["k", "s"], [F.length("s")], "id", "dup", "keep").toPandas().sort_values("id")
    pdf = pd.DataFrame(rows, columns=["id", "k", "s"])
    size = pdf.groupby(["k", "s"], dropna=False)["id"].transform("size")
    first = pdf.groupby(["k", "s"], dropna=False)["id"].transform("min")
    assert got["dup"].tolist() == (size > 1).tolist()
    assert got["keep"].tolist() == (first == pdf["id"]).tolist()
    flags = flag_duplicates(df, ["s"], "d", nulls_match=False).where("s is null").agg(F.max("d")).first()[0]
    assert flags is False


def test_survivor_order(table):
    df = table("id string, k int, status string", ("e4", 1, "active"), ("e3", 1, "failed"), ("e2", 1, "failed"), ("e9", 2, "?"))
    rank = F.when(F.col("status") == "failed", 2).when(F.col("status") == "active", 4).otherwise(5)
    got = pick_survivor(df, ["k"], [rank], "id", "dup", "keep")
    assert values(got.where("keep"), "id") == [("e2",), ("e9",)]
    assert values(got.where("dup"), "id") == [("e2",), ("e3",), ("e4",)]


def test_duplicate_counts(table):
    row = duplicate_counts(table("a string", "x", "x", "y", None, None, None), ["a"]).first()
    assert tuple(row) == (3, 2, 5, 3)


def test_lookup_keeps_rows_without_key(table):
    left = table("id int, k string", (1, "a"), (2, None), (3, "z"), (4, None))
    right = table("k string, v int", ("a", 10), ("b", 20))
    got = lookup(left, right, [("k", "k")], {"v": "v"})
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, 10), (2, None), (3, None), (4, None)]
    assert values(mark_exists(left, "k", right, "k", "known").where("known"), "id") == [(1,)]


# ------------------------------------------------------------------ quantiles and statistics

@pytest.mark.parametrize("buckets", [1, 16, None])
def test_quantiles_match_pandas_for_any_number_of_buckets(spark, buckets):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 900), "v": np.round(rng.exponential(50, 900), 1)})
    pdf.loc[::3, "v"] = 0.0  # a third of the rows share one value
    pdf.loc[5, "v"] = None
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    shares = [0.0, 0.1, 0.5, 0.95, 1.0]
    names = [f"q{i}" for i in range(5)]
    got = exact_quantiles(df, "v", shares, names, ["g"], digits=6, buckets=buckets).toPandas().set_index("g")
    want = pdf.groupby("g")["v"].quantile(shares).unstack()
    np.testing.assert_allclose(got.loc[want.index, names].to_numpy(), want.to_numpy(), atol=1e-6)
    alone = exact_quantiles(df, "v", [0.37], ["q"], buckets=buckets).first()[0]
    assert alone == pytest.approx(pdf["v"].quantile(0.37), abs=1e-4)


def test_quantiles_of_the_null_group_and_of_no_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 4.0), ("a", 2.0), ("a", None)], "g string, v double")
    got = {r.g: r.q for r in exact_quantiles(df, "v", [0.5], ["q"], ["g"]).collect()}
    assert got == {None: 2.5, "a": 2.0}
    assert exact_quantiles(df.where("false"), "v", [0.5], ["q"]).collect()[0].q is None


@pytest.mark.parametrize("buckets", [1, 7, None])
def test_ranks_and_spearman_match_pandas(spark, buckets):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"x": rng.integers(0, 40, 600).astype(float), "y": rng.normal(size=600).round(2)})
    pdf.loc[::3, "x"] = 0.0
    pdf.loc[[1, 2], "y"] = None
    df = spark.createDataFrame(pdf).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    want = pdf.dropna()["x"].rank().corr(pdf.dropna()["y"].rank())
    assert spearman(df, "x", "y", digits=10, buckets=buckets).first()[0] == pytest.approx(want, abs=1e-9)
    ranked = ValueCounts(df, "x", buckets=buckets).ranked().toPandas()
    want_rank = dict(zip(pdf["x"], pdf["x"].rank()))
    assert {r.value: r["rank"] for _, r in ranked.iterrows()} == pytest.approx(want_rank)


def test_decile_bins_match_qcut(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"v": np.concatenate([np.zeros(150), rng.integers(1, 300, 350)]).astype(float)})
    df = spark.createDataFrame(pdf)
    got = df.select(bin_by_edges(F.col("v"), quantile_edges(df, "v")).alias("b")).groupBy("b").count().toPandas()
    want = pd.qcut(pdf["v"], 10, duplicates="drop").value_counts(sort=False)
    assert got.sort_values("b")["count"].tolist() == want[want > 0].tolist()


def test_cramers_v_and_pearson(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": rng.choice(list("xyz"), 400), "b": rng.choice(list("pq"), 400)})
    pdf.loc[pdf.a == "x", "b"] = "p"
    table_ = pd.crosstab(pdf.a, pdf.b).to_numpy(float)
    expected = np.outer(table_.sum(1), table_.sum(0)) / table_.sum()
    v = np.sqrt((((table_ - expected) ** 2) / expected).sum() / (table_.sum() * 1))
    df = spark.createDataFrame(pdf)
    assert cramers_v(df, "a", "b", digits=9).first()[0] == pytest.approx(v, abs=1e-8)
    assert cramers_v(df.where("b = 'p'"), "a", "b").first()[0] is None
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert flat.agg(pearson(F.col("x"), F.col("y"))).first()[0] is None


def test_share_match_and_histogram(table):
    a, b = table("k string", "x", "x", "y", None), table("k string", "x", "z")
    assert share_match(a, "k", b, "k").first()[0] == pytest.approx(2 / 3 * 1 / 2)
    bins = histogram(table("v int", 0, 1, 59, 60, None), "v", 60)
    assert values(bins, "bin", "n") == [(1, 1), (2, 1), (60, 2)]


# ------------------------------------------------------------------ intervals

def random_intervals(seed: int, n: int):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rng.randrange(25)
        start = rng.randrange(60)
        rows.append((i, key, day(start), day(start + rng.randrange(-8, 12))))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_overlaps_match_pairs(spark, seed):
    """Proper and inverted intervals, repeated shapes, one hot key: equal to comparing all pairs."""
    rows = random_intervals(seed, 150)
    hit = set()
    for (i, k, s, e), (j, m, t, f) in combinations(rows, 2):
        if k == m and s <= f and t <= e:
            hit |= {i, j}
    df = spark.createDataFrame(rows, "id int, k int, s date, e date")
    shapes = overlapping(df, ["k"], "s", "e").where("overlaps")
    got = df.join(shapes, ["k", "s", "e"], "left_semi")
    assert {r.id for r in got.collect()} == hit
    row = overlap_counts(df, ["k"], "s", "e").first()
    keys = [r[1] for r in rows]
    assert row.repeated_groups == sum(keys.count(k) > 1 for k in set(keys))
    assert row.overlapping_groups == len({r[1] for r in rows if r[0] in hit})
    assert row.rows_in_overlaps == len(hit)


@pytest.mark.parametrize("seed", [5, 6])
def test_containment_matches_pairs(spark, seed):
    intervals = random_intervals(seed, 120)
    rng = random.Random(seed)
    points = [(i, 0 if i % 3 == 0 else rng.randrange(30), day(rng.randrange(80))) for i in range(200)]
    known = {(r[1]) for r in intervals}
    want_known = sum(p[1] in known for p in points)
    want_inside = sum(any(k == p[1] and s <= p[2] <= e for _, k, s, e in intervals) for p in points)
    got = contained(spark.createDataFrame(points, "id int, k int, at date"), spark.createDataFrame(intervals, "id int, k int, s date, e date"),
                    ["k"], "at", "s", "e").agg(
        F.sum(F.when(F.col("known"), F.col("n"))), F.sum(F.when(F.col("inside"), F.col("n"))), F.sum("n")).first()
    assert tuple(got) == (want_known, want_inside, len(points))


def test_previous_value_over_range_partitions(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, *range(40)]), rng.choice([None, *range(1000)])) for i in range(500)]
    rng.shuffle(rows)
    got = with_previous(spark.createDataFrame(rows, "id int, at int, v int"), ["at", "id"], "v", "before")
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    want = {r[0]: ordered[k - 1][2] if k else None for k, r in enumerate(ordered)}
    assert {r.id: r.before for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__chunk" in plan and with_previous(got.select("id", "at", "v").where("id < 0"), ["at", "id"], "v", "before").count() == 0


# ------------------------------------------------------------------ keys and gates

def test_fk_audit(table):
    child = table("fk string", "a", "a", "a", "b", None, "zz")
    parent = table("pk string", "a", "b", "c")
    row = fk_audit({"c": child, "p": parent}, [("c", "fk", "p", "pk")]).first()
    assert (row.child_rows, row.non_null_fk, row.null_fk, row.orphans, row.parent_rows) == (6, 5, 1, 1, 3)
    assert (row.referenced_parents, row.unreferenced_parents, row.max_children) == (2, 1, 3)
    assert (row.avg_children, row.median_children, float(row.parent_coverage_pct)) == (2.0, 2.0, 66.67)
    assert row.expected_unreferenced == round(3 * (2 / 3) ** 5, 2)


def test_key_check(table):
    row = key_check(table("a string, b int", ("x", 1), ("x", 1), (None, 2)), ["a", "b"], "t").first()
    assert tuple(row) == ("t", 3, 2, 1)


def test_gate(table):
    df = table("a int", 1, 2, None)
    good = Check("s", "rows", df, F.count(F.lit(1)), 3)
    assert gate(run_checks([good]), "layer") == 1
    with pytest.raises(GateError, match="blanks: got 1, expected 0"):
        gate(run_checks([good, Check("s", "blanks", df, F.count_if(F.col("a").isNull()), 0)]), "layer")


def test_same_rows(table):
    a, b = table("x int, y string", (1, "p"), (1, "p"), (2, None)), table("x int, y string", (2, None), (1, "p"))
    assert tuple(same_rows(a, b, ["x", "y"]).first()) == (3, 2, 1)
    assert same_rows(a, a, ["x", "y"]).first().differing_rows == 0


def test_quotients_round_once(table):
    from decimal import Decimal as D

    rows = table("n decimal(20,7), d decimal(10,3)", (D("59.9994996"), D("1")), (D("61.1394900"), D("1.019")), (D("1"), D("3")), (D("5"), D("0")))
    got = rows.select(ratio(F.col("n"), F.col("d"), 3).alias("r")).collect()
    assert [r["r"] for r in got] == [D("59.999"), D("59.999"), D("0.333"), None]

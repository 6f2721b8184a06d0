"""Cells that do not parse: typed rows, the reject table, its gate, Silver on top."""

from __future__ import annotations

import datetime as dt

import pytest

from probes import dirty
from strata.catalog import SOURCES
from strata.operators.quality import GateError, gate
from strata.plans.layer import Layer
from strata.plans.rejects import accept, check_rejects, rejected_cells, typed_or_rejected
from strata.plans.silver import silver


def text(spark, name, *rows):
    columns = [*SOURCES[name][1], "_source_file", "_source_row_number"]
    return spark.createDataFrame([(*r, "f.csv", i + 1) for i, r in enumerate(rows)], ", ".join(f"{c} {'int' if c.endswith('number') else 'string'}" for c in columns))


def test_values_and_rejects_come_from_one_pass(spark):
    raw = text(spark, "billing_products", ("p1", "s", "n", "c", "12.345", "True"), ("p2", "s", "n", "c", "12,5", "yes"), ("p3", "s", "n", "c", "", ""),
               ("p4", "s", "n", "c", "123456789.00", "False"), (None, None, None, None, None, None))
    parsed = typed_or_rejected(raw, "billing_products")
    got = {r.product_id: (r.monthly_price and float(r.monthly_price), r.active, r.sku, len(r._rejects)) for r in parsed.collect()}
    assert got == {"p1": (12.35, True, "s", 0), "p2": (None, None, "s", 2), "p3": (None, None, "s", 0), "p4": (None, False, "s", 1), None: (None, None, None, 0)}
    cells = {tuple(r) for r in rejected_cells(parsed, "billing_products").collect()}
    assert cells == {("billing_products", "monthly_price", "decimal(10,2)", "12,5", "f.csv:2"), ("billing_products", "active", "boolean", "yes", "f.csv:2"),
                     ("billing_products", "monthly_price", "decimal(10,2)", "123456789.00", "f.csv:4")}


def test_silver_goes_on_from_accepted_rows(spark, tmp_path):
    raw = Layer({"billing_products": lambda: text(spark, "billing_products", ("on", "", "", "", "1", "True"), ("off", "", "", "", "x", "False")),
                 "billing_subscriptions": lambda: text(spark, "billing_subscriptions", ("a", "active", "2024-02-01", "2024-02-30", "c", "off"),
                                                       ("b", "active", "2024-02-01", "2024-01-01", "c", "on"))})
    names = ("billing_products", "billing_subscriptions")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver(raw, "2026-07-20")["billing_subscriptions"].collect()
    accepted = accept(spark, raw, str(tmp_path / "rejects"), names)
    assert sorted((r.table_name, r.column_name, r.value) for r in accepted.cells.collect()) == [
        ("billing_products", "monthly_price", "x"), ("billing_subscriptions", "end_date", "2024-02-30")]
    rows = {r.subscription_id: r for r in silver(accepted.rows, "2026-07-20")["billing_subscriptions"].collect()}
    assert (rows["a"].end_date, rows["a"].active_sub_on_inactive_product, rows["a"].start_date) == (None, True, dt.date(2024, 2, 1))
    assert rows["b"].invalid_date_range and not rows["b"].active_sub_on_inactive_product
    assert gate(check_rejects(accepted, 0.5), "Rejects") == 2
    with pytest.raises(GateError, match="billing_products rows with cells that do not parse: got 1"):
        gate(check_rejects(accepted, 0.4), "Rejects")


def test_professors_without_a_date(spark, tmp_path):
    raw = Layer({"university_professors": lambda: text(spark, "university_professors", ("p", "", "", "A@b.c", "cs", ""), ("q", "", "", "", "cs", "soon"))})
    accepted = accept(spark, raw, str(tmp_path / "rejects"), ("university_professors",))
    got = {r.professor_id: (r.hired_at, r.email) for r in silver(accepted.rows)["university_professors"].collect()}
    assert got == {"p": (None, "a@b.c"), "q": (None, "")} and accepted.cells.count() == 1


def test_text_sources_have_keys_longer_than_a_bigint(spark):
    keys = [f"{order}-1-{part}-{part % 7 + 1}" for order in (12, 76482287, 9_000_000_000) for part in range(101765, 101765 + 46)]
    rows = spark.createDataFrame([(k, 1.5, "cash") for k in keys], "payment_id string, amount double, method string").selectExpr(
        "payment_id", "cast(amount as decimal(12,2)) as amount", "cast('2020-01-01' as date) as paid_at", "method", "'7' as invoice_id")
    got = dirty.over(spark, Layer({"billing_payments": lambda: rows}), {"billing_payments": dirty.WIDE_TEXT["billing_payments"]})["billing_payments"]
    places = {r.payment_id: (r.amount == "12,5x", r.paid_at == "31/02/2020") for r in got.collect()}
    remainder = {k: int(k.replace("-", "")) % dirty.JUNK_EVERY for k in keys}
    assert places == {k: (remainder[k] == 0, remainder[k] == 1) for k in keys} and {*remainder.values()} == {*range(dirty.JUNK_EVERY)}
    short = Layer({"billing_payments": lambda: rows.where("payment_id like '12-%'")})
    narrow, wide = (dirty.over(spark, short, {"billing_payments": s["billing_payments"]})["billing_payments"] for s in (dirty.TEXT, dirty.WIDE_TEXT))
    assert sorted(narrow.collect()) == sorted(wide.collect())


def test_text_sources_have_keys_longer_than_a_decimal(spark):
    big = 10 ** 12
    keys = [f"{59 * big + order}-{line}-{59 * big + part}-{59 * big + 7}" for order in (9, 149_999) for line in (1, 7) for part in range(101765, 101765 + 46)]
    keys += [f"{2 ** 63 - 1}-{2 ** 31 - 1}-{2 ** 63 - 1}-{2 ** 63 - k}" for k in range(1, 24)]
    rows = spark.createDataFrame([(k, 1.5, "cash") for k in keys], "payment_id string, amount double, method string").selectExpr(
        "payment_id", "cast(amount as decimal(12,2)) as amount", "cast('2020-01-01' as date) as paid_at", "method", "'7' as invoice_id")
    got = dirty.over(spark, Layer({"billing_payments": lambda: rows}), {"billing_payments": dirty.WIDE_TEXT["billing_payments"]})["billing_payments"]
    remainder = {k: int(k.replace("-", "")) % dirty.JUNK_EVERY for k in keys}
    assert {r.payment_id: (r.amount == "12,5x", r.paid_at == "31/02/2020") for r in got.collect()} == {k: (remainder[k] == 0, remainder[k] == 1) for k in keys}
    assert {*remainder.values()} == {*range(dirty.JUNK_EVERY)}

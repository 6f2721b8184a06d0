"""Billing checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.catalog import COUNTRY_CURRENCY
from strata.functions.dates import midnight
from strata.functions.money import cents, pct
from strata.operators.intervals import contained, overlap_counts
from strata.operators.lookup import condense, lookup, weighted_if
from strata.operators.quantiles import exact_quantiles
from strata.operators.stats import decile_association, pearson
from strata.plans.audits.university import Tables, day
from strata.session import stage


def _n() -> Column:
    return F.count(F.lit(1))


def _with_scalars(frame: DataFrame, one_row: DataFrame) -> DataFrame:
    """Columns of a one-row frame as scalars beside another one-row frame."""
    return frame.select("*", *[F.lit(one_row.select(c).scalar()).alias(c) for c in one_row.columns])


def product_prices(t: Tables, as_of: str) -> DataFrame:
    products = t["billing_products"]
    base = products.groupBy("category").agg(
        _n().alias("products"), F.count_if(F.col("monthly_price") <= 0).alias("nonpositive_price"),
        F.min("monthly_price").alias("min_price"), F.max("monthly_price").alias("max_price"))
    middle = exact_quantiles(products, "monthly_price", [0.5], ["median_price"], ["category"], digits=2)
    return base.join(middle, "category", "left")


def category_price_association(t: Tables, as_of: str) -> DataFrame:
    return decile_association(t["billing_products"], "category", "monthly_price", "cramers_v")


def subscription_rules(t: Tables, as_of: str) -> DataFrame:
    """Rules over dates, status and catalogue, from rows folded per customer, product, status and dates."""
    folded = condense(t["billing_subscriptions"], ["customer_id", "product_id", "status", "start_date", "end_date"])
    rows = folded.join(t["billing_customers"].select("customer_id", "created_at"), "customer_id", "left").join(
        t["billing_products"].select("product_id", "active"), "product_id", "left")
    live = F.col("status") == "active"
    return rows.agg(
        weighted_if(F.col("end_date") < F.col("start_date")).alias("end_before_start"),
        weighted_if(midnight(F.col("start_date")) < F.col("created_at")).alias("before_customer_created"),
        weighted_if(live).alias("active_total"),
        weighted_if(live & F.col("end_date").isNotNull()).alias("active_with_end_date"),
        weighted_if(live & (F.col("end_date") < day(as_of))).alias("active_expired"),
        weighted_if(live & ~F.col("active")).alias("active_on_inactive_product"),
    )


def inverted_by_status(t: Tables, as_of: str) -> DataFrame:
    return t["billing_subscriptions"].where("end_date < start_date").groupBy("status").agg(_n().alias("subscriptions"))


def subscription_overlaps(t: Tables, as_of: str) -> DataFrame:
    return overlap_counts(t["billing_subscriptions"], ["customer_id", "product_id"], "start_date", "end_date")


def invoice_rules(t: Tables, as_of: str) -> DataFrame:
    folded = condense(t["billing_invoices"], ["customer_id", "issued_at", "due_at", "status"])
    rows = folded.join(t["billing_customers"].select("customer_id", "created_at"), "customer_id", "left")
    pending = F.col("status") == "pending"
    return rows.agg(
        weighted_if(midnight(F.col("issued_at")) < F.col("created_at")).alias("before_customer_created"),
        weighted_if(F.col("due_at") < F.col("issued_at")).alias("due_before_issued"),
        weighted_if(pending & (F.col("due_at") < day(as_of))).alias("pending_past_due"),
        weighted_if(pending).alias("pending_total"),
    )


def due_days(t: Tables, as_of: str) -> DataFrame:
    return t["billing_invoices"].groupBy(F.datediff("due_at", "issued_at").alias("due_days")).agg(_n().alias("invoices"))


def _sums(details: DataFrame, amount: str, name: str) -> DataFrame:
    return details.groupBy("invoice_id").agg(F.sum(cents(F.col(amount))).alias(name))


def _finance(t: Tables) -> DataFrame:
    """Invoices with header, line and payment cents. One row per invoice on every side of the joins."""
    return (
        t["billing_invoices"].select("invoice_id", "status", "currency", cents(F.col("total")).alias("header"))
        .join(_sums(t["billing_invoice_items"], "line_total", "lines"), "invoice_id", "left")
        .join(_sums(t["billing_payments"], "amount", "paid"), "invoice_id", "left")
    )


def _against(details: DataFrame, amount: str, t: Tables, name: str) -> DataFrame:
    header = t["billing_invoices"].select("invoice_id", cents(F.col("total")).alias("header"))
    return header.join(_sums(details, amount, name), "invoice_id", "left").withColumn("delta", F.col(name) - F.col("header"))


def lines_against_header(t: Tables, as_of: str) -> DataFrame:
    rows = stage(_against(t["billing_invoice_items"], "line_total", t, "lines").select("header", "lines", "delta"))
    delta = F.col("delta")
    base = rows.agg(
        F.count_if(F.col("lines").isNull()).alias("without_items"), F.count("lines").alias("with_items"),
        F.count_if(delta == 0).alias("equal"), F.count_if(delta > 0).alias("lines_greater"),
        F.count_if(delta < 0).alias("lines_less"),
        F.when(F.count("lines") > 0, pearson(F.col("header"), F.col("lines"))).alias("pearson"),
        F.round(F.sum(delta).cast("double") / F.count(delta) / 100, 4).alias("delta_mean"),
    )
    spread = exact_quantiles(rows.withColumn("delta", F.col("delta") / 100), "delta", [0.0, 0.5, 1.0],
                             ["delta_min", "delta_median", "delta_max"])
    return _with_scalars(base, spread)


def currency_alignment(t: Tables, as_of: str) -> DataFrame:
    """Country of the customer against currency of the invoice, and the share if both were independent."""
    expected = F.create_map(*[F.lit(x) for pair in COUNTRY_CURRENCY.items() for x in pair])
    rows = condense(t["billing_invoices"], ["customer_id", "currency"]).join(
        t["billing_customers"].select("customer_id", "country"), "customer_id")
    cells = rows.groupBy("country", "currency").agg(F.sum("n").alias("n"))  # countries times currencies
    aligned = weighted_if(F.col("currency") == expected[F.col("country")])
    countries = cells.groupBy("country").agg(F.sum("n").alias("a"))
    currencies = cells.groupBy("currency").agg(F.sum("n").alias("b"))
    by_country = countries.withColumn("currency", expected[F.col("country")]).join(currencies, "currency")
    product = by_country.agg(F.coalesce(F.sum(F.col("a").cast("double") * F.col("b")), F.lit(0.0)))
    total = F.sum("n")
    return cells.agg(aligned.alias("aligned"), pct(aligned, total).alias("aligned_pct"), total.alias("invoices")).select(
        "aligned", "aligned_pct",
        F.round(F.lit(product.scalar()) / F.col("invoices") / F.col("invoices") * 100, 2).alias("expected_pct"))


def payment_presence(t: Tables, as_of: str) -> DataFrame:
    paid = t["billing_payments"].select("invoice_id", F.lit(True).alias("p")).distinct()
    rows = t["billing_invoices"].join(paid, "invoice_id", "left").withColumn(
        "presence", F.when(F.col("p"), "with_payment").otherwise("without_payment"))
    return rows.groupBy("status").pivot("presence", ["without_payment", "with_payment"]).count().na.fill(0)


def line_arithmetic(t: Tables, as_of: str) -> DataFrame:
    product = cents(F.col("quantity") * F.col("unit_price"))
    return t["billing_invoice_items"].agg(
        F.count_if(cents(F.col("line_total")) != product).alias("line_total_differs"), _n().alias("total_items"))


def unit_price_against_catalogue(t: Tables, as_of: str) -> DataFrame:
    """Items folded per product and unit price before they meet the catalogue."""
    folded = condense(t["billing_invoice_items"], ["product_id", "unit_price"])
    rows = folded.join(t["billing_products"].select("product_id", "monthly_price"), "product_id")
    u, m, n = F.col("unit_price").cast("double"), F.col("monthly_price").cast("double"), F.col("n")
    gap = F.abs(F.col("unit_price") - F.col("monthly_price"))
    near = F.when(F.col("monthly_price") > 0, gap * 100 <= F.col("monthly_price"))
    rows = stage(rows.withColumn("error", F.try_divide(F.abs(u - m), m)))
    # Weighted correlation of the folded rows, centred on the means to keep the sums small.
    means = rows.agg((F.sum(n * u) / F.sum(n)).alias("mu"), (F.sum(n * m) / F.sum(n)).alias("mm"))
    du, dm = u - F.lit(means.select("mu").scalar()), m - F.lit(means.select("mm").scalar())
    base = rows.agg(
        weighted_if(cents(F.col("unit_price")) == cents(F.col("monthly_price"))).alias("equal_price"),
        weighted_if(near).alias("within_one_pct"),
        F.sum(n * du * dm).alias("xy"), F.sum(n * du * du).alias("xx"), F.sum(n * dm * dm).alias("yy"),
    ).select("equal_price", "within_one_pct", F.when(
        (F.col("xx") > 0) & (F.col("yy") > 0), F.round(F.col("xy") / F.sqrt("xx") / F.sqrt("yy"), 4)).alias("pearson"))
    spread = exact_quantiles(rows.select((F.col("error") * 100).alias("error_pct"), "n"), "error_pct", [0.5],
                             ["median_error_pct"], digits=2, weight="n")
    return _with_scalars(base, spread)


def item_subscription_match(t: Tables, as_of: str) -> DataFrame:
    """Items whose customer ever subscribed to the product, and whose invoice date lies in such a contract."""
    items = condense(t["billing_invoice_items"], ["invoice_id", "product_id"]).join(
        t["billing_invoices"].select("invoice_id", "customer_id", "issued_at"), "invoice_id")
    held = contained(items, t["billing_subscriptions"], ["customer_id", "product_id"], "issued_at", "start_date", "end_date", "n")
    return held.agg(
        weighted_if(F.col("known")).alias("ever_subscribed"), weighted_if(F.col("inside")).alias("inside_contract"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_items"))


def payment_rules(t: Tables, as_of: str) -> DataFrame:
    """Payments folded per invoice, date and sign of the amount."""
    folded = t["billing_payments"].groupBy("invoice_id", "paid_at", (F.col("amount") <= 0).alias("nonpositive")).agg(
        _n().alias("n"))
    rows = folded.join(
        t["billing_invoices"].select("invoice_id", "issued_at", "due_at", "currency", "customer_id"), "invoice_id", "left"
    ).join(t["billing_customers"].select("customer_id", "created_at"), "customer_id", "left")
    at = F.col("paid_at")
    return rows.agg(
        weighted_if(F.col("nonpositive")).alias("nonpositive_amount"),
        weighted_if(at < F.col("issued_at")).alias("before_invoice_issued"),
        weighted_if(midnight(at) < F.col("created_at")).alias("before_customer_created"),
        weighted_if(at > F.col("due_at")).alias("after_invoice_due"),
        weighted_if(F.col("currency") != "USD").alias("on_non_usd_invoices"),
    )


def _payments_with_invoice(t: Tables, *columns: str) -> DataFrame:
    return lookup(t["billing_payments"], t["billing_invoices"], [("invoice_id", "invoice_id")], {c: c for c in columns}, "inner",
                  ["payment_id"])


def payments_by_currency(t: Tables, as_of: str) -> DataFrame:
    """Payments join their invoices once; counts and medians both come from the rows folded per currency and amount."""
    rows = stage(condense(_payments_with_invoice(t, "currency"), ["currency", "amount"]))
    base = rows.groupBy("currency").agg(F.sum("n").alias("payments"))
    return base.join(exact_quantiles(rows, "amount", [0.5], ["median_amount"], ["currency"], digits=2, weight="n"), "currency")


def payment_delay(t: Tables, as_of: str) -> DataFrame:
    """Delays are whole days, a small domain, so one buffer of counts per day is enough."""
    d = F.datediff("paid_at", "issued_at")
    return _payments_with_invoice(t, "issued_at").agg(
        F.min(d).alias("min_days"), F.percentile(d, 0.5).alias("median_days"),
        F.round(F.percentile(d, 0.95), 4).alias("p95_days"), F.max(d).alias("max_days"))


def payment_share(t: Tables, as_of: str) -> DataFrame:
    rows = stage(_payments_with_invoice(t, "total").select(
        F.col("amount"), F.col("total"),
        F.try_divide(F.col("amount").cast("double"), F.col("total").cast("double")).alias("ratio"),
        (cents(F.col("amount")) > cents(F.col("total"))).alias("greater")))
    base = rows.agg(
        pearson(F.col("amount"), F.col("total")).alias("pearson"), F.count_if("greater").alias("greater_than_invoice"))
    spread = exact_quantiles(rows, "ratio", [0.0, 0.5, 0.95, 1.0], ["ratio_min", "ratio_median", "ratio_p95", "ratio_max"])
    return _with_scalars(base, spread)


def payments_against_header(t: Tables, as_of: str) -> DataFrame:
    """Exact sign at cent precision and the band of one cent, side by side."""
    rows = _against(t["billing_payments"], "amount", t, "paid")
    delta = F.col("delta")
    return rows.agg(
        F.count("paid").alias("with_payments"), F.count_if(delta == 0).alias("equal"),
        F.count_if(delta > 0).alias("paid_greater"), F.count_if(delta < 0).alias("paid_less"),
        F.count_if(F.abs(delta) <= 1).alias("within_one_cent"), F.count_if(delta > 1).alias("greater_beyond_one_cent"),
        F.count_if(delta < -1).alias("less_beyond_one_cent"),
        F.when(F.count("paid") > 0, pearson(F.col("header"), F.col("paid"))).alias("pearson"),
    )


def finance_by_currency(t: Tables, as_of: str) -> DataFrame:
    money = lambda c: (F.coalesce(F.sum(c), F.lit(0)).cast("decimal(30,0)") / 100).cast("decimal(32,2)")
    return _finance(t).groupBy("currency").agg(
        _n().alias("invoices"), money("header").alias("reported_total"), money("lines").alias("line_sum"),
        money("paid").alias("payment_sum"), F.count("lines").alias("invoices_with_lines"),
        F.count("paid").alias("invoices_with_payments"))


def payments_on_open_invoices(t: Tables, as_of: str) -> DataFrame:
    per_invoice = condense(t["billing_payments"], ["invoice_id"])
    return per_invoice.join(t["billing_invoices"].where("status in ('pending', 'overdue')"), "invoice_id", "left_semi").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("payments"))


def payment_methods(t: Tables, as_of: str) -> DataFrame:
    return t["billing_payments"].groupBy("method").agg(_n().alias("payments"))


AUDITS: dict[str, Callable[[Tables, str], DataFrame]] = {
    "bil_product_prices": product_prices,
    "bil_category_price_association": category_price_association,
    "bil_subscription_rules": subscription_rules,
    "bil_inverted_by_status": inverted_by_status,
    "bil_subscription_overlaps": subscription_overlaps,
    "bil_invoice_rules": invoice_rules,
    "bil_due_days": due_days,
    "bil_lines_against_header": lines_against_header,
    "bil_currency_alignment": currency_alignment,
    "bil_payment_presence": payment_presence,
    "bil_line_arithmetic": line_arithmetic,
    "bil_unit_price_against_catalogue": unit_price_against_catalogue,
    "bil_item_subscription_match": item_subscription_match,
    "bil_payment_rules": payment_rules,
    "bil_payments_by_currency": payments_by_currency,
    "bil_payment_delay": payment_delay,
    "bil_payment_share": payment_share,
    "bil_payments_against_header": payments_against_header,
    "bil_finance_by_currency": finance_by_currency,
    "bil_payments_on_open_invoices": payments_on_open_invoices,
    "bil_payment_methods": payment_methods,
}

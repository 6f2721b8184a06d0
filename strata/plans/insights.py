"""Analyst queries over Silver and Gold."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.money import mean, percent, ratio
from strata.operators.lookup import missing_children
from strata.operators.quality import union_all
from strata.plans import kpi
from strata.plans.gold import PASS_MARK


@dataclass(frozen=True)
class Model:
    """The layers an insight may read, and the cut-off day."""

    silver: Mapping[str, DataFrame]
    gold: Mapping[str, DataFrame]
    as_of: str

    def day(self) -> Column:
        return F.lit(self.as_of).cast("date")


def _n() -> Column:
    return F.count(F.lit(1))


def _one(frame: DataFrame, **scalars: DataFrame) -> DataFrame:
    return frame.select("*", *[F.lit(v.scalar()).alias(k) for k, v in scalars.items()])


# Silver table and flag, as listed in the census.
CENSUS = (
    ("university_students", "age_at_enrollment_lt_15"), ("university_courses", "department_mismatch"),
    ("university_enrollments", "enrolled_at_out_of_window"), ("university_enrollments", "is_duplicate_enrollment"),
    ("university_grades", "has_duplicate_assessment"), ("billing_subscriptions", "invalid_date_range"),
    ("billing_subscriptions", "is_effectively_expired"), ("billing_invoices", "is_total_mismatch"),
    ("billing_invoices", "paid_without_payment"), ("crm_activities", "is_orphan"),
)


def flag_census(m: Model) -> DataFrame:
    """Raised flags, largest first. Flags of one table share its pass."""
    by_table: dict[str, list[str]] = {}
    for table, flag in CENSUS:
        by_table.setdefault(table, []).append(flag)
    parts = [
        m.silver[table].agg(F.array(*[
            F.struct(F.lit(f"{table}.{flag}").alias("flag"), F.count_if(flag).alias("raised")) for flag in flags
        ]).alias("e")).select(F.inline("e"))
        for table, flags in by_table.items()
    ]
    return union_all(parts).orderBy(F.desc("raised"), "flag")


def revenue_measures(m: Model) -> DataFrame:
    """Header, payment and line totals side by side with their ratio to the header."""
    header = m.silver["billing_invoices"].agg(F.sum("total_reported").cast("decimal(28,2)").alias("total"))
    paid = m.silver["billing_payments"].agg(F.sum("amount").cast("decimal(28,2)").alias("total"))
    lines = m.silver["billing_invoice_items"].agg(F.sum("line_total").cast("decimal(28,2)").alias("total"))
    rows = union_all(
        f.select(F.lit(n).alias("measure"), "total") for n, f in (("header", header), ("payments", paid), ("lines", lines)))
    return rows.select("*", ratio(F.col("total"), F.lit(header.scalar()), 4).alias("ratio_to_header"))


def mrr_by_state(m: Model) -> DataFrame:
    state = F.when(F.col("is_effectively_expired"), "expired").otherwise("current")
    return m.gold["fact_subscription"].where("status = 'active'").groupBy(state.alias("state")).agg(
        _n().alias("subscriptions"), F.sum("monthly_price").alias("mrr"))


def long_expired(m: Model) -> DataFrame:
    return m.gold["fact_subscription"].where(
        (F.col("status") == "active") & F.col("is_effectively_expired") & (F.col("end_date") < F.add_months(m.day(), -12))
    ).agg(_n().alias("subscriptions"))


def expiry_cohorts(m: Model) -> DataFrame:
    """Expired active contracts by year of their end; ranges without a valid end form their own class."""
    cohort = F.coalesce(F.year("end_date").cast("string"), F.lit("invalid range"))
    return m.gold["fact_subscription"].where(kpi.AT_RISK).groupBy(cohort.alias("cohort")).agg(
        _n().alias("subscriptions"), F.sum("monthly_price").alias("mrr"))


def open_by_year(m: Model) -> DataFrame:
    unpaid = F.count_if(F.col("status") != "paid")
    return m.gold["fact_invoice"].groupBy(F.year("issued_date").alias("year")).agg(
        _n().alias("invoices"), unpaid.alias("open_invoices"), percent(unpaid, _n()).alias("open_pct"))


def open_by_currency(m: Model) -> DataFrame:
    late = F.datediff(m.day(), F.col("due_date"))
    unpaid = F.col("status") != "paid"
    return m.gold["fact_invoice"].groupBy("currency").agg(
        F.sum(F.when(unpaid, F.col("invoiced_amount"))).alias("open_amount"),
        ratio(F.sum(F.when(unpaid, late)), F.count(F.when(unpaid, late)), 0).alias("mean_days_overdue"))


def _category_mix(m: Model) -> DataFrame:
    """Revenue by currency and category. Lines fold to (invoice, product) before the joins."""
    lines = m.silver["billing_invoice_items"].groupBy("invoice_id", "product_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("revenue"))
    per_product = lines.join(m.silver["billing_invoices"].select("invoice_id", "currency"), "invoice_id").groupBy(
        "currency", "product_id").agg(F.sum("revenue").alias("revenue"))
    return per_product.join(m.silver["billing_products"].select("product_id", "category"), "product_id").groupBy(
        "currency", "category").agg(F.sum("revenue").cast("decimal(30,4)").alias("revenue"))


def category_mix(m: Model) -> DataFrame:
    whole = F.sum("revenue").over(Window.partitionBy("currency"))
    return _category_mix(m).select("currency", "category", "revenue", percent(F.col("revenue"), whole).alias("share_pct"))


def _ranking(m: Model) -> DataFrame:
    best = F.sort_array(F.collect_list(F.struct((-F.col("revenue")).alias("r"), "category")))  # one entry per category
    return _category_mix(m).groupBy("currency").agg(
        F.array_join(F.transform(best, lambda s: s["category"]), " > ").alias("ranking"))


def category_ranking(m: Model) -> DataFrame:
    return _ranking(m)


def same_ranking(m: Model) -> DataFrame:
    return _ranking(m).agg(F.count(F.lit(1)).alias("currencies"), F.count_distinct("ranking").alias("rankings")).select(
        "*", (F.col("rankings") <= 1).alias("same_everywhere"))


def annual_revenue(m: Model) -> DataFrame:
    """Yearly revenue per currency against the year before, the first year and the best year."""
    yearly = m.gold["fact_invoice"].groupBy("currency", F.year("issued_date").alias("year")).agg(
        F.sum("invoiced_amount").alias("revenue"))
    years = Window.partitionBy("currency").orderBy("year")  # one row per year
    every = years.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    change = lambda base: percent(F.col("revenue") - base, base)
    return yearly.select(
        "currency", "year", "revenue", change(F.lag("revenue").over(years)).alias("vs_previous_pct"),
        change(F.first("revenue").over(every)).alias("vs_first_pct"), change(F.max("revenue").over(every)).alias("vs_peak_pct"))


def ticket_by_segment(m: Model) -> DataFrame:
    """Mean ticket in both scales and the revenue share. Invoices fold per customer before the join."""
    per = m.gold["fact_invoice"].groupBy("customer_id").agg(
        _n().alias("n"), F.sum("invoiced_amount").alias("a"), F.sum("total_reported").alias("h"))
    rows = per.join(m.gold["dim_customer"].select("customer_id", "segment"), "customer_id").groupBy("segment").agg(
        F.sum("n").alias("invoices"), F.sum("a").cast("decimal(28,2)").alias("a"), F.sum("h").cast("decimal(28,2)").alias("h"))
    return rows.select(
        "segment", "invoices", ratio(F.col("a"), F.col("invoices"), 2).alias("ticket_lines"),
        ratio(F.col("h"), F.col("invoices"), 2).alias("ticket_header"),
        percent(F.col("a"), F.sum("a").over(Window.partitionBy(F.lit(0)))).alias("revenue_pct"))


def unsupported_invoices(m: Model) -> DataFrame:
    a, b = F.col("has_no_items"), F.col("paid_without_payment")
    return m.silver["billing_invoices"].agg(
        F.count_if(a).alias("without_items"), F.count_if(b).alias("paid_without_payment"),
        F.count_if(a & b).alias("both"), F.count_if(a | b).alias("either"))


def unsupported_by_currency(m: Model) -> DataFrame:
    money = F.coalesce("total", "total_reported")
    return m.silver["billing_invoices"].groupBy("currency").agg(
        F.coalesce(F.sum(F.when(F.col("has_no_items"), money)), F.lit(0)).cast("decimal(28,2)").alias("amount_without_items"),
        F.coalesce(F.sum(F.when(F.col("paid_without_payment"), money)), F.lit(0)).cast("decimal(28,2)")
        .alias("amount_paid_without_payment"))


def discontinued_mrr(m: Model) -> DataFrame:
    per = m.gold["fact_subscription"].where(kpi.LIVE).groupBy("product_id").agg(
        _n().alias("n"), F.sum("monthly_price").cast("decimal(28,2)").alias("mrr"))
    rows = per.join(m.gold["dim_product"].select("product_id", "active"), "product_id")
    gone = ~F.col("active")
    return rows.agg(
        F.coalesce(F.sum(F.when(gone, F.col("n"))), F.lit(0)).alias("subscriptions"),
        F.coalesce(F.sum(F.when(gone, F.col("mrr"))), F.lit(0)).cast("decimal(28,2)").alias("mrr"),
        F.sum("mrr").alias("live_mrr"),
    ).select("subscriptions", "mrr", percent(F.col("mrr"), F.col("live_mrr")).alias("share_pct"))


def mrr_by_status(m: Model) -> DataFrame:
    return m.gold["fact_subscription"].groupBy("status").agg(
        _n().alias("subscriptions"), F.sum("monthly_price").alias("book"),
        F.sum(F.when(F.expr(kpi.LIVE), F.col("monthly_price"))).alias("live_mrr"))


def contract_duration(m: Model) -> DataFrame:
    """Durations are whole days, a small domain for the quantile."""
    days = F.datediff("end_date", "start_date")
    return m.gold["fact_subscription"].where("not invalid_date_range and end_date is not null").agg(
        _n().alias("subscriptions"), F.percentile(days, 0.5).alias("median_days"),
        ratio(F.sum(days), F.count(days), 0).alias("mean_days"))


def mrr_by_category(m: Model) -> DataFrame:
    per = m.gold["fact_subscription"].where(kpi.LIVE).groupBy("product_id").agg(
        F.sum("monthly_price").cast("decimal(28,2)").alias("mrr"))
    products = m.gold["dim_product"]
    prices = products.groupBy("category").agg(mean(F.col("monthly_price"), 2).alias("mean_list_price"))
    rows = per.join(products.select("product_id", "category"), "product_id").groupBy("category").agg(
        F.sum("mrr").cast("decimal(28,2)").alias("mrr"))
    whole = F.sum("mrr").over(Window.partitionBy(F.lit(0)))  # one row per category
    return rows.join(prices, "category").select("category", "mrr", percent(F.col("mrr"), whole).alias("share_pct"), "mean_list_price")


def top_product(m: Model) -> DataFrame:
    """The product with the largest live MRR."""
    per = m.gold["fact_subscription"].where(kpi.LIVE).groupBy("product_id").agg(
        F.sum("monthly_price").cast("decimal(28,2)").alias("mrr"), F.count_distinct("customer_id").alias("customers"))
    whole = per.agg(F.sum("mrr"))
    return per.orderBy(F.desc("mrr"), "product_id").limit(1).join(
        m.gold["dim_product"].select("product_id", "sku", "category"), "product_id").select(
        "sku", "category", "mrr", "customers", percent(F.col("mrr"), F.lit(whole.scalar())).alias("share_pct"))


def conversion_by_source(m: Model) -> DataFrame:
    return kpi.lead_by_source(m.gold).orderBy(F.desc("conversion_pct"), "source")


def score_by_conversion(m: Model) -> DataFrame:
    return m.gold["fact_lead"].groupBy("is_converted").agg(mean(F.col("score"), 1).alias("mean_score"), _n().alias("leads"))


def completed_without_grades(m: Model) -> DataFrame:
    done = F.col("status") == "completed"
    per = m.silver["university_enrollments"].groupBy("semester_id").agg(
        F.count_if(done).alias("d"), F.count_if(done & ~F.col("has_grades")).alias("w"))
    rows = per.join(m.silver["university_semesters"].select("semester_id", "code"), "semester_id")
    return rows.groupBy("code").agg(
        F.sum("d").alias("completed"), F.sum("w").alias("without_grades"), percent(F.sum("w"), F.sum("d"), 2).alias("pct"))


def loss_by_year(m: Model) -> DataFrame:
    per = m.gold["fact_enrollment"].groupBy("semester_id").agg(
        _n().alias("n"), F.count_if(F.col("status") == "dropped").alias("d"), F.count_if(F.col("status") == "failed").alias("f"))
    rows = per.join(m.gold["dim_semester"].select("semester_id", "year"), "semester_id")
    return rows.groupBy("year").agg(
        F.sum("d").alias("dropped"), F.sum("f").alias("failed"),
        percent(F.sum("d") + F.sum("f"), F.sum("n"), 2).alias("loss_pct"))


def _spread(scores: DataFrame, by: str) -> DataFrame:
    """Mean and sample deviation from exact sums of folded rows (n, s, q = sum of squares)."""
    n, s, q = F.sum("n"), F.sum("s"), F.sum("q")
    variance = (q.cast("double") - s.cast("double") * s.cast("double") / n) / (n - 1)
    return scores.groupBy(F.col(by).alias("value")).agg(
        n.alias("scored"), ratio(s, n, 2).alias("mean_score"),
        F.when(n > 1, F.round(F.sqrt(F.greatest(variance, F.lit(0.0))), 2)).alias("stddev"))


def _folded_scores(m: Model, key: str) -> DataFrame:
    x = F.col("final_score").cast("decimal(10,3)")
    return m.gold["fact_enrollment"].where("final_score is not null").groupBy(key).agg(
        _n().alias("n"), F.sum(x).cast("decimal(24,3)").alias("s"), F.sum(x * x).cast("decimal(30,6)").alias("q"))


def score_spread(m: Model) -> DataFrame:
    """Dispersion of final scores by department, semester and country."""
    dims = (("department", "course_id", "dim_course", "department"), ("semester", "semester_id", "dim_semester", "code"),
            ("country", "student_id", "dim_student", "country"))
    parts = []
    for label, key, dim, column in dims:
        rows = _folded_scores(m, key).join(m.gold[dim].select(key, column), key)
        parts.append(_spread(rows, column).select(F.lit(label).alias("dimension"), "*"))
    return union_all(parts)


def course_extremes(m: Model, least: int = 30) -> DataFrame:
    """Best and worst course by mean score among courses with at least ``least`` scored enrollments."""
    per = _folded_scores(m, "course_id").where(F.col("n") >= least).select(
        "course_id", F.col("n").alias("scored"), ratio(F.col("s"), F.col("n"), 2).alias("mean_score"))
    pick = lambda order, label: per.orderBy(*order).limit(1).select(F.lit(label).alias("which"), "*")
    return pick([F.desc("mean_score"), "course_id"], "best").unionByName(pick([F.asc("mean_score"), "course_id"], "worst"))


def score_by_status(m: Model) -> DataFrame:
    x = F.col("final_score")
    return m.gold["fact_enrollment"].groupBy("status").agg(
        _n().alias("enrollments"), F.count(x).alias("scored"), mean(x, 2).alias("mean_score"))


def failed_with_pass(m: Model) -> DataFrame:
    x = F.col("final_score")
    good = F.count_if(x >= PASS_MARK)
    return m.gold["fact_enrollment"].where("status = 'failed'").agg(
        F.count(x).alias("scored"), good.alias("passing_score"), percent(good, F.count(x)).alias("pct"))


def section_size(m: Model) -> DataFrame:
    per = m.gold["fact_enrollment"].groupBy("course_id", "semester_id").agg(_n().alias("n"))
    return per.agg(F.count(F.lit(1)).alias("sections"), ratio(F.sum("n"), _n(), 2).alias("mean_students"), F.max("n").alias("max_students"))


def completed_with_final(m: Model) -> DataFrame:
    finals = m.silver["university_grades"].where("assessment = 'final'").select("enrollment_id", F.lit(True).alias("f")).distinct()
    rows = m.silver["university_enrollments"].where("status = 'completed'").join(finals, "enrollment_id", "left")
    return rows.agg(_n().alias("completed"), F.count_if("f").alias("with_final"), percent(F.count_if("f"), _n()).alias("pct"))


def students_without_enrollment(m: Model) -> DataFrame:
    return missing_children(m.silver["university_students"].select("student_id"), "student_id",
                            m.silver["university_enrollments"], "student_id").agg(_n().alias("students"))


def _win_rate(m: Model, by: str) -> DataFrame:
    per = m.gold["fact_opportunity"].groupBy("account_id").agg(
        F.count_if("is_closed").alias("c"), F.count_if("is_won").alias("w"))
    return per.join(m.gold["dim_account"].select("account_id", by), "account_id").groupBy(by).agg(
        F.sum("c").alias("closed"), percent(F.sum("w"), F.sum("c")).alias("win_rate_pct")).where("closed > 0")


def win_rate_by_industry(m: Model) -> DataFrame:
    return _win_rate(m, "industry").orderBy(F.desc("win_rate_pct"), "industry")


def win_rate_by_size(m: Model) -> DataFrame:
    return _win_rate(m, "employee_band")


def deal_size(m: Model) -> DataFrame:
    return m.gold["fact_opportunity"].where("is_closed").groupBy("stage").agg(
        _n().alias("deals"), mean(F.col("amount"), 2).alias("mean_amount"))


def sales_cycle(m: Model) -> DataFrame:
    """Days from creation to close over closed deals with sound dates; whole days, a small domain."""
    days = F.datediff("close_date", "created_date")
    sound = F.when(F.col("is_closed") & ~F.col("is_close_before_created"), days)
    q = F.percentile(sound, [0.25, 0.5, 0.75])
    return m.gold["fact_opportunity"].agg(
        F.count_if("is_closed").alias("closed"), F.count_if(F.col("is_closed") & F.col("is_close_before_created")).alias("broken_dates"),
        q.alias("q")).select("closed", "broken_dates", *[
            F.round(F.get("q", F.lit(i)), 2).alias(n) for i, n in enumerate(("p25_days", "median_days", "p75_days"))])


def stale_pipeline(m: Model) -> DataFrame:
    live = ~F.col("is_closed")
    return m.gold["fact_opportunity"].agg(
        F.count_if(live).alias("open_deals"), F.count_if(live & (F.col("close_date") < m.day())).alias("past_close_date"))


def touches_by_outcome(m: Model) -> DataFrame:
    per = m.gold["fact_activity"].where("opportunity_id is not null").groupBy("opportunity_id").agg(_n().alias("n"))
    outcome = F.when(F.col("is_won"), "won").when(F.col("is_closed"), "lost").otherwise("open")
    return m.gold["fact_opportunity"].join(per, "opportunity_id", "left").groupBy(outcome.alias("outcome")).agg(
        _n().alias("deals"), F.coalesce(F.sum("n"), F.lit(0)).alias("activities"),
        ratio(F.coalesce(F.sum("n"), F.lit(0)), _n(), 2).alias("activities_per_deal"))


def customers_without_contract(m: Model) -> DataFrame:
    has = lambda fact: m.gold[fact].select("customer_id").distinct().withColumn(fact, F.lit(True))
    rows = m.gold["dim_customer"].select("customer_id").join(has("fact_subscription"), "customer_id", "left").join(
        has("fact_invoice"), "customer_id", "left")
    none, billed = F.col("fact_subscription").isNull(), F.col("fact_invoice").isNotNull()
    return rows.agg(
        F.count_if(none).alias("without_subscription"), F.count_if(none & billed).alias("billed_without_subscription"),
        F.count_if(none & ~billed).alias("neither"))


def early_contacts(m: Model) -> DataFrame:
    per = m.silver["crm_contacts"].groupBy("account_id", "created_at").agg(_n().alias("n"))
    accounts = m.silver["crm_accounts"].select("account_id", F.col("created_at").alias("a"))
    rows = per.join(accounts, "account_id")
    early = F.coalesce(F.sum(F.when(F.col("created_at") < F.col("a"), F.col("n"))), F.lit(0))
    return rows.agg(early.alias("early_contacts"), F.sum("n").alias("contacts"), percent(early, F.sum("n")).alias("pct"))


def funnels(m: Model) -> DataFrame:
    """Deals by stage and leads by status, largest first."""
    deals = kpi.sales_pipeline(m.gold).select(F.lit("deals").alias("funnel"), F.col("stage").alias("step"), F.col("opportunities").alias("n"))
    leads = kpi.lead_funnel(m.gold).select(F.lit("leads").alias("funnel"), F.col("status").alias("step"), F.col("leads").alias("n"))
    return deals.unionByName(leads).orderBy("funnel", F.desc("n"), "step")


def segment_students(m: Model) -> DataFrame:
    return kpi.student_vs_external_by_segment(m.gold)


def paid_by_band(m: Model) -> DataFrame:
    return m.gold["fact_invoice"].where("status = 'paid'").groupBy("payment_status_derived").agg(_n().alias("invoices"))


def survivors_out_of_window(m: Model) -> DataFrame:
    out = F.count_if("enrolled_at_out_of_window")
    return m.silver["university_enrollments"].where("is_duplicate_survivor").agg(
        _n().alias("enrollments"), out.alias("out_of_window"), percent(out, _n()).alias("pct"))


def monthly_range(m: Model) -> DataFrame:
    return kpi.revenue_monthly(m.gold).groupBy("currency").agg(
        F.min("revenue").alias("lowest_month"), F.max("revenue").alias("highest_month"), F.sum("invoices").alias("invoices"))


def main_currencies(m: Model) -> DataFrame:
    """Share of invoices in the two currencies with the most invoices."""
    per = m.gold["fact_invoice"].groupBy("currency").agg(_n().alias("n"))
    top = per.orderBy(F.desc("n"), "currency").limit(2)
    return top.agg(F.sum("n").alias("invoices")).select(
        "*", percent(F.col("invoices"), F.lit(per.agg(F.sum("n")).scalar())).alias("share_pct"))


def dropped_with_score(m: Model) -> DataFrame:
    scored = F.count("final_score")
    return m.gold["fact_enrollment"].where("status = 'dropped'").agg(
        _n().alias("dropped"), scored.alias("with_score"), percent(scored, _n()).alias("pct"))


INSIGHTS: dict[str, Callable[[Model], DataFrame]] = {
    f"ins_{f.__name__}": f for f in (
        flag_census, revenue_measures, mrr_by_state, long_expired, expiry_cohorts, open_by_year, open_by_currency, category_mix,
        category_ranking, same_ranking, annual_revenue, ticket_by_segment, unsupported_invoices, unsupported_by_currency,
        discontinued_mrr, mrr_by_status, contract_duration, mrr_by_category, top_product, conversion_by_source,
        score_by_conversion, completed_without_grades, loss_by_year, score_spread, course_extremes, score_by_status,
        failed_with_pass, section_size, completed_with_final, students_without_enrollment, win_rate_by_industry,
        win_rate_by_size, deal_size, sales_cycle, stale_pipeline, touches_by_outcome, customers_without_contract,
        early_contacts, funnels, segment_students, paid_by_band, survivors_out_of_window, monthly_range, main_currencies,
        dropped_with_score,
    )
}

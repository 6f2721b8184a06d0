"""The ten business KPIs and the chart queries on them. Money is never summed across currencies
except in KPIs over subscriptions, which carry catalogue prices."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import month_start
from strata.functions.money import mean, percent, ratio

Gold = Mapping[str, DataFrame]

LIVE = "status = 'active' and not is_effectively_expired"
AT_RISK = "status = 'active' and is_effectively_expired"

# Labels of the published views.
STUDENT, EXTERNAL = "estudiante", "externo"
MRR_LIVE, MRR_AT_RISK = "MRR real (vigente)", "MRR en riesgo (activa vencida)"


def _n() -> Column:
    return F.count(F.lit(1))


def _sum_if(condition: str, column: str) -> Column:
    return F.sum(F.when(F.expr(condition), F.col(column)))


def revenue_monthly(g: Gold) -> DataFrame:
    return g["fact_invoice"].groupBy(month_start(F.col("issued_date")).alias("month"), "currency").agg(
        _n().alias("invoices"), F.sum("invoiced_amount").alias("revenue"),
        mean(F.col("invoiced_amount"), 2).alias("avg_ticket"))


def collection_by_currency(g: Gold) -> DataFrame:
    paid = F.count_if(F.col("status") == "paid")
    return g["fact_invoice"].groupBy("currency").agg(
        _n().alias("invoices"), F.sum("invoiced_amount").alias("billed_amount"),
        paid.alias("paid_invoices"), percent(paid, _n()).alias("paid_pct"))


def academic_by_department(g: Gold) -> DataFrame:
    """Courses are counted per course first, so that the join sees one row per course and outcome."""
    per_course = g["fact_enrollment"].groupBy("course_id").agg(
        _n().alias("enrollments"), F.count_if("has_grades").alias("with_grades"),
        F.count_if("passed").alias("passed"),
        _sum_if("has_grades", "final_score").alias("points"),
        F.count(F.when(F.col("has_grades"), F.col("final_score"))).alias("scored"))
    return per_course.join(g["dim_course"].select("course_id", "department"), "course_id").groupBy("department").agg(
        F.sum("enrollments").alias("enrollments"), F.sum("with_grades").alias("with_grades"),
        ratio(F.sum("points"), F.sum("scored"), 2).alias("avg_final_score"),
        percent(F.sum("passed"), F.sum("with_grades")).alias("pass_rate_pct"))


def subscription_status(g: Gold) -> DataFrame:
    return g["fact_subscription"].groupBy("status").agg(
        _n().alias("subscriptions"), F.count_if("is_effectively_expired").alias("effectively_expired"),
        F.round(_sum_if(LIVE, "monthly_price"), 2).alias("active_mrr"))


def sales_pipeline(g: Gold) -> DataFrame:
    return g["fact_opportunity"].groupBy("stage").agg(
        _n().alias("opportunities"), F.round(F.sum("amount"), 2).alias("total_amount"),
        mean(F.col("amount"), 2).alias("avg_amount"))


def lead_funnel(g: Gold) -> DataFrame:
    return g["fact_lead"].groupBy("status").agg(_n().alias("leads"), mean(F.col("score"), 1).alias("avg_score"))


def _customer_billing(g: Gold) -> DataFrame:
    """Every customer with invoice count and amount; invoices are folded per customer before the join."""
    billed = g["fact_invoice"].groupBy("customer_id").agg(
        _n().alias("invoices"), F.sum("invoiced_amount").alias("amount"))
    return g["dim_customer"].join(billed, "customer_id", "left")


def _per_customer(customers: DataFrame, *by: str) -> DataFrame:
    label = F.when(F.col("is_student"), STUDENT).otherwise(EXTERNAL).alias("customer_type")
    count = F.count("customer_id")  # customers are one row each
    bills = F.coalesce(F.sum("invoices"), F.lit(0))
    return customers.groupBy(*by, label).agg(
        count.alias("customers"), bills.alias("invoices"),
        ratio(bills, count, 3).alias("invoices_per_customer"),
        ratio(F.sum("amount"), count, 2).alias("revenue_per_customer"))


def student_vs_external(g: Gold) -> DataFrame:
    return _per_customer(_customer_billing(g))


def student_vs_external_by_segment(g: Gold) -> DataFrame:
    return _per_customer(_customer_billing(g), "segment")


def mrr_breakdown(g: Gold) -> DataFrame:
    """Both rows come from one pass over the subscriptions."""
    def row(label: str, condition: str) -> Column:
        return F.struct(
            F.lit(label).alias("segmento"), F.count_if(F.expr(condition)).alias("suscripciones"),
            F.round(_sum_if(condition, "monthly_price"), 2).alias("mrr"))

    return g["fact_subscription"].agg(
        F.array(row(MRR_LIVE, LIVE), row(MRR_AT_RISK, AT_RISK)).alias("r")).select(F.inline("r"))


def lead_by_source(g: Gold) -> DataFrame:
    won = F.count_if("is_converted")
    return g["fact_lead"].groupBy("source").agg(
        _n().alias("leads"), won.alias("convertidos"), percent(won, _n()).alias("conversion_pct"))


def headline(g: Gold) -> DataFrame:
    """One row; each fact is read once."""
    subs = g["fact_subscription"].agg(
        F.round(_sum_if(LIVE, "monthly_price"), 0).alias("mrr_real"),
        F.round(_sum_if("status = 'active'", "monthly_price"), 0).alias("mrr_nominal"))
    open_pct = g["fact_invoice"].agg(percent(F.count_if(F.col("status") != "paid"), _n()))
    win_rate = g["fact_opportunity"].agg(percent(F.count_if("is_won"), F.count_if("is_closed")))
    conversion = g["fact_lead"].agg(percent(F.count_if("is_converted"), _n()))
    return subs.select("*", open_pct.scalar().alias("pct_sin_cobrar"), win_rate.scalar().alias("win_rate_pct"),
                       conversion.scalar().alias("lead_conversion_pct"))


KPIS: dict[str, Callable[[Gold], DataFrame]] = {
    "kpi_revenue_monthly": revenue_monthly,
    "kpi_collection_by_currency": collection_by_currency,
    "kpi_academic_by_department": academic_by_department,
    "kpi_subscription_status": subscription_status,
    "kpi_sales_pipeline": sales_pipeline,
    "kpi_lead_funnel": lead_funnel,
    "kpi_student_vs_external": student_vs_external,
    "kpi_mrr_breakdown": mrr_breakdown,
    "kpi_lead_by_source": lead_by_source,
    "kpi_headline": headline,
}


def _top(kpi: DataFrame, by: str, value: str, limit: int | None = None) -> DataFrame:
    """One bar per category. Rows are already aggregated, so shares take MAX; ties end by name. ``limit``: bars shown, all by default."""
    bars = kpi.groupBy(by).agg(F.max(value).alias(value)).orderBy(F.col(value).desc_nulls_last(), by)
    return bars if limit is None else bars.limit(limit)


def _monthly_chart(g: Gold) -> DataFrame:
    return (
        revenue_monthly(g).groupBy(month_start(F.col("month")).alias("month"), "currency")
        .agg(F.sum("revenue").alias("revenue")).orderBy("month", "currency")
    )


CHARTS: dict[str, Callable[[Gold], DataFrame]] = {
    "chart_mrr_real": lambda g: headline(g).agg(F.max("mrr_real").alias("mrr_real")),
    "chart_pct_sin_cobrar": lambda g: headline(g).agg(F.max("pct_sin_cobrar").alias("pct_sin_cobrar")),
    "chart_win_rate": lambda g: headline(g).agg(F.max("win_rate_pct").alias("win_rate_pct")),
    "chart_lead_conversion": lambda g: headline(g).agg(F.max("lead_conversion_pct").alias("lead_conversion_pct")),
    "chart_revenue_monthly": _monthly_chart,
    "chart_collection_by_currency": lambda g: _top(collection_by_currency(g), "currency", "paid_pct"),
    "chart_mrr_breakdown": lambda g: _top(mrr_breakdown(g), "segmento", "mrr"),
    "chart_subscriptions_by_status": lambda g: _top(subscription_status(g), "status", "subscriptions"),
    "chart_pass_rate_by_department": lambda g: _top(academic_by_department(g), "department", "pass_rate_pct"),
    "chart_academic_table": lambda g: academic_by_department(g).select(
        "department", "enrollments", "with_grades", "avg_final_score", "pass_rate_pct").orderBy("department"),
    "chart_pipeline_by_stage": lambda g: _top(sales_pipeline(g), "stage", "total_amount"),
    "chart_conversion_by_source": lambda g: _top(lead_by_source(g), "source", "conversion_pct"),
    "chart_student_vs_external": lambda g: student_vs_external(g).select(
        "customer_type", "customers", "invoices", "invoices_per_customer", "revenue_per_customer")
    .orderBy("customer_type"),
}

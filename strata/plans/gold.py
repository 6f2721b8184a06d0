"""Gold: the star schema. Facts keep the grain of Silver, except that duplicate enrollments fold to one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import calendar
from strata.operators.lookup import lookup
from strata.plans.layer import Layer

FIRST_DAY, LAST_DAY = "2005-01-01", "2027-12-31"
PASS_MARK = 60


def date_span(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    day = lambda d: F.lit(d).cast("date")
    return spark.range(1).select(day(first).alias("first_day"), day(last).alias("last_day"))


def dim_account(accounts: DataFrame) -> DataFrame:
    """An unknown size counts as large."""
    band = F.when(F.col("employees") < 50, "small").when(F.col("employees") <= 500, "mid").otherwise("large")
    return accounts.select("account_id", "name", "industry", "country", "annual_revenue", "employees",
                           band.alias("employee_band"), "name_is_shared")


def fact_enrollment(enrollments: DataFrame, summary: DataFrame) -> DataFrame:
    kept = enrollments.where("is_duplicate_survivor")
    scores = summary.select("enrollment_id", F.col("final_score_weighted").alias("final_score"), "weight_sum_ok")
    return kept.join(scores, "enrollment_id", "left").select(
        "enrollment_id", "student_id", "course_id", "semester_id", F.col("enrolled_at").alias("enrolled_date"),
        "status", "has_grades", "final_score", "weight_sum_ok", (F.col("final_score") >= PASS_MARK).alias("passed"),
    )


def fact_invoice(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        "invoice_id", "customer_id", F.col("issued_at").alias("issued_date"), F.col("due_at").alias("due_date"),
        "currency", F.coalesce("total", "total_reported").alias("invoiced_amount"), "total_reported", "status",
        "payment_status_derived", "has_no_items", "is_total_mismatch",
    )


def fact_payment(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    return lookup(payments, invoices, [("invoice_id", "invoice_id")], {"customer_id": "customer_id"}, "inner", ["payment_id"]).select(
        "payment_id", "invoice_id", "customer_id", F.col("paid_at").alias("paid_date"), "amount", "method")


def fact_subscription(subscriptions: DataFrame, products: DataFrame) -> DataFrame:
    return lookup(subscriptions, products, [("product_id", "product_id")],
                  {"monthly_price": "monthly_price"}, "inner", ["subscription_id"]).select(
        "subscription_id", "customer_id", "product_id", "status", "start_date", "end_date",
        "is_effectively_expired", "invalid_date_range", "monthly_price")


def gold(silver: Mapping[str, DataFrame], span: DataFrame) -> Layer:
    """``span``: one row with the first and last day of the calendar."""
    s = silver
    return Layer({
        "dim_date": lambda: calendar(span),
        "dim_student": lambda: s["university_students"].select(
            "student_id", "country", "birth_date", "enrolled_at", "age_at_enrollment_lt_15"),
        "dim_customer": lambda: s["billing_customers"].select(
            "customer_id", "is_student", F.col("external_ref").alias("student_id"), "segment", "country",
            F.to_date("created_at").alias("created_date")),
        "dim_product": lambda: s["billing_products"].select(
            "product_id", "sku", "name", "category", "monthly_price", "active"),
        "dim_course": lambda: s["university_courses"].select(
            "course_id", "code", "name", "credits", "department", "professor_id", "department_mismatch"),
        "dim_semester": lambda: s["university_semesters"].select(
            "semester_id", "code", "year", "half", "start_date", "end_date"),
        "dim_account": lambda: dim_account(s["crm_accounts"]),
        "fact_enrollment": lambda: fact_enrollment(s["university_enrollments"], s["enrollment_grade_summary"]),
        "fact_invoice": lambda: fact_invoice(s["billing_invoices"]),
        "fact_payment": lambda: fact_payment(s["billing_payments"], s["billing_invoices"]),
        "fact_subscription": lambda: fact_subscription(s["billing_subscriptions"], s["billing_products"]),
        "fact_opportunity": lambda: s["crm_opportunities"].select(
            "opportunity_id", "account_id", "stage", "amount", F.to_date("created_at").alias("created_date"),
            "close_date", "is_won", "is_closed", "is_close_before_created"),
        "fact_activity": lambda: s["crm_activities"].select(
            "activity_id", "type", F.to_date("occurred_at").alias("occurred_date"), "contact_id", "opportunity_id",
            "is_orphan", "account_mismatch"),
        "fact_lead": lambda: s["crm_leads"].select(
            "lead_id", "source", "status", "score", F.to_date("created_at").alias("created_date"), "is_converted"),
    })

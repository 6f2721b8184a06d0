"""Further Silver flags that the data-quality findings propose. Optional: nothing else depends on them.

Each function returns a Silver table's key with its flags.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.catalog import COUNTRY_CURRENCY
from strata.functions.dates import midnight
from strata.functions.money import cents, within
from strata.functions.text import strip, true_or_false
from strata.operators.intervals import contained
from strata.operators.lookup import attach_group, lookup, mark_exists
from strata.operators.reconcile import attach_sums, detail_sums
from strata.plans.audits.crm import scope

Silver = Mapping[str, DataFrame]


def activities(s: Silver) -> DataFrame:
    pairs = s["crm_opportunity_contacts"].select("opportunity_id", "contact_id").distinct().withColumn("known", F.lit(True))
    rows = lookup(s["crm_activities"].select("activity_id", "contact_id", "opportunity_id"), pairs,
                  [("opportunity_id", "opportunity_id"), ("contact_id", "contact_id")], {"known": "known"}, row_id=["activity_id"])
    return rows.select(
        "activity_id", scope(F.col("contact_id"), F.col("opportunity_id")).alias("activity_scope"),
        true_or_false(F.col("known")).alias("activity_pair_exists_in_bridge"))


def enrollments(s: Silver) -> DataFrame:
    """Temporally consistent: enrolled inside the semester and not before the student's registration."""
    rows = s["university_enrollments"].select(
        "enrollment_id", "student_id", "status", "has_grades", "enrolled_at_raw", "enrolled_at_out_of_window")
    rows = lookup(rows, s["university_students"], [("student_id", "student_id")], {"enrolled_at": "registered_at"},
                  row_id=["enrollment_id"])
    finals = s["university_grades"].where("assessment = 'final'")
    rows = mark_exists(rows, "enrollment_id", finals, "enrollment_id", "has_final_assessment")
    early = true_or_false(F.col("enrolled_at_raw") < F.col("registered_at"))
    return rows.select(
        "enrollment_id", ((F.col("status") == "completed") & ~F.col("has_grades")).alias("completed_without_grades"),
        "has_final_assessment", (~F.col("enrolled_at_out_of_window") & ~early).alias("is_temporally_consistent"))


def grade_summary(s: Silver) -> DataFrame:
    one, w = F.lit(1).cast("decimal(10,3)"), F.col("weight_sum")
    return s["enrollment_grade_summary"].select(
        "enrollment_id", F.when(w == one, "exact").when(within(w, one), "within_tolerance").when(w < one, "below")
        .otherwise("above").alias("grade_weight_status"))


def customers(s: Silver) -> DataFrame:
    """A linked customer whose e-mail, full name or country differs from the student's."""
    rows = lookup(
        s["billing_customers"].select("customer_id", "external_ref", "first_name", "last_name", "email", "country"),
        s["university_students"].withColumn("known", F.lit(True)), [("external_ref", "student_id")],
        {"known": "known", "first_name": "f", "last_name": "l", "email": "e", "country": "c"}, row_id=["customer_id"])
    differs = lambda a, b: F.lower(strip(F.col(a))) != F.lower(strip(F.col(b)))
    mismatch = differs("email", "e") | differs("first_name", "f") | differs("last_name", "l") | (F.col("country") != F.col("c"))
    return rows.select(
        "customer_id", F.col("external_ref").isNotNull().alias("has_student_reference"),
        true_or_false(F.col("known") & mismatch).alias("person_attributes_mismatch"))


def _against(amount: str, presence: str, absent: str, more: str, less: str) -> Column:
    delta = cents(F.col(amount)) - cents(F.col("total_reported"))
    return F.when(~F.col(presence), absent).when(delta > 0, more).when(delta < 0, less).otherwise("equal")


def invoices(s: Silver) -> DataFrame:
    """Statuses are exact at cent precision, unlike the tolerance bands of Silver."""
    rows = attach_sums(
        s["billing_invoices"].select("invoice_id", "customer_id", "currency", "issued_at", "due_at", "total_reported"), "invoice_id",
        detail_sums(s["billing_invoice_items"], "invoice_id", "line_total", "lines"),
        detail_sums(s["billing_payments"], "invoice_id", "amount", "paid"))
    rows = lookup(rows, s["billing_customers"], [("customer_id", "customer_id")], {"country": "country", "created_at": "created_at"},
                  row_id=["invoice_id"])
    expected = F.create_map(*[F.lit(x) for pair in COUNTRY_CURRENCY.items() for x in pair])[F.col("country")]
    broken = (F.col("due_at") < F.col("issued_at")) | (midnight(F.col("issued_at")) < F.col("created_at"))
    return rows.select(
        "invoice_id", true_or_false(F.col("currency") == expected).alias("country_currency_match"),
        _against("lines", "has_lines", "no_items", "lines_greater", "lines_less").alias("invoice_line_reconciliation_status"),
        _against("paid", "has_paid", "unpaid", "paid_greater", "paid_less").alias("payment_reconciliation_status"),
        (~true_or_false(broken)).alias("is_temporally_consistent"))


def invoice_items(s: Silver) -> DataFrame:
    """Whether the invoice date lies in a contract of the customer for the product, or there ever was one."""
    rows = lookup(s["billing_invoice_items"].select("invoice_item_id", "invoice_id", "product_id"), s["billing_invoices"],
                  [("invoice_id", "invoice_id")], {"customer_id": "customer_id", "issued_at": "day"}, row_id=["invoice_item_id"])
    keys = ["customer_id", "product_id"]
    held = contained(rows, s["billing_subscriptions"], keys, "day", "start_date", "end_date_raw")
    rows = attach_group(rows, held, [*keys, "day"], "n", ["invoice_item_id"])
    return rows.select("invoice_item_id", F.when(F.col("inside"), "inside_contract").when(F.col("known"), "subscribed")
                       .otherwise("never_subscribed").alias("item_subscription_match_status"))


def subscriptions(s: Silver) -> DataFrame:
    rows = lookup(s["billing_subscriptions"].select("subscription_id", "customer_id", "start_date", "invalid_date_range"),
                  s["billing_customers"], [("customer_id", "customer_id")], {"created_at": "created_at"},
                  row_id=["subscription_id"])
    early = true_or_false(midnight(F.col("start_date")) < F.col("created_at"))
    return rows.select("subscription_id", (~F.col("invalid_date_range") & ~early).alias("is_temporally_consistent"))


PROPOSED: dict[str, Callable[[Silver], DataFrame]] = {
    "crm_activities": activities, "university_enrollments": enrollments, "enrollment_grade_summary": grade_summary,
    "billing_customers": customers, "billing_invoices": invoices, "billing_invoice_items": invoice_items,
    "billing_subscriptions": subscriptions,
}

"""Silver: every Bronze row, typed, with one flag per anomaly. Nothing is repaired in place.

Where a canonical value replaces a raw one, the raw one stays beside it. Reference joins keep rows
without a partner, so the row counts of Bronze and Silver agree; the gates count missing partners.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.catalog import CLOSED_STAGES, SOURCES
from strata.functions.dates import age_years, outside
from strata.functions.money import beyond, payment_band, ratio, within
from strata.functions.text import blank_to_null, true_or_false
from strata.operators.dedupe import flag_duplicates, pick_survivor
from strata.operators.lookup import HeavyKeys, lookup, mark_exists
from strata.operators.reconcile import attach_sums, detail_sums
from strata.plans.layer import Layer

AS_OF = "2026-07-20"

# Which status survives when one student has several enrollments in a course and semester.
STATUS_ORDER = {"completed": 1, "failed": 2, "dropped": 3, "active": 4}
STATUS_LAST = 5

NULLABLE_DATES = {"university_professors": ("hired_at",)}


def _cast(df: DataFrame, table: str) -> DataFrame:
    """Strict casts to the Silver types: text that does not parse stops the load (``rejects.accept`` parses it before, cell by cell)."""
    columns, have = [], dict(df.dtypes)
    for name, kind in SOURCES[table][1].items():
        column = F.col(name)
        if have[name] != "string" and kind != "string":
            columns.append(column.cast(kind).alias(name))
            continue
        if name in NULLABLE_DATES.get(table, ()):
            column = blank_to_null(column)
        if kind == "boolean":
            column = column == F.lit("True")
        elif kind != "string":
            column = column.cast(kind)
        columns.append(column.alias(name))
    return df.select(*columns)


def _with_email(df: DataFrame, table: str) -> DataFrame:
    return _cast(df, table).withColumn("email", F.lower("email"))


def _flag(condition: Column, name: str) -> Column:
    return true_or_false(condition).alias(name)


def students(raw: DataFrame) -> DataFrame:
    age = age_years(F.col("birth_date"), F.col("enrolled_at"), "365.25")
    return _with_email(raw, "university_students").select("*", _flag(age < 15, "age_at_enrollment_lt_15"))


def courses(raw: DataFrame, professors: DataFrame) -> DataFrame:
    joined = lookup(_cast(raw, "university_courses"), professors, [("professor_id", "professor_id")],
                    {"department": "__their_department"}, row_id=["course_id"])
    return joined.select("*", _flag(F.col("department") != F.col("__their_department"), "department_mismatch")).drop(
        "__their_department")


def enrollments(raw: DataFrame, semesters: DataFrame, grades: DataFrame) -> DataFrame:
    rank = F.coalesce(
        F.create_map(*[F.lit(x) for pair in STATUS_ORDER.items() for x in pair])[F.col("status")],
        F.lit(STATUS_LAST),
    )
    rows = _cast(raw, "university_enrollments").withColumnRenamed("enrolled_at", "enrolled_at_raw")
    rows = pick_survivor(
        rows, ["student_id", "course_id", "semester_id"], [rank], "enrollment_id",
        "is_duplicate_enrollment", "is_duplicate_survivor",
    )
    rows = lookup(rows, semesters.select("semester_id", F.col("start_date").cast("date").alias("s"),
                                         F.col("end_date").cast("date").alias("e")),
                  [("semester_id", "semester_id")], {"s": "__start", "e": "__end"}, small=True)
    rows = mark_exists(rows, "enrollment_id", grades, "enrollment_id", "has_grades")
    return rows.select(
        "enrollment_id", "status", "student_id", "course_id", "semester_id", "enrolled_at_raw",
        F.col("__start").alias("enrolled_at"),
        _flag(outside(F.col("enrolled_at_raw"), F.col("__start"), F.col("__end")), "enrolled_at_out_of_window"),
        "is_duplicate_enrollment", "is_duplicate_survivor", "has_grades",
    )


def grades(raw: DataFrame) -> DataFrame:
    return flag_duplicates(_cast(raw, "university_grades"), ["enrollment_id", "assessment"], "has_duplicate_assessment",
                           row_id=["grade_id"])


def grade_summary(raw: DataFrame) -> DataFrame:
    """Per enrollment, from the unrounded source numbers (nine decimals); rounding happens only in the result.

    Sums are wider than the published column types, so that an enrollment with very many grades does not
    stop the load; the overflow rule counts what exceeds the published type.
    """
    score, weight = F.col("score").cast("decimal(18,9)"), F.col("weight").cast("decimal(18,9)")
    sums = raw.groupBy("enrollment_id").agg(
        F.count(F.lit(1)).alias("n_grades"), F.sum(weight).alias("w"),
        F.sum(score * weight).alias("points"), F.sum(score).alias("s"), F.count(score).alias("c"),
    )
    one = F.lit("1").cast("decimal(18,9)")
    return sums.select(
        "enrollment_id", "n_grades",
        F.col("w").cast("decimal(22,3)").alias("weight_sum"),
        _flag(within(F.col("w"), one), "weight_sum_ok"),
        ratio(F.col("points"), F.col("w"), 3, scale=18).cast("decimal(6,3)").alias("final_score_weighted"),
        ratio(F.col("s"), F.col("c"), 3, scale=9).cast("decimal(6,3)").alias("final_score_simple"),
    )


def customers(raw: DataFrame) -> DataFrame:
    return _with_email(raw, "billing_customers").withColumn("external_ref", blank_to_null(F.col("external_ref"))).select(
        "*", F.col("external_ref").isNotNull().alias("is_student"))


def subscriptions(raw: DataFrame, products: DataFrame, as_of: str) -> DataFrame:
    """The expiry flag looks at the raw end date, so it includes ranges whose end date is voided."""
    rows = lookup(_cast(raw, "billing_subscriptions"), products, [("product_id", "product_id")], {"active": "__active"},
                  row_id=["subscription_id"])
    start, end, live = F.col("start_date"), F.col("end_date"), F.col("status") == "active"
    inverted = true_or_false(end < start)
    return rows.select(
        "subscription_id", "status", "start_date", F.when(~inverted, end).alias("end_date"),
        end.alias("end_date_raw"), "customer_id", "product_id", inverted.alias("invalid_date_range"),
        _flag(live & (end < F.lit(as_of).cast("date")), "is_effectively_expired"),
        _flag(live & (F.col("__active") == "False"), "active_sub_on_inactive_product"),
    )


def invoices(raw: DataFrame, items: DataFrame, payments: DataFrame, as_of: str) -> DataFrame:
    """Header total against line sums; payment band against the reported header total."""
    lines = detail_sums(items.select("invoice_id", F.col("line_total").cast("decimal(12,2)").alias("v")),
                        "invoice_id", "v", "items")
    paid = detail_sums(payments.select("invoice_id", F.col("amount").cast("decimal(12,2)").alias("v")),
                       "invoice_id", "v", "payments")
    rows = attach_sums(_cast(raw, "billing_invoices"), "invoice_id", lines, paid)
    total, status = F.col("total"), F.col("status")
    return rows.select(
        "invoice_id", "issued_at", "due_at", total.alias("total_reported"),
        F.col("items").cast("decimal(22,2)").alias("total"), "status", "currency", "customer_id",
        _flag(beyond(total, F.col("items")), "is_total_mismatch"),
        (~F.col("has_items")).alias("has_no_items"),
        _flag((F.col("due_at") < F.lit(as_of).cast("date")) & (status != "paid"), "is_past_due"),
        _flag((status == "paid") & ~F.col("has_payments"), "paid_without_payment"),
        payment_band(F.col("payments"), total).alias("payment_status_derived"),
    )


def accounts(raw: DataFrame) -> DataFrame:
    return flag_duplicates(_cast(raw, "crm_accounts"), ["name"], "name_is_shared", nulls_match=False, row_id=["account_id"])


def contacts(raw: DataFrame) -> DataFrame:
    return flag_duplicates(_with_email(raw, "crm_contacts"), ["email"], "is_duplicate_email", nulls_match=False, row_id=["contact_id"])


def leads(raw: DataFrame) -> DataFrame:
    return _with_email(raw, "crm_leads").select("*", _flag(F.col("status") == "converted", "is_converted"))


def opportunities(raw: DataFrame, bridge: DataFrame) -> DataFrame:
    rows = _cast(raw, "crm_opportunities").select(
        "*",
        _flag(F.col("close_date") < F.to_date("created_at"), "is_close_before_created"),
        _flag(F.col("stage").isin(*CLOSED_STAGES), "is_closed"),
        _flag(F.col("stage") == "won", "is_won"),
    )
    return mark_exists(rows, "opportunity_id", bridge, "opportunity_id", "has_contacts")


def _both_accounts(rows: DataFrame, opportunities: DataFrame, contacts: DataFrame, *row_id: str) -> DataFrame:
    heavy = HeavyKeys(rows, "opportunity_id", "contact_id")  # one pass for both
    rows = lookup(rows, opportunities, [("opportunity_id", "opportunity_id")], {"account_id": "__deal_account"}, row_id=row_id, heavy=heavy)
    return lookup(rows, contacts, [("contact_id", "contact_id")], {"account_id": "__person_account"}, row_id=row_id, heavy=heavy)


def opportunity_contacts(raw: DataFrame, opportunities: DataFrame, contacts: DataFrame) -> DataFrame:
    rows = _both_accounts(_cast(raw, "crm_opportunity_contacts"), opportunities, contacts, "opportunity_id", "contact_id")
    return rows.select("opportunity_id", "contact_id", "role",
                       _flag(F.col("__deal_account") != F.col("__person_account"), "account_mismatch"))


def activities(raw: DataFrame, opportunities: DataFrame, contacts: DataFrame) -> DataFrame:
    rows = _cast(raw, "crm_activities")
    for key in ("contact_id", "opportunity_id"):
        rows = rows.withColumn(key, blank_to_null(F.col(key)))
    orphan = F.col("contact_id").isNull() & F.col("opportunity_id").isNull()
    rows = _both_accounts(rows, opportunities, contacts, "activity_id")
    return rows.select(
        "activity_id", "type", "subject", "occurred_at", "contact_id", "opportunity_id", orphan.alias("is_orphan"),
        _flag(F.col("__deal_account") != F.col("__person_account"), "account_mismatch"),
    )


def silver(bronze: Mapping[str, DataFrame], as_of: str = AS_OF) -> Layer:
    b = bronze
    return Layer({
        "university_semesters": lambda: _cast(b["university_semesters"], "university_semesters"),
        "university_professors": lambda: _with_email(b["university_professors"], "university_professors"),
        "university_students": lambda: students(b["university_students"]),
        "university_courses": lambda: courses(b["university_courses"], b["university_professors"]),
        "university_enrollments": lambda: enrollments(
            b["university_enrollments"], b["university_semesters"], b["university_grades"]),
        "university_grades": lambda: grades(b["university_grades"]),
        "enrollment_grade_summary": lambda: grade_summary(b["university_grades"]),
        "billing_products": lambda: _cast(b["billing_products"], "billing_products"),
        "billing_customers": lambda: customers(b["billing_customers"]),
        "billing_subscriptions": lambda: subscriptions(b["billing_subscriptions"], b["billing_products"], as_of),
        "billing_invoices": lambda: invoices(
            b["billing_invoices"], b["billing_invoice_items"], b["billing_payments"], as_of),
        "billing_invoice_items": lambda: _cast(b["billing_invoice_items"], "billing_invoice_items"),
        "billing_payments": lambda: _cast(b["billing_payments"], "billing_payments"),
        "crm_accounts": lambda: accounts(b["crm_accounts"]),
        "crm_contacts": lambda: contacts(b["crm_contacts"]),
        "crm_leads": lambda: leads(b["crm_leads"]),
        "crm_opportunities": lambda: opportunities(b["crm_opportunities"], b["crm_opportunity_contacts"]),
        "crm_opportunity_contacts": lambda: opportunity_contacts(
            b["crm_opportunity_contacts"], b["crm_opportunities"], b["crm_contacts"]),
        "crm_activities": lambda: activities(b["crm_activities"], b["crm_opportunities"], b["crm_contacts"]),
    })

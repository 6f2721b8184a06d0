"""The eighteen sources: columns, types, keys and references.

The names, types, keys and value lists are fixed values: they describe the input files.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# table: (primary key, {column: Silver type}); date and number columns are what the audits parse.
SOURCES: dict[str, tuple[tuple[str, ...], dict[str, str]]] = {
    "university_semesters": (("semester_id",), {
        "semester_id": "string", "code": "string", "year": "smallint", "half": "smallint",
        "start_date": "date", "end_date": "date"}),
    "university_professors": (("professor_id",), {
        "professor_id": "string", "first_name": "string", "last_name": "string", "email": "string",
        "department": "string", "hired_at": "date"}),
    "university_students": (("student_id",), {
        "student_id": "string", "first_name": "string", "last_name": "string", "email": "string",
        "birth_date": "date", "enrolled_at": "date", "country": "string"}),
    "university_courses": (("course_id",), {
        "course_id": "string", "code": "string", "name": "string", "credits": "smallint",
        "department": "string", "professor_id": "string"}),
    "university_enrollments": (("enrollment_id",), {
        "enrollment_id": "string", "enrolled_at": "date", "status": "string", "student_id": "string",
        "course_id": "string", "semester_id": "string"}),
    "university_grades": (("grade_id",), {
        "grade_id": "string", "assessment": "string", "score": "decimal(5,2)", "weight": "decimal(4,3)",
        "graded_at": "date", "enrollment_id": "string"}),
    "billing_customers": (("customer_id",), {
        "customer_id": "string", "external_ref": "string", "first_name": "string", "last_name": "string",
        "email": "string", "country": "string", "created_at": "timestamp", "segment": "string"}),
    "billing_products": (("product_id",), {
        "product_id": "string", "sku": "string", "name": "string", "category": "string",
        "monthly_price": "decimal(10,2)", "active": "boolean"}),
    "billing_subscriptions": (("subscription_id",), {
        "subscription_id": "string", "status": "string", "start_date": "date", "end_date": "date",
        "customer_id": "string", "product_id": "string"}),
    "billing_invoices": (("invoice_id",), {
        "invoice_id": "string", "issued_at": "date", "due_at": "date", "total": "decimal(12,2)",
        "status": "string", "currency": "string", "customer_id": "string"}),
    "billing_invoice_items": (("invoice_item_id",), {
        "invoice_item_id": "string", "quantity": "decimal(10,2)", "unit_price": "decimal(10,2)",
        "line_total": "decimal(12,2)", "invoice_id": "string", "product_id": "string"}),
    "billing_payments": (("payment_id",), {
        "payment_id": "string", "amount": "decimal(12,2)", "paid_at": "date", "method": "string",
        "invoice_id": "string"}),
    "crm_accounts": (("account_id",), {
        "account_id": "string", "name": "string", "industry": "string", "country": "string",
        "annual_revenue": "decimal(14,2)", "employees": "int", "created_at": "timestamp"}),
    "crm_contacts": (("contact_id",), {
        "contact_id": "string", "first_name": "string", "last_name": "string", "email": "string",
        "phone": "string", "title": "string", "created_at": "timestamp", "account_id": "string"}),
    "crm_leads": (("lead_id",), {
        "lead_id": "string", "first_name": "string", "last_name": "string", "email": "string",
        "source": "string", "status": "string", "score": "smallint", "created_at": "timestamp"}),
    "crm_opportunities": (("opportunity_id",), {
        "opportunity_id": "string", "name": "string", "stage": "string", "amount": "decimal(14,2)",
        "close_date": "date", "created_at": "timestamp", "account_id": "string"}),
    "crm_opportunity_contacts": (("opportunity_id", "contact_id"), {
        "opportunity_id": "string", "contact_id": "string", "role": "string"}),
    "crm_activities": (("activity_id",), {
        "activity_id": "string", "type": "string", "subject": "string", "occurred_at": "timestamp",
        "contact_id": "string", "opportunity_id": "string"}),
}

# child table, child column, parent table, parent column
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("university_courses", "professor_id", "university_professors", "professor_id"),
    ("university_enrollments", "student_id", "university_students", "student_id"),
    ("university_enrollments", "course_id", "university_courses", "course_id"),
    ("university_enrollments", "semester_id", "university_semesters", "semester_id"),
    ("university_grades", "enrollment_id", "university_enrollments", "enrollment_id"),
    ("billing_customers", "external_ref", "university_students", "student_id"),
    ("billing_subscriptions", "customer_id", "billing_customers", "customer_id"),
    ("billing_subscriptions", "product_id", "billing_products", "product_id"),
    ("billing_invoices", "customer_id", "billing_customers", "customer_id"),
    ("billing_invoice_items", "invoice_id", "billing_invoices", "invoice_id"),
    ("billing_invoice_items", "product_id", "billing_products", "product_id"),
    ("billing_payments", "invoice_id", "billing_invoices", "invoice_id"),
    ("crm_contacts", "account_id", "crm_accounts", "account_id"),
    ("crm_opportunities", "account_id", "crm_accounts", "account_id"),
    ("crm_opportunity_contacts", "opportunity_id", "crm_opportunities", "opportunity_id"),
    ("crm_opportunity_contacts", "contact_id", "crm_contacts", "contact_id"),
    ("crm_activities", "contact_id", "crm_contacts", "contact_id"),
    ("crm_activities", "opportunity_id", "crm_opportunities", "opportunity_id"),
)

# Gold references, the six to the calendar last.
GOLD_FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("fact_enrollment", "student_id", "dim_student", "student_id"),
    ("fact_enrollment", "course_id", "dim_course", "course_id"),
    ("fact_enrollment", "semester_id", "dim_semester", "semester_id"),
    ("fact_invoice", "customer_id", "dim_customer", "customer_id"),
    ("fact_payment", "invoice_id", "fact_invoice", "invoice_id"),
    ("fact_payment", "customer_id", "dim_customer", "customer_id"),
    ("fact_subscription", "customer_id", "dim_customer", "customer_id"),
    ("fact_subscription", "product_id", "dim_product", "product_id"),
    ("fact_opportunity", "account_id", "dim_account", "account_id"),
    ("fact_enrollment", "enrolled_date", "dim_date", "date_key"),
    ("fact_invoice", "issued_date", "dim_date", "date_key"),
    ("fact_payment", "paid_date", "dim_date", "date_key"),
    ("fact_opportunity", "created_date", "dim_date", "date_key"),
    ("fact_activity", "occurred_date", "dim_date", "date_key"),
    ("fact_lead", "created_date", "dim_date", "date_key"),
)

GOLD_KEYS: dict[str, str] = {
    "dim_date": "date_key", "dim_student": "student_id", "dim_customer": "customer_id",
    "dim_product": "product_id", "dim_course": "course_id", "dim_semester": "semester_id",
    "dim_account": "account_id", "fact_enrollment": "enrollment_id", "fact_invoice": "invoice_id",
    "fact_payment": "payment_id", "fact_subscription": "subscription_id",
    "fact_opportunity": "opportunity_id", "fact_activity": "activity_id", "fact_lead": "lead_id",
}

# Silver row rules: table, label, predicate that must hold where it is not NULL.
ROW_RULES: tuple[tuple[str, str, str], ...] = (
    ("university_semesters", "end_date >= start_date", "end_date >= start_date"),
    ("university_grades", "score in 0..100", "score between 0 and 100"),
    ("university_grades", "weight in 0..1", "weight between 0 and 1"),
    ("billing_products", "monthly_price >= 0", "monthly_price >= 0"),
    ("billing_invoice_items", "quantity > 0", "quantity > 0"),
    ("billing_invoice_items", "unit_price >= 0", "unit_price >= 0"),
    ("billing_payments", "amount > 0", "amount > 0"),
    ("crm_leads", "score in 0..100", "score between 0 and 100"),
    ("crm_opportunities", "amount > 0", "amount > 0"),
)

# Silver columns that may not be NULL, beside the primary keys.
REQUIRED: dict[str, tuple[str, ...]] = {
    "university_semesters": ("code", "year", "half", "start_date", "end_date"),
    "university_students": ("age_at_enrollment_lt_15",),
    "university_courses": ("department_mismatch",),
    "university_enrollments": (
        "status", "student_id", "course_id", "semester_id", "enrolled_at", "enrolled_at_out_of_window",
        "is_duplicate_enrollment", "is_duplicate_survivor", "has_grades"),
    "university_grades": ("assessment", "enrollment_id", "has_duplicate_assessment"),
    "enrollment_grade_summary": ("n_grades", "weight_sum", "weight_sum_ok"),
    "billing_products": ("active",),
    "billing_customers": ("is_student",),
    "billing_subscriptions": (
        "status", "customer_id", "product_id", "invalid_date_range", "is_effectively_expired",
        "active_sub_on_inactive_product"),
    "billing_invoices": (
        "customer_id", "is_total_mismatch", "has_no_items", "is_past_due", "paid_without_payment"),
    "billing_invoice_items": ("invoice_id", "product_id"),
    "billing_payments": ("invoice_id",),
    "crm_accounts": ("name_is_shared",),
    "crm_contacts": ("account_id", "is_duplicate_email"),
    "crm_leads": ("is_converted",),
    "crm_opportunities": ("account_id", "is_close_before_created", "is_closed", "is_won", "has_contacts"),
    "crm_opportunity_contacts": ("account_mismatch",),
    "crm_activities": ("is_orphan", "account_mismatch"),
}

# Currency a customer of each country is expected to be billed in.
COUNTRY_CURRENCY = {
    "CL": "CLP", "PE": "PEN", "AR": "ARS", "MX": "MXN", "BR": "BRL", "ES": "EUR", "CO": "COP", "US": "USD",
}
OPEN_STAGES = ("prospect", "qualification", "proposal", "negotiation")
CLOSED_STAGES = ("won", "lost")
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


@dataclass(frozen=True)
class SourceSpec:
    """One delimited source as a manifest declares it."""

    domain: str
    table: str
    columns: tuple[str, ...]
    expected_rows: int
    path: str
    #: Do quoted fields hold line breaks? If not, files are parsed in blocks, side by side. None: a load finds out.
    line_breaks: bool | None = None

    @property
    def name(self) -> str:
        return f"{self.domain}_{self.table}"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(column, T.StringType()) for column in self.columns])


def load_catalog(spark: SparkSession, manifest: str, raw_dir: str) -> list[SourceSpec]:
    """Read the manifest (one small JSON document) through Spark, so any file system works."""
    text = spark.read.text(manifest, wholetext=True).first()[0]
    return [
        SourceSpec(domain, table, tuple(entry["cols"]), int(entry["rows"]), f"{raw_dir}/{domain}/{table}.csv", entry.get("line_breaks"))
        for domain, tables in json.loads(text)["domains"].items()
        for table, entry in tables.items()
    ]


def primary_key(table: str) -> tuple[str, ...]:
    return SOURCES[table][0]


def columns_of(table: str, *kinds: str) -> Iterator[str]:
    """Columns of a source whose type starts with one of ``kinds`` (all columns without a kind)."""
    for column, kind in SOURCES[table][1].items():
        if not kinds or kind.startswith(kinds):
            yield column


DATE_KINDS = ("date", "timestamp")
NUMBER_KINDS = ("smallint", "int", "decimal")

"""Layer gates. Expected numbers are parameters; those of the published data set stand below."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.catalog import (
    FOREIGN_KEYS, GOLD_FOREIGN_KEYS, GOLD_KEYS, REQUIRED, ROW_RULES, SOURCES, SourceSpec, primary_key,
)
from strata.operators.digest import Digest, same
from strata.operators.quality import Check, null_counts, rule_violations, run_checks, union_all
from strata.operators.relations import fk_audit, key_check, label, orphans
from strata.plans.kpi import KPIS
from strata.sources.ledger import ROW_MARKS, visible

Tables = Mapping[str, DataFrame]

# Flag or condition per Silver table with the count published for the full data set (fixed values).
FLAGS: tuple[tuple[str, str, int], ...] = (
    ("university_students", "age_at_enrollment_lt_15", 636),
    ("university_courses", "department_mismatch", 264),
    ("university_enrollments", "enrolled_at_out_of_window", 22729),
    ("university_enrollments", "is_duplicate_enrollment", 46),
    ("university_enrollments", "is_duplicate_survivor", 24977),
    ("university_enrollments", "has_grades", 22786),
    ("university_grades", "has_duplicate_assessment", 22867),
    ("enrollment_grade_summary", "weight_sum_ok", 401),
    ("billing_customers", "is_student", 5000),
    ("billing_subscriptions", "invalid_date_range", 783),
    ("billing_subscriptions", "is_effectively_expired", 7146),
    ("billing_subscriptions", "active_sub_on_inactive_product", 1753),
    ("billing_invoices", "is_total_mismatch", 47497),
    ("billing_invoices", "has_no_items", 2502),
    ("billing_invoices", "paid_without_payment", 3533),
    ("billing_invoices", "payment_status_derived = 'overpaid'", 20482),
    ("billing_invoices", "payment_status_derived = 'partial'", 10943),
    ("billing_invoices", "payment_status_derived = 'full'", 8),
    ("billing_invoices", "payment_status_derived = 'unpaid'", 18567),
    ("crm_accounts", "name_is_shared", 5000),
    ("crm_contacts", "is_duplicate_email", 4),
    ("crm_leads", "is_converted", 205),
    ("crm_opportunities", "is_close_before_created", 1029),
    ("crm_opportunities", "is_won", 476),
    ("crm_opportunities", "has_contacts", 2586),
    ("crm_opportunity_contacts", "account_mismatch", 5995),
    ("crm_activities", "is_orphan", 2981),
    ("crm_activities", "account_mismatch", 7019),
)

GOLD_ROWS: dict[str, int] = {
    "dim_date": 8400, "dim_student": 5000, "dim_customer": 10000, "dim_product": 200, "dim_course": 300, "dim_semester": 8,
    "dim_account": 5000, "fact_enrollment": 24977, "fact_invoice": 50000, "fact_payment": 80000, "fact_subscription": 15000,
    "fact_opportunity": 3000, "fact_activity": 20000, "fact_lead": 2000,
}

# KPI, label, measure, published total.
KPI_TOTALS: tuple[tuple[str, str, str, int], ...] = (
    ("kpi_revenue_monthly", "invoices", "sum(invoices)", 50000),
    ("kpi_revenue_monthly", "currencies", "count(distinct currency)", 8),
    ("kpi_collection_by_currency", "paid invoices", "sum(paid_invoices)", 34966),
    ("kpi_academic_by_department", "enrollments", "sum(enrollments)", 24977),
    ("kpi_subscription_status", "active", "sum(subscriptions) filter (where status = 'active')", 11272),
    ("kpi_sales_pipeline", "won", "sum(opportunities) filter (where stage = 'won')", 476),
    ("kpi_sales_pipeline", "lost", "sum(opportunities) filter (where stage = 'lost')", 303),
    ("kpi_lead_funnel", "converted", "sum(leads) filter (where status = 'converted')", 205),
    ("kpi_student_vs_external", "invoices", "sum(invoices)", 50000),
)


def _n() -> Column:
    return F.count(F.lit(1))


def _count_of(frame: DataFrame) -> Column:
    return F.lit(frame.agg(_n()).scalar())


# ------------------------------------------------------------------ Bronze

STATUSES = ("loading", "success", "failed")


def check_ledger(state: DataFrame) -> DataFrame:
    """Rules of the ledger: one state per file version, known states, no negative counts."""
    version = ("source_domain", "source_table", "source_checksum")
    twice = state.groupBy(*version).agg(_n().alias("n"))
    return run_checks([
        Check("ledger", "versions with several states", twice, F.count_if(F.col("n") > 1), 0),
        Check("ledger", "unknown states", state, F.count_if(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))), 0),
        Check("ledger", "negative counts", state, F.count_if((F.col("expected_rows") < 0) | (F.col("loaded_rows") < 0)), 0),
    ])


def check_bronze(spec: SourceSpec, stored: DataFrame, ledger_state: DataFrame) -> DataFrame:
    """A loaded source against the ledger, in one pass over what is stored.

    The ledger holds the digests of row numbers and row hashes that were observed when the source was parsed; those of the batches that readers see add
    up to the digest of the stored rows, so a row that was lost, doubled or changed since shows without parsing the source again.
    """
    wanted = Digest.of(visible(ledger_state, spec).agg(
        F.coalesce(F.sum("loaded_rows"), F.lit(0)).alias("rows"), F.sum("first_digest").alias("first"), F.sum("second_digest").alias("second")).first().asDict())
    lineage = ("_batch_id", "_source_file", "_source_domain", "_source_row_number", "_row_hash", "_ingested_at")
    missing = F.lit(False)
    for column in lineage:
        missing = missing | F.col(column).isNull()
    mine = ledger_state.where((F.col("source_domain") == spec.domain) & (F.col("source_table") == spec.table))
    return run_checks([
        Check("bronze", f"{spec.name} rows", stored, _n(), spec.expected_rows),
        Check("bronze", f"{spec.name} distinct row numbers", stored, F.count_distinct("_source_row_number"), spec.expected_rows),
        Check("bronze", f"{spec.name} lineage blanks", stored, F.count_if(missing), 0),
        Check("bronze", f"{spec.name} differing content", stored, same(ROW_MARKS, wanted), 0),
        Check("bronze", f"{spec.name} successful batches", mine,
              F.count_if((F.col("status") == "success") & (F.col("loaded_rows") == F.col("expected_rows"))).cast("boolean")
              .cast("int"), 1),
        Check("bronze", f"{spec.name} failed batches", mine, F.count_if(F.col("status") == "failed"), 0),
    ])


# ------------------------------------------------------------------ Silver

def silver_rows(bronze: Tables, silver: Tables) -> DataFrame:
    """Silver keeps every Bronze row."""
    return run_checks([Check("rows", t, silver[t], _n(), _count_of(bronze[t])) for t in SOURCES])


def silver_flags(silver: Tables, expected: Mapping[tuple[str, str], int] | None = None) -> DataFrame:
    """Flag counts against expected numbers (those of the published data set by default)."""
    return run_checks([
        Check("flags", f"{t}.{flag}", silver[t], F.count_if(F.expr(flag)),
              published if expected is None else expected.get((t, flag), 0))
        for t, flag, published in FLAGS
    ])


def silver_derived(silver: Tables) -> DataFrame:
    """Derived columns agree with their flags."""
    missing = lambda c: F.count_if(F.col(c).isNull())
    invoices, subs = silver["billing_invoices"], silver["billing_subscriptions"]
    return run_checks([
        Check("derived", "invoices without total = without items", invoices, missing("total") - F.count_if("has_no_items"), 0),
        Check("derived", "invoices without payment band", invoices, missing("payment_status_derived"), 0),
        Check("derived", "subscriptions without end = inverted", subs, missing("end_date") - F.count_if("invalid_date_range"), 0),
        Check("derived", "summaries without weighted score", silver["enrollment_grade_summary"], missing("final_score_weighted"), 0),
        Check("derived", "scores outside 0..100", silver["university_grades"], F.count_if((F.col("score") < 0) | (F.col("score") > 100)), 0),
    ])


# ------------------------------------------------------------------ Gold

def gold_rows(gold: Tables, expected: Mapping[str, int | Column] = GOLD_ROWS) -> DataFrame:
    return run_checks([Check("rows", t, gold[t], _n(), e) for t, e in expected.items()])


# The five references the Gold gate watches.
GATED_REFERENCES = (
    ("fact_enrollment", "student_id"), ("fact_enrollment", "enrolled_date"), ("fact_invoice", "customer_id"),
    ("fact_subscription", "product_id"), ("fact_opportunity", "account_id"),
)


def gold_integrity(gold: Tables) -> DataFrame:
    """Fact rows whose reference has no dimension row; a missing reference counts as well."""
    gated = [r for r in GOLD_FOREIGN_KEYS if r[:2] in GATED_REFERENCES]
    found = orphans(gold, gated)
    return run_checks([
        Check("integrity", f"{r[0]}.{r[1]}", found, F.max(F.when(F.col("relation") == label(r), F.col("orphans") + F.col("blanks"))), 0) for r in gated])


def gold_consistency(silver: Tables, gold: Tables) -> DataFrame:
    survivors = silver["university_enrollments"].where("is_duplicate_survivor")
    return run_checks([
        Check("consistency", "fact_invoice rows", gold["fact_invoice"], _n(), _count_of(silver["billing_invoices"])),
        Check("consistency", "fact_payment rows", gold["fact_payment"], _n(), _count_of(silver["billing_payments"])),
        Check("consistency", "fact_enrollment rows", gold["fact_enrollment"], _n(), _count_of(survivors)),
        Check("consistency", "invoiced_amount blanks", gold["fact_invoice"], F.count_if(F.col("invoiced_amount").isNull()), 0),
    ])


def kpi_totals(gold: Tables, expected: Sequence[int | Column] | None = None) -> DataFrame:
    frames: dict[str, DataFrame] = {}
    checks = []
    for i, (name, label, measure, published) in enumerate(KPI_TOTALS):
        frame = frames.setdefault(name, KPIS[name](gold))
        checks.append(Check("kpi", f"{name}: {label}", frame, F.expr(measure), published if expected is None else expected[i]))
    return run_checks(checks)


# ------------------------------------------------------------------ Constraints as counted rules

def silver_keys(silver: Tables) -> DataFrame:
    tables = {**{t: primary_key(t) for t in SOURCES}, "enrollment_grade_summary": ("enrollment_id",)}
    return union_all(key_check(silver[t], keys, t) for t, keys in tables.items())


def gold_keys(gold: Tables) -> DataFrame:
    return union_all(key_check(gold[t], [key], t) for t, key in GOLD_KEYS.items())


def silver_references(silver: Tables) -> DataFrame:
    return orphans(silver, FOREIGN_KEYS).drop("blanks")


def gold_references(gold: Tables) -> DataFrame:
    return orphans(gold, GOLD_FOREIGN_KEYS).drop("blanks")


def silver_row_rules(silver: Tables) -> DataFrame:
    by_table: dict[str, list[tuple[str, Column]]] = {}
    for table, label, rule in ROW_RULES:
        by_table.setdefault(table, []).append((label, F.expr(rule)))
    return union_all(rule_violations(silver[t], rules, t) for t, rules in by_table.items())


def silver_required(silver: Tables) -> DataFrame:
    return union_all(null_counts(silver[t], columns, t) for t, columns in REQUIRED.items())


# Columns whose published precision is narrower than what a sum can reach.
PUBLISHED_TYPES = (
    ("enrollment_grade_summary", "n_grades", "smallint"), ("enrollment_grade_summary", "weight_sum", "decimal(6,3)"),
    ("billing_invoices", "total", "decimal(12,2)"),
)


def silver_overflow(silver: Tables) -> DataFrame:
    """Values that do not fit the published column type."""
    def lost(column: str, kind: str) -> Column:
        return F.count_if(F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull())

    return union_all(
        silver[t].agg(lost(c, k).alias("overflows")).select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "overflows")
        for t, c, k in PUBLISHED_TYPES)


def relationship_audit(typed: Tables) -> DataFrame:
    """Reference metrics of all foreign keys, from one count of all keys."""
    return fk_audit(typed, FOREIGN_KEYS)

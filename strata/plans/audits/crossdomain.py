"""Checks across the three domains and evidence of independence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.catalog import FOREIGN_KEYS
from strata.functions.dates import epoch_day, midnight
from strata.functions.money import pct, ratio
from strata.functions.text import normal_email, strip, trailing_number
from strata.operators.lookup import condense, lookup, weighted_if
from strata.operators.quality import union_all
from strata.operators.relations import fk_audit, label
from strata.operators.stats import pearson, share_match, spearman
from strata.plans.audits.billing import _n, _with_scalars
from strata.plans.audits.crm import bridge
from strata.plans.audits.university import Tables, course_departments
from strata.session import stage

# Relations whose empty parents are compared with uniform assignment.
OCCUPANCY = (
    ("university_grades", "enrollment_id"), ("billing_subscriptions", "customer_id"), ("billing_invoices", "customer_id"),
    ("billing_invoice_items", "invoice_id"), ("crm_contacts", "account_id"), ("crm_opportunities", "account_id"),
)
PEOPLE = (
    ("students", "university_students"), ("professors", "university_professors"), ("customers", "billing_customers"),
    ("contacts", "crm_contacts"), ("leads", "crm_leads"),
)


def linked(t: Tables) -> DataFrame:
    """Customers with the student they refer to; both sides' attributes."""
    students = t["university_students"]
    take = {c: (c if c == "student_id" else f"student_{c}") for c in students.columns}
    return lookup(t["billing_customers"].where("external_ref is not null"), students, [("external_ref", "student_id")], take,
                  "inner", ["customer_id"])


def link_counts(t: Tables, as_of: str) -> DataFrame:
    refs = t["billing_customers"].where("external_ref is not null").groupBy("external_ref").agg(_n().alias("n"))
    known = refs.join(t["university_students"].select(F.col("student_id").alias("external_ref")), "external_ref", "left_semi")
    return _with_scalars(
        refs.agg(F.count(F.lit(1)).alias("unique_references"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_references")),
        known.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("linked_pairs")))


def link_identity(t: Tables, as_of: str) -> DataFrame:
    pairs = linked(t)
    same = lambda a, b: F.lower(strip(F.col(a))) == F.lower(strip(F.col(b)))
    expected = share_match(pairs, "country", pairs, "student_country")
    country = F.count_if(F.col("country") == F.col("student_country"))
    return pairs.agg(
        _n().alias("linked_pairs"), F.count_if(same("email", "student_email")).alias("same_email"),
        F.count_if(same("first_name", "student_first_name") & same("last_name", "student_last_name")).alias("same_full_name"),
        country.alias("same_country"), pct(country, _n()).alias("same_country_pct"),
    ).select("*", F.round(F.col("linked_pairs") * F.lit(expected.scalar()), 2).alias("expected_same_country"))


def link_dates(t: Tables, as_of: str) -> DataFrame:
    made, registered = F.col("created_at"), midnight(F.col("student_enrolled_at"))
    return linked(t).agg(
        F.count_if(made < registered).alias("created_before_registration"),
        F.count_if(made > registered).alias("created_after_registration"),
        pearson(epoch_day(made), epoch_day(F.col("student_enrolled_at"))).alias("date_pearson"))


def link_numbers(t: Tables, as_of: str) -> DataFrame:
    pairs = linked(t).select(trailing_number(F.col("customer_id")).alias("c"), trailing_number(F.col("student_id")).alias("s"))
    return _with_scalars(pairs.agg(F.count_if(F.col("c") == F.col("s")).alias("exact_match")), spearman(pairs, "c", "s"))


def linked_activity_chronology(t: Tables, as_of: str) -> DataFrame:
    who = linked(t).select("customer_id", "student_enrolled_at")
    registered = F.col("student_enrolled_at")

    def early(events: DataFrame, at: str, name: str) -> DataFrame:
        rows = events.join(who, "customer_id")
        return rows.agg(weighted_if(F.col(at) < registered).alias(f"{name}_before_registration"),
                        F.coalesce(F.sum("n"), F.lit(0)).alias(f"linked_{name}"))

    payments = condense(t["billing_payments"], ["invoice_id", "paid_at"]).join(
        t["billing_invoices"].select("invoice_id", "customer_id"), "invoice_id").groupBy("customer_id", "paid_at").agg(
        F.sum("n").alias("n"))
    first = early(condense(t["billing_subscriptions"], ["customer_id", "start_date"]), "start_date", "subscriptions")
    first = _with_scalars(first, early(condense(t["billing_invoices"], ["customer_id", "issued_at"]), "issued_at", "invoices"))
    return _with_scalars(first, early(payments, "paid_at", "payments"))


def _counts(t: Tables) -> DataFrame:
    """Customers with their numbers of invoices and subscriptions, zero where there are none."""
    invoices = t["billing_invoices"].groupBy("customer_id").agg(_n().alias("invoice_count"))
    contracts = t["billing_subscriptions"].groupBy("customer_id").agg(_n().alias("subscription_count"))
    return t["billing_customers"].join(invoices, "customer_id", "left").join(contracts, "customer_id", "left").na.fill(
        0, ["invoice_count", "subscription_count"])


def score_against_billing(t: Tables, as_of: str) -> DataFrame:
    points = t["university_grades"].groupBy("enrollment_id").agg(
        ratio(F.sum(F.col("score") * F.col("weight")), F.sum("weight"), 16).alias("score"))
    students = t["university_enrollments"].select("enrollment_id", "student_id").join(points, "enrollment_id", "left").groupBy(
        "student_id").agg(ratio(F.sum("score"), F.count("score"), 13, scale=16).cast("decimal(18,13)").alias("mean_score"))
    refs = t["university_students"].select("student_id")
    rows = _counts(t).join(refs, F.col("external_ref") == F.col("student_id")).drop("student_id").join(
        students, F.col("external_ref") == F.col("student_id"), "left")
    rows = stage(rows.groupBy("mean_score", "invoice_count", "subscription_count").agg(_n().alias("n")))
    return _with_scalars(
        spearman(rows, "mean_score", "invoice_count", "score_vs_invoices", weight="n"),
        spearman(rows, "mean_score", "subscription_count", "score_vs_subscriptions", weight="n"))


def linked_behaviour(t: Tables, as_of: str) -> DataFrame:
    payers = t["billing_payments"].select("invoice_id").distinct().join(
        t["billing_invoices"].select("invoice_id", "customer_id"), "invoice_id").select(
        "customer_id", F.lit(True).alias("pays")).distinct()
    rows = _counts(t).join(payers, "customer_id", "left")
    label = F.when(F.col("external_ref").isNotNull(), "student_reference").otherwise("no_student_reference")
    mean = lambda c: F.round(F.sum(c).cast("double") / _n(), 3)
    return rows.groupBy(label.alias("link")).agg(
        _n().alias("customers"), mean("invoice_count").alias("mean_invoices"), mean("subscription_count").alias("mean_subscriptions"),
        F.count_if(F.col("invoice_count") == 0).alias("without_invoice"),
        F.count_if(F.col("subscription_count") == 0).alias("without_subscription"),
        F.count_if(F.col("pays")).alias("with_payment"))


def email_overlaps(t: Tables, as_of: str) -> DataFrame:
    """Shared addresses of every two groups of people.

    Each address becomes one bit set of the groups it occurs in; counting the at most 31 bit sets gives
    all ten pairs from one shuffle and no pairing of rows.
    """
    rows = union_all(
        t[table].select(normal_email(F.col("email")).alias("e"), F.lit(1 << i).alias("bit")).where("e is not null")
        for i, (_, table) in enumerate(PEOPLE))
    sets = rows.groupBy("e").agg(F.bit_or("bit").alias("groups")).groupBy("groups").agg(_n().alias("n"))
    entries = []
    for i, (a, _) in enumerate(PEOPLE):
        for j, (b, _) in list(enumerate(PEOPLE))[i + 1:]:
            mask = (1 << i) | (1 << j)
            entries.append(F.struct(F.lit(f"{a}<->{b}").alias("pair"),
                                    weighted_if(F.col("groups").bitwiseAND(mask) == mask).alias("shared")))
    return sets.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def converted_leads_known(t: Tables, as_of: str) -> DataFrame:
    won = t["crm_leads"].where("status = 'converted'")
    known = union_all(t[x].select(F.lower("email").alias("e")) for x in ("university_students", "billing_customers", "crm_contacts"))
    hits = won.select(F.lower("email").alias("e")).distinct().join(known, "e", "left_semi")
    return _with_scalars(won.agg(_n().alias("converted_leads")), hits.agg(_n().alias("known_addresses")))


def occupancy(t: Tables, as_of: str, references: DataFrame | None = None) -> DataFrame:
    """``references``: the reference audit of all relations, if there is one already; its rows do not depend on each other."""
    wanted = [r for r in FOREIGN_KEYS if r[:2] in OCCUPANCY]
    found = fk_audit(t, wanted) if references is None else references.where(F.col("relation").isin([label(r) for r in wanted]))
    return found.select(
        "relation", "unreferenced_parents", "expected_unreferenced", "observed_minus_expected")


def activity_missingness(t: Tables, as_of: str) -> DataFrame:
    c, o = F.col("contact_id").isNull(), F.col("opportunity_id").isNull()
    m = t["crm_activities"].agg(
        _n().alias("n"), F.count_if(c).alias("c"), F.count_if(o).alias("o"), F.count_if(c & o).alias("observed_both_null"))
    expected = F.col("c").cast("double") * F.col("o") / F.col("n")
    return m.select(
        F.round(F.col("c") * 100.0 / F.col("n"), 3).cast("double").alias("null_contact_pct"),
        F.round(F.col("o") * 100.0 / F.col("n"), 3).cast("double").alias("null_opportunity_pct"),
        "observed_both_null", F.round(expected, 2).alias("expected_both_null"),
        F.round(F.col("observed_both_null") - expected, 2).alias("difference"))


def match_evidence(t: Tables, as_of: str) -> DataFrame:
    """Observed agreement beside the agreement expected from independent columns."""
    pair = lambda name, a, b: (F.lit(name).alias("evidence"), a.cast("double").alias("observed"),
                               b.cast("double").alias("expected"))
    return union_all((
        course_departments(t, as_of).select(*pair(
            "department_pct", pct(F.col("same_department"), F.col("total_courses")), F.col("expected_same_pct"))),
        bridge(t, as_of).select(*pair("bridge_account", F.col("same_account"), F.col("expected_same_account"))),
        link_identity(t, as_of).select(*pair("link_country", F.col("same_country"), F.col("expected_same_country"))),
    ))


AUDITS: dict[str, Callable[[Tables, str], DataFrame]] = {
    "xdm_link_counts": link_counts,
    "xdm_link_identity": link_identity,
    "xdm_link_dates": link_dates,
    "xdm_link_numbers": link_numbers,
    "xdm_linked_activity_chronology": linked_activity_chronology,
    "xdm_score_against_billing": score_against_billing,
    "xdm_linked_behaviour": linked_behaviour,
    "xdm_email_overlaps": email_overlaps,
    "xdm_converted_leads_known": converted_leads_known,
    "evi_occupancy": occupancy,
    "evi_activity_missingness": activity_missingness,
    "evi_matches": match_evidence,
}

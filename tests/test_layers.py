"""Silver and Gold on literal boundary rows, with the expected flag beside each row."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from probes.bindings import TestTables, bronze
from strata.catalog import SOURCES
from strata.functions.money import ratio
from strata.plans import kpi, silver as sv
from strata.plans.audits import billing
from strata.plans.gold import date_span, dim_account, fact_enrollment, gold
from strata.plans.insights import INSIGHTS, Model
from strata.plans.layer import Layer
from strata.plans.silver import silver
from strata.plans.typed import issues, typed


def source(spark, name, *rows):
    """Bronze rows: all text, as the loader writes them."""
    columns = list(SOURCES[name][1])
    return spark.createDataFrame([tuple(str(v) for v in r) for r in rows] or [], ", ".join(f"{c} string" for c in columns))


def column(df, key, name):
    return {r[key]: r[name] for r in df.collect()}


def test_student_age(spark):
    start = dt.date(2000, 1, 1)
    rows = [(i, "A", "B", "A.B@X.org", start, start + dt.timedelta(days=d), "CL")
            for i, d in (("young", 5478), ("fifteen", 5479), ("inverted", -3), ("old", 9000))]
    df = sv.students(source(spark, "university_students", *rows))
    assert column(df, "student_id", "age_at_enrollment_lt_15") == {"young": True, "fifteen": False, "inverted": True, "old": False}
    assert column(df, "student_id", "email")["old"] == "a.b@x.org"


def test_course_department(spark):
    professors = source(spark, "university_professors", ("p1", "", "", "", "cs", ""), ("p2", "", "", "", "law", "2010-01-05"))
    courses = source(spark, "university_courses", ("same", "", "", 3, "cs", "p1"), ("other", "", "", 3, "cs", "p2"), ("none", "", "", 3, "cs", "p9"))
    df = sv.courses(courses, professors)
    assert column(df, "course_id", "department_mismatch") == {"same": False, "other": True, "none": False}
    hired = column(silver({"university_professors": professors})["university_professors"], "professor_id", "hired_at")
    assert hired == {"p1": None, "p2": dt.date(2010, 1, 5)}


def test_enrollments(spark):
    semesters = source(spark, "university_semesters", ("s", "2024-1", 2024, 1, "2024-03-01", "2024-07-15"))
    rows = [
        ("e1", "2024-03-01", "dropped", "st", "c1", "s"), ("e2", "2024-07-15", "completed", "st", "c1", "s"),
        ("e3", "2024-02-29", "completed", "st", "c1", "s"), ("e4", "2024-07-16", "odd", "st", "c2", "s"),
    ]
    grades = source(spark, "university_grades", ("g", "final", 50, 1, "2024-05-01", "e2"))
    df = sv.enrollments(source(spark, "university_enrollments", *rows), semesters, grades)
    assert column(df, "enrollment_id", "enrolled_at_out_of_window") == {"e1": False, "e2": False, "e3": True, "e4": True}
    assert column(df, "enrollment_id", "is_duplicate_enrollment") == {"e1": True, "e2": True, "e3": True, "e4": False}
    assert column(df, "enrollment_id", "is_duplicate_survivor") == {"e1": False, "e2": True, "e3": False, "e4": True}
    assert column(df, "enrollment_id", "has_grades") == {"e1": False, "e2": True, "e3": False, "e4": False}
    first = df.where("enrollment_id = 'e3'").first()
    assert (first.enrolled_at, first.enrolled_at_raw) == (dt.date(2024, 3, 1), dt.date(2024, 2, 29))


def test_grades(spark):
    def weights(enrollment, *values):
        return [(f"{enrollment}{i}", a, 60, w, "2024-05-01", enrollment) for i, (a, w) in enumerate(values)]

    rows = (weights("low", ("a", "0.5"), ("b", "0.489")) + weights("edge", ("a", "0.5"), ("a", "0.49"))
            + weights("high", ("a", "1"), ("b", "0.01")) + weights("over", ("a", "1"), ("b", "0.011")) + weights("zero", ("a", "0")))
    raw = source(spark, "university_grades", *rows)
    summary = sv.grade_summary(raw)
    assert column(summary, "enrollment_id", "weight_sum_ok") == {"low": False, "edge": True, "high": True, "over": False, "zero": False}
    scores = column(summary, "enrollment_id", "final_score_weighted")
    assert scores["zero"] is None and float(scores["edge"]) == 60.0
    assert sum(column(sv.grades(raw), "grade_id", "has_duplicate_assessment").values()) == 2


def test_scores_are_rounded_once_from_the_source_numbers(spark):
    """Quotients at the edge of a rounding: the denominator keeps its decimals, nothing between is rounded."""
    cases = {"thirds": [("60", "0.33333")] * 3, "below": [("59.9994996", "1")], "prime": [("61.13949", "0.5"), ("61.13949", "0.519")],
             "tie": [("59.9995", "1")], "fine": [("99.999999", "0.000001"), ("0", "0.000002")], "minus": [("-59.9995", "1")]}
    rows = [(f"{e}{i}", "a", s, w, "2024-05-01", e) for e, pairs in cases.items() for i, (s, w) in enumerate(pairs)]
    got = column(sv.grade_summary(source(spark, "university_grades", *rows)), "enrollment_id", "final_score_weighted")
    exact = {}
    for e, pairs in cases.items():
        value = sum(Fraction(s) * Fraction(w) for s, w in pairs) / sum(Fraction(w) for _, w in pairs)
        exact[e] = Decimal(math.floor(abs(value) * 1000 + Fraction(1, 2)) * (-1 if value < 0 else 1)).scaleb(-3)
    assert got == exact and exact["thirds"] == 60 and exact["below"] == Decimal("59.999") and exact["tie"] == 60


def test_ratio_against_fractions(spark):
    r = random.Random(9)
    pairs = [(Decimal(r.randint(-10**k, 10**k)).scaleb(-r.randint(0, 10)), Decimal(r.randint(-10**j, 10**j)).scaleb(-r.randint(0, 10)))
             for k in (2, 9, 17) for j in (1, 6, 14) for _ in range(60)]
    pairs = [(a, b) for a, b in pairs if not b or abs(a / b) < 10**16]
    df = spark.createDataFrame(pairs, "a decimal(28,10), b decimal(28,10)")
    for digits, times in ((0, 1), (3, 1), (1, 100)):
        for a, b, q in df.select("a", "b", ratio(F.col("a"), F.col("b"), digits, times=times).alias("q")).collect():
            exact = Fraction(a) * times / Fraction(b) if b else None
            want = None if exact is None else math.floor(abs(exact) * 10**digits + Fraction(1, 2)) * (-1 if exact < 0 else 1)
            assert (None if q is None else int(q.scaleb(digits))) == want, (a, b, q)


def test_pass_mark(spark):
    enrollments = spark.createDataFrame(
        [(x, "s", "c", "m", dt.date(2024, 1, 1), "completed", x != "none", True) for x in ("below", "exact", "none")],
        "enrollment_id string, student_id string, course_id string, semester_id string, enrolled_at date, status string, "
        "has_grades boolean, is_duplicate_survivor boolean")
    summary = spark.createDataFrame([("below", "59.999", True), ("exact", "60.000", True)],
                                    "enrollment_id string, s string, weight_sum_ok boolean").select(
        "enrollment_id", F.col("s").cast("decimal(6,3)").alias("final_score_weighted"), "weight_sum_ok")
    assert column(fact_enrollment(enrollments, summary), "enrollment_id", "passed") == {"below": False, "exact": True, "none": None}


def test_subscriptions(spark):
    products = source(spark, "billing_products", ("on", "", "", "", 1, "True"), ("off", "", "", "", 1, "False"))
    rows = [
        ("inverted", "active", "2024-02-01", "2024-01-31", "c", "on"), ("same", "active", "2024-02-01", "2024-02-01", "c", "on"),
        ("cutoff", "active", "2024-02-01", "2026-07-20", "c", "off"), ("paused", "paused", "2024-02-01", "2024-03-01", "c", "off"),
    ]
    df = sv.subscriptions(source(spark, "billing_subscriptions", *rows), products, "2026-07-20")
    assert column(df, "subscription_id", "invalid_date_range") == {"inverted": True, "same": False, "cutoff": False, "paused": False}
    assert column(df, "subscription_id", "is_effectively_expired") == {"inverted": True, "same": True, "cutoff": False, "paused": False}
    assert column(df, "subscription_id", "active_sub_on_inactive_product") == {"inverted": False, "same": False, "cutoff": True, "paused": False}
    row = df.where("subscription_id = 'inverted'").first()
    assert (row.end_date, row.end_date_raw) == (None, dt.date(2024, 1, 31))


def test_invoices(spark):
    rows = [(i, "2024-01-01", "2026-07-19", "100.00", s, "USD", "c") for i, s in (
        ("cent", "paid"), ("two", "paid"), ("bare", "pending"), ("over", "overdue"))]
    items = source(spark, "billing_invoice_items", ("i1", 1, 1, "60.00", "cent", "p"), ("i2", 1, 1, "40.01", "cent", "p"),
                   ("i3", 1, 1, "99.98", "two", "p"), ("i4", 1, 1, "100.00", "over", "p"))
    payments = source(spark, "billing_payments", ("p1", "99.99", "2024-01-02", "card", "cent"), ("p2", "100.02", "2024-01-02", "card", "over"),
                      ("p3", "99.98", "2024-01-02", "card", "bare"))
    df = sv.invoices(source(spark, "billing_invoices", *rows), items, payments, "2026-07-20")
    assert column(df, "invoice_id", "is_total_mismatch") == {"cent": False, "two": True, "bare": False, "over": False}
    assert column(df, "invoice_id", "has_no_items") == {"cent": False, "two": False, "bare": True, "over": False}
    assert column(df, "invoice_id", "payment_status_derived") == {"cent": "full", "two": "unpaid", "bare": "partial", "over": "overpaid"}
    assert column(df, "invoice_id", "paid_without_payment") == {"cent": False, "two": True, "bare": False, "over": False}
    assert column(df, "invoice_id", "is_past_due") == {"cent": False, "two": False, "bare": True, "over": True}
    assert column(df, "invoice_id", "total")["bare"] is None


def test_crm_flags(spark):
    accounts = source(spark, "crm_accounts", *[(i, n, "", "", 1, e, "2024-01-01") for i, n, e in (
        ("a", "Acme", 49), ("b", "Acme", 50), ("c", "Solo", 500), ("d", "Duo", 501))])
    df = sv.accounts(accounts)
    assert column(df, "account_id", "name_is_shared") == {"a": True, "b": True, "c": False, "d": False}
    assert column(dim_account(df), "account_id", "employee_band") == {"a": "small", "b": "mid", "c": "mid", "d": "large"}
    blank = df.where("account_id = 'a'").withColumn("employees", F.lit(None).cast("int"))
    assert dim_account(blank).first().employee_band == "large"

    contacts = source(spark, "crm_contacts", *[(i, "", "", m, "", "", "2024-01-01", a) for i, m, a in (
        ("x", "Eva@x.org", "a"), ("y", "eva@X.org", "b"), ("z", "z@x.org", "b"))])
    assert column(sv.contacts(contacts), "contact_id", "is_duplicate_email") == {"x": True, "y": True, "z": False}

    deals = source(spark, "crm_opportunities", *[(i, "", s, 5, c, "2024-05-02 13:00:00", "a") for i, s, c in (
        ("same", "won", "2024-05-02"), ("before", "lost", "2024-05-01"), ("open", "proposal", "2024-06-01"))])
    bridge = source(spark, "crm_opportunity_contacts", ("same", "x", "r"), ("same", "y", "r"))
    df = sv.opportunities(deals, bridge)
    assert column(df, "opportunity_id", "is_close_before_created") == {"same": False, "before": True, "open": False}
    assert column(df, "opportunity_id", "is_closed") == {"same": True, "before": True, "open": False}
    assert column(df, "opportunity_id", "has_contacts") == {"same": True, "before": False, "open": False}
    assert column(sv.opportunity_contacts(bridge, deals, contacts), "contact_id", "account_mismatch") == {"x": False, "y": True}

    activities = source(spark, "crm_activities", *[(i, "", "", "2024-01-01", c, o) for i, c, o in (
        ("none", "", ""), ("one", "x", ""), ("same", "x", "same"), ("other", "y", "same"))])
    df = sv.activities(activities, deals, contacts)
    assert column(df, "activity_id", "is_orphan") == {"none": True, "one": False, "same": False, "other": False}
    assert column(df, "activity_id", "account_mismatch") == {"none": False, "one": False, "same": False, "other": True}


def test_strict_casts_raise_and_audits_count(spark):
    raw = source(spark, "university_semesters", ("s", "c", "x", 1, "2024-01-01", "2024-13-01"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver({"university_semesters": raw})["university_semesters"].collect()
    empty = {t: source(spark, t) for t in SOURCES}
    frames = {**empty, "university_semesters": raw}
    row = typed(frames)["university_semesters"].first()
    assert (row.year, row.half, row.end_date) == (None, 1, None)
    counted = {(r.table_name, r.column_name): r.unparsed for r in issues(frames).collect()}
    assert counted[("university_semesters", "year")] == 1 and counted[("university_semesters", "end_date")] == 1
    assert sum(counted.values()) == 2


def test_reports_on_empty_sources(spark):
    """No report fails on empty tables."""
    frames = silver({t: source(spark, t) for t in SOURCES})
    g = gold(frames, date_span(spark))
    for name, build in {**kpi.KPIS, **kpi.CHARTS}.items():
        build(g).collect(), name
    model = Model(frames, g, "2026-07-20")
    for name in ("ins_revenue_measures", "ins_discontinued_mrr", "ins_sales_cycle", "ins_top_product", "ins_main_currencies"):
        INSIGHTS[name](model).collect()


def test_all_lines_are_payments_and_contacts(spark):
    tables = TestTables(spark, "/root/testdata/sf0.001")
    found, lines = bronze(tables), tables["lineitem"]
    paid = found["billing_payments"]
    assert paid.count() == lines.count()
    assert paid.agg(F.sum("amount")).first() == lines.agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)"))).first()
    met = F.when(F.col("l_partkey") % 10 == 7, F.col("l_partkey") - 1).otherwise(F.col("l_partkey")).cast("string")
    pairs = lines.select(met, F.col("l_suppkey").cast("string")).distinct()
    contacts = found["crm_opportunity_contacts"].select("opportunity_id", "contact_id")
    assert contacts.count() == pairs.count() and pairs.exceptAll(contacts).isEmpty()
    for owners, key, links in (("billing_invoices", "invoice_id", paid), ("crm_opportunities", "opportunity_id", contacts)):
        with_some = found[owners].join(links, key, "left_semi").count()
        assert 0 < with_some < found[owners].count()
        assert links.join(found[owners], key, "left_anti").isEmpty()


def test_payments_by_currency_joins_payments_once(spark):
    invoices = spark.createDataFrame([("a", "CLP"), ("b", "USD"), ("c", None)], "invoice_id string, currency string")
    payments = spark.range(4321).selectExpr("id as payment_id", "case id % 4 when 0 then 'a' when 1 then 'b' when 2 then 'c' else 'none' end as invoice_id",
                                            "cast(case when id < 400 then null else id % 10 end as decimal(12,2)) as amount")
    got = billing.payments_by_currency(Layer({"billing_invoices": lambda: invoices, "billing_payments": lambda: payments}), "1999-01-01")
    ids = range(4321)
    assert {r.currency: (r.payments, r.median_amount) for r in got.collect()} == {
        c: (len(ids[k::4]), statistics.median(i % 10 for i in ids[k::4] if i >= 400)) for k, c in ((0, "CLP"), (1, "USD"))}
    assert "4321" not in got._jdf.queryExecution().optimizedPlan().toString()  # nothing is left that reads the payments again

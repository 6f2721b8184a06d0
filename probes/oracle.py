"""Independent SQL for the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from probes.bindings import AS_OF, SOURCES, ctes

ORACLE: dict[str, str] = {}


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """Quotient of whole numbers rounded half away from zero, in exact integer arithmetic."""
    scale = 10 ** digits
    n, d = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)"
    return (f"cast(case when ({d}) = 0 then null when ({n}) < 0 then -((2 * {scale} * -({n}) + ({d})) // (2 * ({d}))) "
            f"else (2 * {scale} * ({n}) + ({d})) // (2 * ({d})) end as double) / {scale}")


def share(part: str, whole: str, digits: int = 1) -> str:
    """Percentage rounded half up."""
    return half_up(f"100 * ({part})", whole, digits)


def mean(decimal_column: str, digits: int, scale: int = 2) -> str:
    """Rounded mean of a decimal column."""
    unit = 10 ** scale
    return half_up(f"sum(cast({decimal_column} * {unit} as hugeint))", f"count({decimal_column}) * {unit}", digits)


RAW = ctes()

SILVER = f"""
s_university_semesters as (select * from university_semesters),
s_university_professors as (
  select * replace (lower(email) as email, cast(nullif(hired_at, '') as date) as hired_at) from university_professors),
s_university_students as (
  select * replace (lower(email) as email),
         coalesce((enrolled_at - birth_date) * 100 < 15 * 36525, false) as age_at_enrollment_lt_15
  from university_students),
s_university_courses as (
  select c.*, coalesce(c.department <> p.department, false) as department_mismatch
  from university_courses c left join university_professors p using (professor_id)),
s_university_enrollments as (
  select e.enrollment_id, e.status, e.student_id, e.course_id, e.semester_id, e.enrolled_at as enrolled_at_raw,
         s.start_date as enrolled_at,
         coalesce(not (e.enrolled_at between s.start_date and s.end_date), false) as enrolled_at_out_of_window,
         count(*) over (partition by student_id, course_id, semester_id) > 1 as is_duplicate_enrollment,
         row_number() over (partition by student_id, course_id, semester_id order by
           coalesce(list_position(['completed', 'failed', 'dropped', 'active'], e.status), 5), enrollment_id) = 1
           as is_duplicate_survivor,
         e.enrollment_id in (select enrollment_id from university_grades) as has_grades
  from university_enrollments e left join university_semesters s using (semester_id)),
s_university_grades as (
  select *, count(*) over (partition by enrollment_id, assessment) > 1 as has_duplicate_assessment
  from university_grades),
g_sums as (
  select enrollment_id, count(*) as n, sum(cast(weight * 1000 as bigint)) as w,
         sum(cast(score * 100 as bigint) * cast(weight * 1000 as bigint)) as p, sum(cast(score * 100 as bigint)) as s
  from university_grades group by 1),
s_enrollment_grade_summary as (
  select enrollment_id, cast(n as bigint) as n_grades, cast(w as double) / 1000 as weight_sum,
         abs(w - 1000) <= 10 as weight_sum_ok,
         {half_up('p', 'w * 100', 3)} as final_score_weighted, {half_up('s', 'n * 100', 3)} as final_score_simple
  from g_sums),
s_billing_products as (select * replace (active = 'True' as active) from billing_products),
s_billing_customers as (
  select * replace (lower(email) as email, nullif(external_ref, '') as external_ref), external_ref <> '' as is_student
  from billing_customers),
s_billing_subscriptions as (
  select subscription_id, status, start_date, case when end_date < start_date then null else end_date end as end_date,
         end_date as end_date_raw, customer_id, product_id, end_date < start_date as invalid_date_range,
         status = 'active' and end_date < date '{AS_OF}' as is_effectively_expired,
         coalesce(status = 'active' and active = 'False', false) as active_sub_on_inactive_product
  from billing_subscriptions left join billing_products using (product_id)),
s_billing_invoices as (
  select i.invoice_id, i.issued_at, i.due_at, i.total as total_reported, t.v as total, i.status, i.currency, i.customer_id,
         coalesce(abs(i.total - t.v) > 0.01, false) as is_total_mismatch, t.invoice_id is null as has_no_items,
         i.due_at < date '{AS_OF}' and i.status <> 'paid' as is_past_due,
         i.status = 'paid' and p.invoice_id is null as paid_without_payment,
         case when p.v is null then 'unpaid' when p.v > i.total + 0.01 then 'overpaid'
              when p.v < i.total - 0.01 then 'partial' else 'full' end as payment_status_derived
  from billing_invoices i
  left join (select invoice_id, sum(line_total) as v from billing_invoice_items group by 1) t using (invoice_id)
  left join (select invoice_id, sum(amount) as v from billing_payments group by 1) p using (invoice_id)),
s_billing_invoice_items as (select * from billing_invoice_items),
s_billing_payments as (select * from billing_payments),
s_crm_accounts as (select *, count(*) over (partition by name) > 1 as name_is_shared from crm_accounts),
s_crm_contacts as (
  select * replace (lower(email) as email), count(*) over (partition by lower(email)) > 1 as is_duplicate_email
  from crm_contacts),
s_crm_leads as (select * replace (lower(email) as email), status = 'converted' as is_converted from crm_leads),
s_crm_opportunities as (
  select *, close_date < cast(created_at as date) as is_close_before_created, stage in ('won', 'lost') as is_closed,
         stage = 'won' as is_won,
         opportunity_id in (select opportunity_id from crm_opportunity_contacts) as has_contacts
  from crm_opportunities),
s_crm_opportunity_contacts as (
  select b.*, coalesce(o.account_id <> c.account_id, false) as account_mismatch
  from crm_opportunity_contacts b left join crm_opportunities o using (opportunity_id)
  left join crm_contacts c using (contact_id)),
s_crm_activities as (
  select a.activity_id, a.type, a.subject, a.occurred_at, nullif(a.contact_id, '') as contact_id,
         nullif(a.opportunity_id, '') as opportunity_id, a.contact_id = '' and a.opportunity_id = '' as is_orphan,
         coalesce(c.account_id <> o.account_id, false) as account_mismatch
  from crm_activities a left join crm_contacts c using (contact_id)
  left join crm_opportunities o using (opportunity_id))"""

GOLD = """
dim_date as (
  select cast(d as date) as date_key, year(d) as year, quarter(d) as quarter, month(d) as month, monthname(d) as month_name,
         day(d) as day, isodow(d) as day_of_week, isodow(d) in (6, 7) as is_weekend
  from (select unnest(generate_series(make_date(year(a) - 1, 1, 1), make_date(year(b) + 1, 12, 31), interval 1 day)) as d
        from (select min(o_orderdate) as a, max(o_orderdate) as b from orders) r) t),
dim_student as (select student_id, country, birth_date, enrolled_at, age_at_enrollment_lt_15 from s_university_students),
dim_customer as (
  select customer_id, is_student, external_ref as student_id, segment, country, cast(cast(created_at as timestamp) as date) as created_date
  from s_billing_customers),
dim_product as (select * from s_billing_products),
dim_course as (
  select course_id, code, name, credits, department, professor_id, department_mismatch from s_university_courses),
dim_semester as (select * from s_university_semesters),
dim_account as (
  select account_id, name, industry, country, annual_revenue, employees,
         case when employees < 50 then 'small' when employees <= 500 then 'mid' else 'large' end as employee_band,
         name_is_shared
  from s_crm_accounts),
fact_enrollment as (
  select e.enrollment_id, e.student_id, e.course_id, e.semester_id, e.enrolled_at as enrolled_date, e.status, e.has_grades,
         g.final_score_weighted as final_score, g.weight_sum_ok, g.final_score_weighted >= 60 as passed
  from s_university_enrollments e left join s_enrollment_grade_summary g using (enrollment_id)
  where e.is_duplicate_survivor),
fact_invoice as (
  select invoice_id, customer_id, issued_at as issued_date, due_at as due_date, currency,
         coalesce(total, total_reported) as invoiced_amount, total_reported, status, payment_status_derived, has_no_items,
         is_total_mismatch
  from s_billing_invoices),
fact_payment as (
  select p.payment_id, p.invoice_id, i.customer_id, p.paid_at as paid_date, p.amount, p.method
  from s_billing_payments p join s_billing_invoices i using (invoice_id)),
fact_subscription as (
  select s.subscription_id, s.customer_id, s.product_id, s.status, s.start_date, s.end_date, s.is_effectively_expired,
         s.invalid_date_range, p.monthly_price
  from s_billing_subscriptions s join s_billing_products p using (product_id)),
fact_opportunity as (
  select opportunity_id, account_id, stage, amount, cast(cast(created_at as timestamp) as date) as created_date, close_date,
         is_won, is_closed, is_close_before_created
  from s_crm_opportunities),
fact_activity as (
  select activity_id, type, cast(occurred_at as date) as occurred_date, contact_id, opportunity_id, is_orphan, account_mismatch
  from s_crm_activities),
fact_lead as (
  select lead_id, source, status, score, cast(cast(created_at as timestamp) as date) as created_date, is_converted
  from s_crm_leads)"""

KPI = f"""
kpi_revenue_monthly as (
  select cast(date_trunc('month', issued_date) as date) as month, currency, count(*) as invoices,
         cast(sum(invoiced_amount) as double) as revenue, {mean('invoiced_amount', 2)} as avg_ticket
  from fact_invoice group by 1, 2),
kpi_collection_by_currency as (
  select currency, count(*) as invoices, cast(sum(invoiced_amount) as double) as billed_amount,
         count(*) filter (status = 'paid') as paid_invoices,
         {share("count(*) filter (status = 'paid')", 'count(*)')} as paid_pct
  from fact_invoice group by 1),
kpi_academic_by_department as (
  select department, count(*) as enrollments, count(*) filter (has_grades) as with_grades,
         {mean('cast(final_score as decimal(12,3))', 2, 3)} as avg_final_score,
         {share('count(*) filter (passed)', 'count(*) filter (has_grades)')} as pass_rate_pct
  from fact_enrollment join dim_course using (course_id) group by 1),
kpi_subscription_status as (
  select status, count(*) as subscriptions, count(*) filter (is_effectively_expired) as effectively_expired,
         cast(sum(monthly_price) filter (status = 'active' and not is_effectively_expired) as double) as active_mrr
  from fact_subscription group by 1),
kpi_sales_pipeline as (
  select stage, count(*) as opportunities, cast(sum(amount) as double) as total_amount, {mean('amount', 2)} as avg_amount
  from fact_opportunity group by 1),
kpi_lead_funnel as (
  select status, count(*) as leads, {half_up('sum(score)', 'count(score)', 1)} as avg_score from fact_lead group by 1),
kpi_student_vs_external as (
  select case when is_student then 'estudiante' else 'externo' end as customer_type,
         count(distinct c.customer_id) as customers, count(invoice_id) as invoices,
         {half_up('count(invoice_id)', 'count(distinct c.customer_id)', 3)} as invoices_per_customer,
         {half_up('sum(cast(invoiced_amount * 100 as hugeint))', '100 * count(distinct c.customer_id)', 2)} as revenue_per_customer
  from dim_customer c left join fact_invoice i on c.customer_id = i.customer_id group by 1),
kpi_mrr_breakdown as (
  select 'MRR real (vigente)' as segmento,
         count(*) filter (status = 'active' and not is_effectively_expired) as suscripciones,
         cast(sum(monthly_price) filter (status = 'active' and not is_effectively_expired) as double) as mrr
  from fact_subscription
  union all
  select 'MRR en riesgo (activa vencida)', count(*) filter (status = 'active' and is_effectively_expired),
         cast(sum(monthly_price) filter (status = 'active' and is_effectively_expired) as double)
  from fact_subscription),
kpi_lead_by_source as (
  select source, count(*) as leads, count(*) filter (is_converted) as convertidos,
         {share('count(*) filter (is_converted)', 'count(*)')} as conversion_pct
  from fact_lead group by 1),
kpi_headline as (
  select
    (select {half_up("sum(cast(monthly_price * 100 as hugeint)) filter (status = 'active' and not is_effectively_expired)", '100', 0)}
     from fact_subscription) as mrr_real,
    (select {half_up("sum(cast(monthly_price * 100 as hugeint)) filter (status = 'active')", '100', 0)}
     from fact_subscription) as mrr_nominal,
    (select {share("count(*) filter (status <> 'paid')", 'count(*)')} from fact_invoice) as pct_sin_cobrar,
    (select {share('count(*) filter (is_won)', 'count(*) filter (is_closed)')} from fact_opportunity) as win_rate_pct,
    (select {share('count(*) filter (is_converted)', 'count(*)')} from fact_lead) as lead_conversion_pct)"""


def raw(sql: str) -> str:
    return f"with {RAW}\n{sql}"


def on_silver(sql: str) -> str:
    return f"with {RAW},{SILVER}\n{sql}"


def on_gold(sql: str) -> str:
    return f"with {RAW},{SILVER},{GOLD}\n{sql}"


def on_kpi(sql: str) -> str:
    return f"with {RAW},{SILVER},{GOLD},{KPI}\n{sql}"


# Columns to show in the plain result types (decimals as DOUBLE, timestamps as text, whole numbers as BIGINT).
DECIMALS = {
    "university_grades": ("score", "weight"), "billing_products": ("monthly_price",),
    "billing_invoices": ("total",), "billing_invoice_items": ("quantity", "unit_price", "line_total"),
    "billing_payments": ("amount",), "crm_accounts": ("annual_revenue",), "crm_opportunities": ("amount",),
    "dim_product": ("monthly_price",), "dim_account": ("annual_revenue",),
    "fact_invoice": ("invoiced_amount", "total_reported"), "fact_payment": ("amount",),
    "fact_subscription": ("monthly_price",), "fact_opportunity": ("amount",),
}
STAMPS = {
    "billing_customers": "created_at", "crm_accounts": "created_at", "crm_contacts": "created_at",
    "crm_leads": "created_at", "crm_opportunities": "created_at", "crm_activities": "occurred_at",
}


def shown(table: str, name: str | None = None, silver: bool = False) -> str:
    replaced = [f"cast({c} as double) as {c}" for c in DECIMALS.get(table, ())]
    if silver and table == "billing_invoices":
        replaced.append("cast(total_reported as double) as total_reported")
    if table in STAMPS and (silver or table == "crm_activities"):
        c = STAMPS[table]
        replaced.append(f"strftime(cast({c} as timestamp), '%Y-%m-%d %H:%M:%S') as {c}")
    clause = f" replace ({', '.join(replaced)})" if replaced else ""
    return f"select *{clause} from {name or table}"


for _table in SOURCES:
    ORACLE[f"silver_{_table}"] = on_silver(shown(_table, f"s_{_table}", True))
ORACLE["silver_grade_summary_fine_weights"] = f"""with {RAW},
fine as (select enrollment_id, cast(score * 100 as hugeint) as s, cast(weight * 100000 as hugeint) + length(grade_id) % 7 * 333 as w from university_grades),
sums as (select enrollment_id, count(*) as n, sum(w) as w, sum(s * w) as p, sum(s) as s from fine group by 1)
select enrollment_id, n as n_grades, {half_up('w', '100000', 3)} as weight_sum, abs(w - 100000) <= 1000 as weight_sum_ok,
       {half_up('p', 'w * 100', 3)} as final_score_weighted, {half_up('s', 'n * 100', 3)} as final_score_simple from sums"""
ORACLE["silver_enrollment_grade_summary"] = on_silver("select * from s_enrollment_grade_summary")
for _table in (
    "dim_date", "dim_student", "dim_customer", "dim_product", "dim_course", "dim_semester", "dim_account", "fact_enrollment",
    "fact_invoice", "fact_payment", "fact_subscription", "fact_opportunity", "fact_activity", "fact_lead",
):
    ORACLE[f"gold_{_table}"] = on_gold(shown(_table))
for _kpi in (
    "kpi_revenue_monthly", "kpi_collection_by_currency", "kpi_academic_by_department", "kpi_subscription_status",
    "kpi_sales_pipeline", "kpi_lead_funnel", "kpi_student_vs_external", "kpi_mrr_breakdown", "kpi_lead_by_source", "kpi_headline",
):
    ORACLE[_kpi] = on_kpi(f"select * from {_kpi}")
for _chart, _sql in {
    "chart_mrr_real": "select mrr_real from kpi_headline",
    "chart_pct_sin_cobrar": "select pct_sin_cobrar from kpi_headline",
    "chart_win_rate": "select win_rate_pct from kpi_headline",
    "chart_lead_conversion": "select lead_conversion_pct from kpi_headline",
    "chart_revenue_monthly": "select month, currency, revenue from kpi_revenue_monthly order by month, currency limit 10000",
    "chart_collection_by_currency": "select currency, paid_pct from kpi_collection_by_currency",
    "chart_mrr_breakdown": "select segmento, mrr from kpi_mrr_breakdown",
    "chart_subscriptions_by_status": "select status, subscriptions from kpi_subscription_status",
    "chart_pass_rate_by_department": "select department, pass_rate_pct from kpi_academic_by_department",
    "chart_academic_table": "select * from kpi_academic_by_department",
    "chart_pipeline_by_stage": "select stage, total_amount from kpi_sales_pipeline",
    "chart_conversion_by_source": "select source, conversion_pct from kpi_lead_by_source",
    "chart_student_vs_external": "select * from kpi_student_vs_external",
}.items():
    ORACLE[_chart] = on_kpi(_sql)

"""Independent SQL for the insights."""

from __future__ import annotations

from probes.bindings import AS_OF
from probes.oracle import GOLD, KPI, ORACLE, RAW, SILVER, half_up, mean, share


def insight(name: str, sql: str, kpis: bool = False) -> None:
    ORACLE[f"ins_{name}"] = f"with {RAW},{SILVER},{GOLD}{',' + KPI if kpis else ''}\n{sql}"


def signed(change: str, base: str) -> str:
    """Percent change between decimal sums of two digits."""
    return half_up(f"cast(({change}) * 10000 as hugeint)", f"cast(({base}) * 100 as hugeint)", 1)


LIVE = "status = 'active' and not is_effectively_expired"
CENSUS = (
    ("university_students", "age_at_enrollment_lt_15"), ("university_courses", "department_mismatch"),
    ("university_enrollments", "enrolled_at_out_of_window"), ("university_enrollments", "is_duplicate_enrollment"),
    ("university_grades", "has_duplicate_assessment"), ("billing_subscriptions", "invalid_date_range"),
    ("billing_subscriptions", "is_effectively_expired"), ("billing_invoices", "is_total_mismatch"),
    ("billing_invoices", "paid_without_payment"), ("crm_activities", "is_orphan"),
)
insight("flag_census", "\nunion all ".join(
    f"select '{t}.{f}' as flag, count(*) as raised from s_{t} where {f}" for t, f in CENSUS))
CENT = "cast({0} * 100 as hugeint)"
insight("revenue_measures", f"""
select measure, cast(total as double) as total,
       {half_up("cast(total * 100 as hugeint)", "cast((select sum(total_reported) from s_billing_invoices) * 100 as hugeint)", 4)} as ratio_to_header
from (select 'header' as measure, sum(total_reported) as total from s_billing_invoices
      union all select 'payments', sum(amount) from s_billing_payments
      union all select 'lines', sum(line_total) from s_billing_invoice_items) x""")
insight("mrr_by_state", """
select case when is_effectively_expired then 'expired' else 'current' end as state, count(*) as subscriptions,
       cast(sum(monthly_price) as double) as mrr from fact_subscription where status = 'active' group by 1""")
insight("long_expired", f"""
select count(*) as subscriptions from fact_subscription
where status = 'active' and is_effectively_expired and end_date < date '{AS_OF}' - interval 1 year""")
insight("expiry_cohorts", """
select coalesce(cast(year(end_date) as varchar), 'invalid range') as cohort, count(*) as subscriptions,
       cast(sum(monthly_price) as double) as mrr from fact_subscription where status = 'active' and is_effectively_expired group by 1""")
insight("open_by_year", f"""
select year(issued_date) as year, count(*) as invoices, count(*) filter (status <> 'paid') as open_invoices,
       {share("count(*) filter (status <> 'paid')", 'count(*)')} as open_pct from fact_invoice group by 1""")
insight("open_by_currency", f"""
select currency, cast(sum(invoiced_amount) filter (status <> 'paid') as double) as open_amount,
       {half_up(f"sum(date '{AS_OF}' - due_date) filter (status <> 'paid')", "count(*) filter (status <> 'paid')", 0)} as mean_days_overdue
from fact_invoice group by 1""")
MIX = """(select currency, category, sum(quantity * unit_price) as revenue from s_billing_invoice_items
  join s_billing_products using (product_id) join s_billing_invoices using (invoice_id) group by 1, 2)"""
insight("category_mix", f"""
select currency, category, cast(revenue as double) as revenue,
       {share('cast(revenue * 10000 as hugeint)', 'cast(sum(revenue) over (partition by currency) * 10000 as hugeint)')} as share_pct
from {MIX} m""")
RANKING = f"(select currency, string_agg(category, ' > ' order by revenue desc, category) as ranking from {MIX} m group by 1)"
insight("category_ranking", f"select * from {RANKING} r")
insight("same_ranking", f"""
select count(*) as currencies, count(distinct ranking) as rankings, count(distinct ranking) <= 1 as same_everywhere from {RANKING} r""")
insight("annual_revenue", f"""
select currency, year, cast(revenue as double) as revenue, {signed('revenue - p', 'p')} as vs_previous_pct,
       {signed('revenue - f', 'f')} as vs_first_pct, {signed('revenue - m', 'm')} as vs_peak_pct
from (select *, lag(revenue) over (partition by currency order by year) as p,
             first_value(revenue) over (partition by currency order by year) as f, max(revenue) over (partition by currency) as m
      from (select currency, year(issued_date) as year, sum(invoiced_amount) as revenue from fact_invoice group by 1, 2) y) z""")
insight("ticket_by_segment", f"""
select segment, count(*) as invoices, {mean('invoiced_amount', 2)} as ticket_lines, {mean('total_reported', 2)} as ticket_header,
       {share('sum(cast(invoiced_amount * 100 as hugeint))', 'sum(sum(cast(invoiced_amount * 100 as hugeint))) over ()')} as revenue_pct
from fact_invoice join dim_customer using (customer_id) group by 1""")
insight("unsupported_invoices", """
select count(*) filter (has_no_items) as without_items, count(*) filter (paid_without_payment) as paid_without_payment,
       count(*) filter (has_no_items and paid_without_payment) as both, count(*) filter (has_no_items or paid_without_payment) as either
from s_billing_invoices""")
insight("unsupported_by_currency", """
select currency, cast(coalesce(sum(coalesce(total, total_reported)) filter (has_no_items), 0) as double) as amount_without_items,
       cast(coalesce(sum(coalesce(total, total_reported)) filter (paid_without_payment), 0) as double) as amount_paid_without_payment
from s_billing_invoices group by 1""")
insight("discontinued_mrr", f"""
select count(*) filter (not active) as subscriptions, cast(coalesce(sum(f.monthly_price) filter (not active), 0) as double) as mrr,
       {share('coalesce(sum(cast(f.monthly_price * 100 as hugeint)) filter (not active), 0)', 'sum(cast(f.monthly_price * 100 as hugeint))')} as share_pct
from fact_subscription f join dim_product p using (product_id) where {LIVE}""")
insight("mrr_by_status", f"""
select status, count(*) as subscriptions, cast(sum(monthly_price) as double) as book,
       cast(sum(monthly_price) filter ({LIVE}) as double) as live_mrr from fact_subscription group by 1""")
insight("contract_duration", f"""
select count(*) as subscriptions, quantile_cont(cast(end_date - start_date as double), 0.5) as median_days,
       {half_up('sum(end_date - start_date)', 'count(*)', 0)} as mean_days
from fact_subscription where not invalid_date_range and end_date is not null""")
insight("mrr_by_category", f"""
select category, cast(sum(f.monthly_price) as double) as mrr,
       {share('sum(cast(f.monthly_price * 100 as hugeint))', 'sum(sum(cast(f.monthly_price * 100 as hugeint))) over ()')} as share_pct,
       (select {mean('x.monthly_price', 2)} from dim_product x where x.category = p.category) as mean_list_price
from fact_subscription f join dim_product p using (product_id) where {LIVE} group by 1""")
insight("top_product", f"""
select sku, category, cast(mrr as double) as mrr, customers,
       {share('cast(mrr * 100 as hugeint)', f'(select cast(sum(monthly_price) * 100 as hugeint) from fact_subscription where {LIVE})')} as share_pct
from (select product_id, sum(monthly_price) as mrr, count(distinct customer_id) as customers from fact_subscription
      where {LIVE} group by 1 order by 2 desc, 1 limit 1) t join dim_product using (product_id)""")
insight("conversion_by_source", "select * from kpi_lead_by_source", True)
insight("score_by_conversion", f"""
select is_converted, {half_up('sum(score)', 'count(score)', 1)} as mean_score, count(*) as leads from fact_lead group by 1""")
insight("completed_without_grades", f"""
select code, count(*) filter (status = 'completed') as completed, count(*) filter (status = 'completed' and not has_grades) as without_grades,
       {share("count(*) filter (status = 'completed' and not has_grades)", "count(*) filter (status = 'completed')", 2)} as pct
from s_university_enrollments join s_university_semesters using (semester_id) group by 1""")
insight("loss_by_year", f"""
select year, count(*) filter (status = 'dropped') as dropped, count(*) filter (status = 'failed') as failed,
       {share("count(*) filter (status in ('dropped', 'failed'))", 'count(*)', 2)} as loss_pct
from fact_enrollment join dim_semester using (semester_id) group by 1""")
SCORE = "cast(final_score as decimal(12,3))"
insight("score_spread", "\nunion all\n".join(
    f"select '{label}' as dimension, {column} as value, count(*) as scored, {mean(SCORE, 2, 3)} as mean_score, "
    f"round(stddev_samp(final_score), 2) as stddev from fact_enrollment join {dim} d using ({key}) "
    f"where final_score is not null group by 2"
    for label, key, dim, column in (("department", "course_id", "dim_course", "d.department"),
                                    ("semester", "semester_id", "dim_semester", "d.code"),
                                    ("country", "student_id", "dim_student", "d.country"))))
COURSES = f"""(select course_id, count(*) as scored, {mean(SCORE, 2, 3)} as mean_score from fact_enrollment
  where final_score is not null group by 1 having count(*) >= 30)"""
insight("course_extremes", f"""
select * from (select 'best' as which, * from {COURSES} c order by mean_score desc, course_id limit 1) a
union all select * from (select 'worst' as which, * from {COURSES} c order by mean_score, course_id limit 1) b""")
insight("score_by_status", f"""
select status, count(*) as enrollments, count(final_score) as scored, {mean(SCORE, 2, 3)} as mean_score from fact_enrollment group by 1""")
insight("failed_with_pass", f"""
select count(final_score) as scored, count(*) filter (final_score >= 60) as passing_score,
       {share('count(*) filter (final_score >= 60)', 'count(final_score)')} as pct from fact_enrollment where status = 'failed'""")
insight("section_size", f"""
select count(*) as sections, {half_up('sum(n)', 'count(*)', 2)} as mean_students, max(n) as max_students
from (select count(*) as n from fact_enrollment group by course_id, semester_id) x""")
FINAL = "enrollment_id in (select enrollment_id from s_university_grades where assessment = 'final')"
insight("completed_with_final", f"""
select count(*) as completed, count(*) filter ({FINAL}) as with_final, {share(f'count(*) filter ({FINAL})', 'count(*)')} as pct
from s_university_enrollments where status = 'completed'""")
insight("students_without_enrollment", """
select count(*) as students from s_university_students where student_id not in (select student_id from s_university_enrollments)""")
for _name, _by in (("win_rate_by_industry", "industry"), ("win_rate_by_size", "employee_band")):
    insight(_name, f"""
select {_by}, count(*) filter (is_closed) as closed, {share('count(*) filter (is_won)', 'count(*) filter (is_closed)')} as win_rate_pct
from fact_opportunity join dim_account using (account_id) group by 1 having count(*) filter (is_closed) > 0""")
insight("deal_size", f"select stage, count(*) as deals, {mean('amount', 2)} as mean_amount from fact_opportunity where is_closed group by 1")
DAYS = "cast(close_date - created_date as double)"
insight("sales_cycle", "select count(*) filter (is_closed) as closed, "
        "count(*) filter (is_closed and is_close_before_created) as broken_dates, " + ", ".join(
            f"round(quantile_cont({DAYS}, {p}) filter (is_closed and not is_close_before_created), 2) as {n}"
            for p, n in ((0.25, "p25_days"), (0.5, "median_days"), (0.75, "p75_days"))) + " from fact_opportunity")
insight("stale_pipeline", f"""
select count(*) filter (not is_closed) as open_deals, count(*) filter (not is_closed and close_date < date '{AS_OF}') as past_close_date
from fact_opportunity""")
insight("touches_by_outcome", f"""
select case when is_won then 'won' when is_closed then 'lost' else 'open' end as outcome, count(distinct o.opportunity_id) as deals,
       count(activity_id) as activities, {half_up('count(activity_id)', 'count(distinct o.opportunity_id)', 2)} as activities_per_deal
from fact_opportunity o left join fact_activity a on a.opportunity_id = o.opportunity_id group by 1""")
NO_SUB = "customer_id not in (select customer_id from fact_subscription)"
BILLED = "customer_id in (select customer_id from fact_invoice)"
insight("customers_without_contract", f"""
select count(*) filter ({NO_SUB}) as without_subscription, count(*) filter ({NO_SUB} and {BILLED}) as billed_without_subscription,
       count(*) filter ({NO_SUB} and not {BILLED}) as neither from dim_customer""")
EARLY = "count(*) filter (cast(c.created_at as timestamp) < cast(a.created_at as timestamp))"
insight("early_contacts", f"""
select {EARLY} as early_contacts, count(*) as contacts, {share(EARLY, 'count(*)')} as pct
from s_crm_contacts c join s_crm_accounts a using (account_id)""")
insight("funnels", """
select 'deals' as funnel, stage as step, opportunities as n from kpi_sales_pipeline
union all select 'leads', status, leads from kpi_lead_funnel""", True)
insight("segment_students", f"""
select segment, case when is_student then 'estudiante' else 'externo' end as customer_type, count(distinct c.customer_id) as customers,
       count(invoice_id) as invoices, {half_up('count(invoice_id)', 'count(distinct c.customer_id)', 3)} as invoices_per_customer,
       {half_up('sum(cast(invoiced_amount * 100 as hugeint))', '100 * count(distinct c.customer_id)', 2)} as revenue_per_customer
from dim_customer c left join fact_invoice i on c.customer_id = i.customer_id group by 1, 2""")
insight("paid_by_band", "select payment_status_derived, count(*) as invoices from fact_invoice where status = 'paid' group by 1")
insight("survivors_out_of_window", f"""
select count(*) as enrollments, count(*) filter (enrolled_at_out_of_window) as out_of_window,
       {share('count(*) filter (enrolled_at_out_of_window)', 'count(*)')} as pct
from s_university_enrollments where is_duplicate_survivor""")
insight("monthly_range", """
select currency, min(revenue) as lowest_month, max(revenue) as highest_month, cast(sum(invoices) as bigint) as invoices
from kpi_revenue_monthly group by 1""", True)
insight("main_currencies", f"""
select cast(sum(n) as bigint) as invoices, {share('sum(n)', '(select count(*) from fact_invoice)')} as share_pct
from (select currency, count(*) as n from fact_invoice group by 1 order by 2 desc, 1 limit 2) t""")
insight("dropped_with_score", f"""
select count(*) as dropped, count(final_score) as with_score, {share('count(final_score)', 'count(*)')} as pct
from fact_enrollment where status = 'dropped'""")

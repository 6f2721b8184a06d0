"""Independent SQL for the audits."""

from __future__ import annotations

from itertools import combinations

from probes.bindings import AS_OF
from probes.oracle import ORACLE, RAW, half_up, share

TYPED = """
t_professors as (select * replace (cast(nullif(hired_at, '') as date) as hired_at) from university_professors),
t_customers as (select * replace (nullif(external_ref, '') as external_ref, cast(created_at as timestamp) as created_at)
                from billing_customers),
t_products as (select * replace (active = 'True' as active) from billing_products),
t_accounts as (select * replace (cast(created_at as timestamp) as created_at) from crm_accounts),
t_contacts as (select * replace (cast(created_at as timestamp) as created_at) from crm_contacts),
t_opportunities as (select * replace (cast(created_at as timestamp) as created_at) from crm_opportunities),
t_activities as (select * replace (nullif(contact_id, '') as contact_id, nullif(opportunity_id, '') as opportunity_id)
                 from crm_activities),
normal_scores as (
  select e.*, g.p / g.w as normal_score
  from university_enrollments e
  left join (select enrollment_id, cast(sum(score * weight) as double) as p, nullif(cast(sum(weight) as double), 0) as w
             from university_grades group by 1) g using (enrollment_id)),
linked as (
  select c.*, s.student_id, s.first_name as s_first, s.last_name as s_last, s.email as s_email, s.country as s_country,
         s.enrolled_at as s_enrolled
  from t_customers c join university_students s on c.external_ref = s.student_id)"""


def audit(name: str, sql: str, extra: str = "") -> None:
    ORACLE[name] = f"with {RAW},{TYPED}{',' + extra if extra else ''}\n{sql}"


def corr(x: str, y: str) -> str:
    return f"round(corr(cast({x} as double), cast({y} as double)), 4)"


def q(value: str, share_: float, digits: int = 4) -> str:
    return f"round(quantile_cont(cast({value} as double), {share_}), {digits})"


def v_of(cells_from: str, a: str, b: str) -> str:
    """Cramer's V from the full table of observed and expected counts."""
    return f"""
select case when least(count(distinct a), count(distinct b)) > 1 then
         round(sqrt(sum((o - e) * (o - e) / e) / (max(t) * (least(count(distinct a), count(distinct b)) - 1))), 4) end as cramers_v
from (select r.a, c.b, coalesce(x.n, 0) as o, r.n * c.n / t.n as e, t.n as t
      from (select {a} as a, cast(count(*) as double) as n from {cells_from} where {a} is not null and {b} is not null group by 1) r
      cross join (select {b} as b, cast(count(*) as double) as n from {cells_from} where {a} is not null and {b} is not null group by 1) c
      cross join (select cast(count(*) as double) as n from {cells_from} where {a} is not null and {b} is not null) t
      left join (select {a} as a, {b} as b, count(*) as n from {cells_from} group by 1, 2) x on x.a = r.a and x.b = c.b) k"""


def deciles(source: str, category: str, value: str) -> tuple[str, str]:
    """CTE with binned rows, and the query on it."""
    steps = ", ".join(str(i / 10) for i in range(11))
    extra = f"""
edges as (select list_sort(list_distinct(quantile_cont(cast({value} as double), [{steps}]))) as ed from {source}),
binned as (select {category} as a,
                  case when {value} is not null then
                    len(list_filter(list_slice(ed, 2, len(ed) - 1), lambda x: x < cast({value} as double))) end as b
           from {source}, edges)"""
    return v_of("binned", "a", "b"), extra


def rank_corr(source: str, x: str, y: str, name: str) -> str:
    return f"""(select round(corr(rx, ry), 4) from (
      select rank() over (order by x) + (count(*) over (partition by x) - 1) / 2.0 as rx,
             rank() over (order by y) + (count(*) over (partition by y) - 1) / 2.0 as ry
      from (select {x} as x, {y} as y from {source} where {x} is not null and {y} is not null) p) r) as {name}"""


def match_share(a_from: str, a: str, b_from: str, b: str) -> str:
    return f"""(select sum(p * q) from
      (select {a} as k, count(*) / sum(count(*)) over () as p from {a_from} where {a} is not null group by 1) l
      join (select {b} as k, count(*) / sum(count(*)) over () as q from {b_from} where {b} is not null group by 1) r using (k))"""


SEM = "university_enrollments e join university_semesters s using (semester_id)"

audit("uni_semesters", """
select count(*) filter (end_date < start_date) as invalid_date_ranges, count(*) filter (start_date <= p) as overlapping_pairs,
       count(*) filter (code <> cast(year as varchar) || '-' || cast(half as varchar)) as code_mismatches
from (select *, lag(end_date) over (order by start_date) as p from university_semesters) x""")
audit("uni_student_ages", """
select round(min(d) / 365.2425, 2) as age_min, round(quantile_cont(d, 0.5) / 365.2425, 2) as age_median,
       count(*) filter (d / 365.2425 < 15) as age_below_15, count(*) filter (d / 365.2425 < 18) as age_below_18,
       count(*) filter (d <= 0) as birth_on_or_after_registration
from (select cast(enrolled_at - birth_date as double) as d from university_students) x""")
audit("uni_course_departments", f"""
select count(*) filter (c.department = p.department) as same_department,
       count(*) filter (c.department <> p.department) as different_department, count(*) as total_courses,
       round({match_share('university_courses', 'department', 't_professors', 'department')} * 100, 2) as expected_same_pct
from university_courses c join t_professors p using (professor_id)""")
audit("uni_mismatched_professors", """
select count(distinct professor_id) as professors from university_courses c join t_professors p using (professor_id)
where c.department <> p.department""")
audit("uni_enrollment_window", f"""
select count(*) filter (enrolled_at between start_date and end_date) as inside,
       count(*) filter (enrolled_at < start_date) as before, count(*) filter (enrolled_at > end_date) as after,
       count(*) filter (status = 'active' and end_date < date '{AS_OF}') as active_in_ended_semester from {SEM}""")
audit("uni_enrollment_chronology", """
select count(*) filter (e.enrolled_at < st.enrolled_at) as before_student_registration,
       count(*) filter (st.enrolled_at > s.end_date) as student_registered_after_semester_end,
       count(*) filter (e.enrolled_at < p.hired_at) as before_professor_hire
from university_enrollments e left join university_students st using (student_id)
left join university_semesters s using (semester_id) left join university_courses c using (course_id)
left join t_professors p using (professor_id)""")
audit("uni_logical_duplicates", """
select count(*) filter (n > 1) as duplicate_groups, cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as rows_in_duplicate_groups,
       count(*) filter (n > 1 and k > 1) as groups_with_conflicting_status
from (select count(*) as n, count(distinct status) as k from university_enrollments group by student_id, course_id, semester_id) x""")
audit("uni_course_load", """
select max(n) as max_courses, count(*) filter (n > 8) as groups_over_limit
from (select count(*) as n from university_enrollments group by student_id, semester_id) x""")
audit("uni_status_distribution", "select status, count(*) as enrollments from university_enrollments group by 1")
audit("uni_grade_ranges", f"""
select count(*) filter (score < 0 or score > 100) as score_outside, count(*) filter (weight < 0 or weight > 1) as weight_outside,
       cast(min(score) as double) as score_min, cast(max(score) as double) as score_max,
       {half_up('sum(cast(score * 100 as hugeint))', 'count(*) * 100', 4)} as score_mean,
       cast(min(weight) as double) as weight_min, cast(max(weight) as double) as weight_max,
       {half_up('sum(cast(weight * 1000 as hugeint))', 'count(*) * 1000', 4)} as weight_mean
from university_grades""")
audit("uni_grade_chronology", """
select count(*) filter (graded_at < e.enrolled_at) as before_enrollment,
       count(*) filter (graded_at < st.enrolled_at) as before_student_registration,
       count(*) filter (graded_at between start_date and end_date) as inside_semester,
       count(*) filter (graded_at < start_date) as before_semester, count(*) filter (graded_at > end_date) as after_semester
from university_grades g join university_enrollments e using (enrollment_id) join university_semesters s using (semester_id)
join university_students st using (student_id)""")
audit("uni_grade_presence", """
select (select count(distinct enrollment_id) from university_grades) as enrollments_with_grades,
       (select count(*) from university_enrollments) - (select count(distinct enrollment_id) from university_grades)
         as enrollments_without_grades""")
audit("uni_ungraded_by_status", """
select status, count(*) as without_grades from university_enrollments
where enrollment_id not in (select enrollment_id from university_grades) group by 1""")
WEIGHTS = "w as (select enrollment_id, sum(weight) as w from university_grades group by 1)"
audit("uni_weight_sums", f"""
select count(*) filter (round(w * 100) = 100) as exactly_one_at_cent_precision,
       count(*) filter (abs(w - 1) <= 0.01) as within_0_01, count(*) as weight_groups,
       {q('w', 0.0)} as weight_min, {q('w', 0.5)} as weight_median, {q('w', 1.0)} as weight_max from w""", WEIGHTS)
audit("uni_weight_histogram", """
select cast(least(60, floor((x - lo) / ((hi - lo) / 60.0)) + 1) as bigint) as bin, count(*) as n
from (select cast(w as double) as x, min(cast(w as double)) over () as lo, max(cast(w as double)) over () as hi from w) k
group by 1""", WEIGHTS)
audit("uni_duplicate_assessments", """
select count(*) filter (n > 1) as duplicate_groups, cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as rows_in_duplicate_groups
from (select count(*) as n from university_grades group by enrollment_id, assessment) x""")
audit("uni_coverage_by_status", """
select status, count(*) as enrollments, count(*) filter (g) as with_grades, count(*) filter (not g) as without_grades,
       count(*) filter (f) as with_final
from (select status, enrollment_id in (select enrollment_id from university_grades) as g,
             enrollment_id in (select enrollment_id from university_grades where assessment = 'final') as f
      from university_enrollments) x group by 1""")
audit("uni_scores_by_status", f"""
select status, count(normal_score) as scored, round(avg(normal_score), 2) as score_mean, {q('normal_score', 0.5, 2)} as score_median
from normal_scores where normal_score is not null group by 1""")
audit("uni_status_score_association", *deciles("normal_scores", "status", "normal_score"))

INV = "t_invoices as (select * from billing_invoices)"
audit("bil_product_prices", f"""
select category, count(*) as products, count(*) filter (monthly_price <= 0) as nonpositive_price,
       cast(min(monthly_price) as double) as min_price, cast(max(monthly_price) as double) as max_price,
       {q('monthly_price', 0.5, 2)} as median_price from t_products group by 1""")
audit("bil_category_price_association", *deciles("t_products", "category", "monthly_price"))
audit("bil_subscription_rules", f"""
select count(*) filter (end_date < start_date) as end_before_start,
       count(*) filter (cast(start_date as timestamp) < created_at) as before_customer_created,
       count(*) filter (status = 'active') as active_total,
       count(*) filter (status = 'active' and end_date is not null) as active_with_end_date,
       count(*) filter (status = 'active' and end_date < date '{AS_OF}') as active_expired,
       count(*) filter (status = 'active' and not p.active) as active_on_inactive_product
from billing_subscriptions s left join t_customers c using (customer_id) left join t_products p using (product_id)""")
audit("bil_inverted_by_status", """
select status, count(*) as subscriptions from billing_subscriptions where end_date < start_date group by 1""")
audit("bil_subscription_overlaps", """
select (select count(*) from (select 1 from billing_subscriptions group by customer_id, product_id having count(*) > 1) g) as repeated_groups,
       count(distinct l.customer_id || '/' || l.product_id) as overlapping_groups, count(distinct l.subscription_id) as rows_in_overlaps
from billing_subscriptions l join billing_subscriptions r
  on l.customer_id = r.customer_id and l.product_id = r.product_id and l.subscription_id <> r.subscription_id
     and l.start_date <= r.end_date and r.start_date <= l.end_date""")
audit("bil_invoice_rules", f"""
select count(*) filter (cast(issued_at as timestamp) < created_at) as before_customer_created,
       count(*) filter (due_at < issued_at) as due_before_issued,
       count(*) filter (status = 'pending' and due_at < date '{AS_OF}') as pending_past_due,
       count(*) filter (status = 'pending') as pending_total
from billing_invoices left join t_customers using (customer_id)""")
audit("bil_due_days", "select due_at - issued_at as due_days, count(*) as invoices from billing_invoices group by 1")
MONEY = """
lines as (select invoice_id, sum(cast(line_total * 100 as bigint)) as v from billing_invoice_items group by 1),
paid as (select invoice_id, sum(cast(amount * 100 as bigint)) as v from billing_payments group by 1),
heads as (select *, cast(total * 100 as bigint) as cents from billing_invoices)"""
audit("bil_lines_against_header", f"""
select count(*) filter (v is null) as without_items, count(v) as with_items, count(*) filter (v = cents) as equal,
       count(*) filter (v > cents) as lines_greater, count(*) filter (v < cents) as lines_less,
       round(corr(cast(cents as double), cast(v as double)), 4) as pearson,
       round(cast(sum(v - cents) as double) / count(v) / 100, 4) as delta_mean,
       {q('(v - cents) / 100.0', 0.0)} as delta_min, {q('(v - cents) / 100.0', 0.5)} as delta_median,
       {q('(v - cents) / 100.0', 1.0)} as delta_max
from heads left join lines using (invoice_id)""", MONEY)
EXPECTED = ("map {'CL': 'CLP', 'PE': 'PEN', 'AR': 'ARS', 'MX': 'MXN', 'BR': 'BRL', 'ES': 'EUR', 'CO': 'COP', 'US': 'USD'}"
            "[country]")
audit("bil_currency_alignment", f"""
select count(*) filter (currency = expected) as aligned, {share('count(*) filter (currency = expected)', 'count(*)', 2)} as aligned_pct,
       round((select sum(p * q) from (select expected, count(*) / (select count(*) from ic) as p from ic group by 1) a
              join (select currency as expected, count(*) / (select count(*) from ic) as q from ic group by 1) b using (expected)) * 100, 2)
         as expected_pct
from ic""", f"ic as (select i.currency, {EXPECTED} as expected from billing_invoices i join t_customers c using (customer_id))")
audit("bil_payment_presence", """
select status, count(*) filter (invoice_id not in (select invoice_id from billing_payments)) as without_payment,
       count(*) filter (invoice_id in (select invoice_id from billing_payments)) as with_payment
from billing_invoices group by 1""")
audit("bil_line_arithmetic", """
select count(*) filter (cast(line_total * 100 as bigint) <> cast(round(quantity * unit_price * 100) as bigint)) as line_total_differs,
       count(*) as total_items from billing_invoice_items""")
audit("bil_unit_price_against_catalogue", f"""
select count(*) filter (unit_price = monthly_price) as equal_price,
       count(*) filter (abs(unit_price - monthly_price) * 100 <= monthly_price) as within_one_pct,
       {corr('unit_price', 'monthly_price')} as pearson,
       {q('abs(cast(unit_price as double) - cast(monthly_price as double)) / cast(monthly_price as double) * 100', 0.5, 2)} as median_error_pct
from billing_invoice_items join t_products using (product_id)""")
audit("bil_item_subscription_match", """
select count(*) filter (exists (select 1 from billing_subscriptions s where s.customer_id = i.customer_id and s.product_id = i.product_id))
         as ever_subscribed,
       count(*) filter (exists (select 1 from billing_subscriptions s where s.customer_id = i.customer_id and s.product_id = i.product_id
                                and i.issued_at between s.start_date and s.end_date)) as inside_contract,
       count(*) as total_items
from (select product_id, customer_id, issued_at from billing_invoice_items join billing_invoices using (invoice_id)) i""")
audit("bil_payment_rules", """
select count(*) filter (amount <= 0) as nonpositive_amount, count(*) filter (paid_at < issued_at) as before_invoice_issued,
       count(*) filter (cast(paid_at as timestamp) < created_at) as before_customer_created,
       count(*) filter (paid_at > due_at) as after_invoice_due, count(*) filter (currency <> 'USD') as on_non_usd_invoices
from billing_payments left join billing_invoices using (invoice_id) left join t_customers using (customer_id)""")
audit("bil_payments_by_currency", f"""
select currency, count(*) as payments, {q('amount', 0.5, 2)} as median_amount
from billing_payments join billing_invoices using (invoice_id) group by 1""")
audit("bil_payment_delay", f"""
select min(d) as min_days, {q('d', 0.5)} as median_days, {q('d', 0.95)} as p95_days, max(d) as max_days
from (select paid_at - issued_at as d from billing_payments join billing_invoices using (invoice_id)) x""")
RATIO = "cast(amount as double) / cast(total as double)"
audit("bil_payment_share", f"""
select {corr('amount', 'total')} as pearson, count(*) filter (amount > total) as greater_than_invoice,
       {q(RATIO, 0.0)} as ratio_min, {q(RATIO, 0.5)} as ratio_median, {q(RATIO, 0.95)} as ratio_p95, {q(RATIO, 1.0)} as ratio_max
from billing_payments join billing_invoices using (invoice_id)""")
audit("bil_payments_against_header", """
select count(v) as with_payments, count(*) filter (v = cents) as equal, count(*) filter (v > cents) as paid_greater,
       count(*) filter (v < cents) as paid_less, count(*) filter (abs(v - cents) <= 1) as within_one_cent,
       count(*) filter (v - cents > 1) as greater_beyond_one_cent, count(*) filter (v - cents < -1) as less_beyond_one_cent,
       round(corr(cast(cents as double), cast(v as double)), 4) as pearson
from heads left join paid using (invoice_id)""", MONEY)
audit("bil_finance_by_currency", """
select currency, count(*) as invoices, cast(sum(cents) as double) / 100 as reported_total,
       cast(coalesce(sum(l.v), 0) as double) / 100 as line_sum, cast(coalesce(sum(p.v), 0) as double) / 100 as payment_sum,
       count(l.v) as invoices_with_lines, count(p.v) as invoices_with_payments
from heads left join lines l using (invoice_id) left join paid p using (invoice_id) group by 1""", MONEY)
audit("bil_payments_on_open_invoices", """
select count(*) as payments from billing_payments join billing_invoices using (invoice_id) where status in ('pending', 'overdue')""")
audit("bil_payment_methods", "select method, count(*) as payments from billing_payments group by 1")

audit("crm_account_names", """
select count(distinct name) as unique_names,
       (select cast(sum(n) as bigint) from (select count(*) as n from t_accounts group by name having count(*) > 1) x) as rows_with_shared_name,
       (select count(*) from (select 1 from t_accounts group by name, country having count(*) > 1) x) as name_country_duplicate_groups,
       (select cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from t_accounts group by name, country having count(*) > 1) x)
         as name_country_rows_in_duplicate_groups
from t_accounts""")
audit("crm_top_account_names", "select name, count(*) as accounts from t_accounts group by 1 order by 2 desc, 1 limit 3")
audit("crm_account_size", f"""
select count(*) filter (employees <= 0) as nonpositive_employees, count(*) filter (annual_revenue <= 0) as nonpositive_revenue,
       {corr('annual_revenue', 'employees')} as pearson, {rank_corr('t_accounts', 'annual_revenue', 'employees', 'spearman')}
from t_accounts""")
audit("crm_contact_rules", """
select (select count(*) from t_contacts c join t_accounts a using (account_id) where c.created_at < a.created_at) as created_before_account,
       (select count(*) from (select count(*) over (partition by lower(email)) as n from t_contacts) x where n > 1) as rows_in_shared_email,
       (select count(*) from (select count(*) over (partition by phone) as n from t_contacts) x where n > 1) as rows_in_shared_phone""")
audit("crm_lead_scores_by_status", f"""
select status, count(*) as leads, round(avg(score), 2) as score_mean, {q('score', 0.5, 2)} as score_median from crm_leads group by 1""")
audit("crm_lead_score_association", *deciles("crm_leads", "status", "score"))
audit("crm_lead_conversion", """
select count(*) filter (status = 'converted') as converted, count(*) filter (score < 50) as below_50,
       count(*) filter (score < 50 and status = 'converted') as below_50_converted,
       count(*) filter (not coalesce(score < 50, false)) as from_50,
       count(*) filter (not coalesce(score < 50, false) and status = 'converted') as from_50_converted,
       count(*) filter (status = 'converted' and score >= (select quantile_cont(score, 0.9) from crm_leads)) as converted_in_top_decile
from crm_leads""")
audit("crm_deal_chronology", f"""
select count(*) filter (o.created_at < a.created_at) as created_before_account,
       count(*) filter (cast(close_date as timestamp) < o.created_at) as close_before_created,
       count(*) filter (stage not in ('won', 'lost') and close_date <= date '{AS_OF}') as open_with_past_close,
       count(*) filter (stage in ('won', 'lost') and close_date > date '{AS_OF}') as closed_with_future_close
from t_opportunities o left join t_accounts a using (account_id)""")
audit("crm_close_before_created_by_stage", """
select stage, count(*) filter (cast(close_date as timestamp) < created_at) as close_before_created from t_opportunities group by 1""")
audit("crm_deal_amount_against_revenue", f"""
select count(*) filter (amount > annual_revenue) as greater_than_revenue,
       count(*) filter (amount > annual_revenue and stage = 'won') as won_greater_than_revenue,
       {corr('amount', 'annual_revenue')} as pearson, {rank_corr('oa', 'amount', 'annual_revenue', 'spearman')} from oa""",
      "oa as (select o.amount, o.stage, a.annual_revenue from t_opportunities o join t_accounts a using (account_id))")
audit("crm_stage_summary", f"""
select stage, count(*) as opportunities, cast(sum(amount) as double) as amount_sum,
       count(*) filter (cast(close_date as timestamp) < created_at) as close_before_created, {q('amount', 0.5, 2)} as amount_median
from t_opportunities group by 1""")
audit("crm_stage_amount_association", *deciles("t_opportunities", "stage", "amount"))
BRIDGE = f"""
select (select count(*) from crm_opportunity_contacts) as total_pairs,
       (select count(*) - count(distinct opportunity_id || '/' || contact_id) from crm_opportunity_contacts) as duplicate_pairs,
       (select count(*) from crm_opportunity_contacts join t_opportunities o using (opportunity_id) join t_contacts c using (contact_id)
        where o.account_id = c.account_id) as same_account,
       round((select count(*) from crm_opportunity_contacts) * {match_share('t_opportunities', 'account_id', 't_contacts', 'account_id')}, 2)
         as expected_same_account"""
audit("crm_bridge", BRIDGE)
SCOPE = """sc as (select *, case when contact_id is not null and opportunity_id is not null then 'both' when contact_id is not null then 'contact_only'
  when opportunity_id is not null then 'opportunity_only' else 'unlinked' end as scope from t_activities)"""
audit("crm_activity_scope", "select scope, count(*) as activities from sc group by 1", SCOPE)
audit("crm_activity_pairs", """
select count(*) filter (scope = 'both') as both_total,
       count(*) filter (scope = 'both' and (opportunity_id, contact_id) in (select (opportunity_id, contact_id) from crm_opportunity_contacts))
         as pair_on_bridge,
       (select count(*) from sc join t_opportunities o using (opportunity_id) join t_contacts c using (contact_id) where o.account_id = c.account_id)
         as same_account
from sc""", SCOPE)
audit("crm_activity_chronology", """
select count(*) filter (occurred_at < c.created_at) as before_contact_created,
       count(*) filter (occurred_at < o.created_at) as before_opportunity_created,
       count(*) filter (occurred_at > cast(close_date as timestamp)) as after_opportunity_close
from t_activities a left join t_contacts c using (contact_id) left join t_opportunities o using (opportunity_id)""")
audit("crm_type_scope_association", v_of("sc", "type", "scope"), SCOPE)
audit("crm_lonely", """
select (select count(*) from crm_opportunities where opportunity_id not in (select opportunity_id from crm_opportunity_contacts))
         as opportunities_without_contacts,
       (select count(*) from crm_accounts where account_id not in (select account_id from crm_contacts)) as accounts_without_contacts""")

audit("xdm_link_counts", """
select count(distinct external_ref) as unique_references, count(external_ref) - count(distinct external_ref) as duplicate_references,
       (select count(*) from linked) as linked_pairs from t_customers""")
SAME_COUNTRY = match_share("linked", "country", "linked", "s_country")
audit("xdm_link_identity", f"""
select count(*) as linked_pairs, count(*) filter (lower(trim(email)) = lower(trim(s_email))) as same_email,
       count(*) filter (lower(trim(first_name)) = lower(trim(s_first)) and lower(trim(last_name)) = lower(trim(s_last))) as same_full_name,
       count(*) filter (country = s_country) as same_country, {share('count(*) filter (country = s_country)', 'count(*)', 2)} as same_country_pct,
       round(count(*) * {SAME_COUNTRY}, 2) as expected_same_country from linked""")
audit("xdm_link_dates", f"""
select count(*) filter (created_at < cast(s_enrolled as timestamp)) as created_before_registration,
       count(*) filter (created_at > cast(s_enrolled as timestamp)) as created_after_registration,
       {corr("date_diff('day', date '1970-01-01', cast(created_at as date))", "date_diff('day', date '1970-01-01', s_enrolled)")} as date_pearson
from linked""")
audit("xdm_link_numbers", f"""
select count(*) filter (c = s) as exact_match, {rank_corr('ids', 'c', 's', 'spearman')} from ids""",
      "ids as (select cast(customer_id as bigint) as c, cast(student_id as bigint) as s from linked)")
audit("xdm_linked_activity_chronology", """
select (select count(*) from billing_subscriptions join linked using (customer_id) where start_date < s_enrolled) as subscriptions_before_registration,
       (select count(*) from billing_subscriptions join linked using (customer_id)) as linked_subscriptions,
       (select count(*) from billing_invoices join linked using (customer_id) where issued_at < s_enrolled) as invoices_before_registration,
       (select count(*) from billing_invoices join linked using (customer_id)) as linked_invoices,
       (select count(*) from billing_payments join billing_invoices using (invoice_id) join linked using (customer_id) where paid_at < s_enrolled)
         as payments_before_registration,
       (select count(*) from billing_payments join billing_invoices using (invoice_id) join linked using (customer_id)) as linked_payments""")
COUNTS = """
cc as (select c.*, coalesce(i.n, 0) as ic, coalesce(s.n, 0) as sc from t_customers c
       left join (select customer_id, count(*) as n from billing_invoices group by 1) i using (customer_id)
       left join (select customer_id, count(*) as n from billing_subscriptions group by 1) s using (customer_id))"""
audit("xdm_score_against_billing", f"""
select {rank_corr('sb', 'm', 'ic', 'score_vs_invoices')}, {rank_corr('sb', 'm', 'sc', 'score_vs_subscriptions')}""",
      COUNTS + """,
s16 as (select enrollment_id, (2 * p * 10000000000000000::hugeint + w) // (2 * w) as s from (
        select enrollment_id, sum(cast(score * 100 as hugeint) * cast(weight * 1000 as hugeint)) as p, nullif(100 * sum(cast(weight * 1000 as hugeint)), 0) as w
        from university_grades group by 1)),
sb as (select m.m, ic, sc from cc join university_students st on cc.external_ref = st.student_id
       left join (select student_id, (2 * sum(s) + 1000 * count(s)) // nullif(2000 * count(s), 0) as m
                  from university_enrollments left join s16 using (enrollment_id) group by 1) m on m.student_id = st.student_id)""")
audit("xdm_linked_behaviour", """
select case when external_ref is not null then 'student_reference' else 'no_student_reference' end as link, count(*) as customers,
       round(cast(sum(ic) as double) / count(*), 3) as mean_invoices, round(cast(sum(sc) as double) / count(*), 3) as mean_subscriptions,
       count(*) filter (ic = 0) as without_invoice, count(*) filter (sc = 0) as without_subscription,
       count(*) filter (customer_id in (select customer_id from billing_payments join billing_invoices using (invoice_id))) as with_payment
from cc group by 1""", COUNTS)
GROUPS = {"students": "university_students", "professors": "university_professors", "customers": "billing_customers",
          "contacts": "crm_contacts", "leads": "crm_leads"}
audit("xdm_email_overlaps", "\nunion all\n".join(
    f"select '{a}<->{b}' as pair, count(*) as shared from (select lower(trim(email)) as e from {GROUPS[a]} "
    f"intersect select lower(trim(email)) from {GROUPS[b]}) x" for a, b in combinations(GROUPS, 2)))
audit("xdm_converted_leads_known", """
select count(*) filter (status = 'converted') as converted_leads,
       count(distinct lower(email)) filter (status = 'converted' and lower(email) in (
         select lower(email) from university_students union all select lower(email) from billing_customers
         union all select lower(email) from crm_contacts)) as known_addresses
from crm_leads""")


def occupancy(child: str, fk: str, parent: str, pk: str) -> str:
    p, c = f"(select cast(count(*) as double) from {parent})", f"(select count({fk}) from {child})"
    unused = f"(select count(*) from {parent} where {pk} not in (select {fk} from {child} where {fk} is not null))"
    expected = f"({p} * pow(({p} - 1) / {p}, {c}))"
    return (f"select '{child}.{fk} -> {parent}.{pk}' as relation, {unused} as unreferenced_parents, "
            f"round({expected}, 2) as expected_unreferenced, round({unused} - {expected}, 2) + 0.0 as observed_minus_expected")


audit("evi_occupancy", "\nunion all\n".join(occupancy(*r) for r in (
    ("university_grades", "enrollment_id", "university_enrollments", "enrollment_id"),
    ("billing_subscriptions", "customer_id", "billing_customers", "customer_id"),
    ("billing_invoices", "customer_id", "billing_customers", "customer_id"),
    ("billing_invoice_items", "invoice_id", "billing_invoices", "invoice_id"),
    ("crm_contacts", "account_id", "crm_accounts", "account_id"),
    ("crm_opportunities", "account_id", "crm_accounts", "account_id"))))
audit("evi_activity_missingness", """
select round(c * 100.0 / n, 3) as null_contact_pct, round(o * 100.0 / n, 3) as null_opportunity_pct, b as observed_both_null,
       round(cast(c as double) * o / n, 2) as expected_both_null, round(b - cast(c as double) * o / n, 2) as difference
from (select count(*) as n, count(*) filter (contact_id is null) as c, count(*) filter (opportunity_id is null) as o,
             count(*) filter (contact_id is null and opportunity_id is null) as b from t_activities) x""")
audit("evi_matches", f"""
select 'department_pct' as evidence,
       {share("count(*) filter (c.department = p.department)", "count(*)", 2)} as observed,
       round({match_share('university_courses', 'department', 't_professors', 'department')} * 100, 2) as expected
from university_courses c join t_professors p using (professor_id)
union all select 'bridge_account', cast(same_account as double), expected_same_account from ({BRIDGE}) b
union all select 'link_country', cast(count(*) filter (country = s_country) as double), round(count(*) * {SAME_COUNTRY}, 2) from linked""")

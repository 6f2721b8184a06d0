"""Independent SQL for profiles, rules, gates and statistics."""

from __future__ import annotations

from probes.bindings import AS_OF
from probes.oracle import ORACLE, RAW, on_gold, on_kpi, on_silver, share
from probes.oracle_audits import deciles, rank_corr, v_of
from strata.catalog import (
    DATE_KINDS, FOREIGN_KEYS, GOLD_FOREIGN_KEYS, GOLD_KEYS, NUMBER_KINDS, REQUIRED, ROW_RULES, SOURCES, columns_of, primary_key,
)
from strata.plans.validators import FLAGS

VIEW = "p_"
TEXT = {t: [c for c, k in columns.items() if k == "string"] for t, (_, columns) in SOURCES.items()}


def blank(table: str, column: str) -> str:
    kind = SOURCES[table][1][column]
    if kind == "string":
        return f"nullif({column}, '') as {column}"
    if kind == "boolean":
        return f"{column} = 'True' as {column}"
    if kind in ("date", "timestamp"):
        return f"try_cast(nullif(cast({column} as varchar), '') as {kind}) as {column}"
    return column


PROFILE = ",\n".join(
    f"{VIEW}{t} as (select {', '.join(blank(t, c) for c in SOURCES[t][1])} from {t})" for t in SOURCES)


def union(parts) -> str:
    return f"with {RAW},\n{PROFILE}\n" + "\nunion all\n".join(parts)


ORACLE["profile_columns"] = union(
    f"select '{t}' as table_name, '{c}' as column_name, count(*) filter ({c} is null) as nulls, "
    + (f"count(*) filter (regexp_matches({c}, '^\\s|\\s$'))" if c in TEXT[t] else "0") + f" as padded_cells from {VIEW}{t}"
    for t in SOURCES for c in SOURCES[t][1])
SHAPES = [
    f"select '{t}' as table_name, count(*) as row_count, {len(SOURCES[t][1])} as column_count, "
    f"cast(sum({' + '.join(f'cast({c} is null as bigint)' for c in SOURCES[t][1])}) as bigint) as missing_cells, "
    f"count(*) - (select count(*) from (select distinct * from {VIEW}{t}) d) as exact_duplicate_rows, "
    f"(select cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from {VIEW}{t} group by {', '.join(primary_key(t))} "
    f"having count(*) > 1) k) as rows_in_duplicated_keys from {VIEW}{t}" for t in SOURCES]
ORACLE["profile_tables"] = union(SHAPES)
ORACLE["profile_structure"] = f"with {RAW},\n{PROFILE}\n" + "select count(*) as tables, " + ", ".join(
    f"cast(sum({c}) as bigint) as {c}" for c in (
        "row_count", "column_count", "missing_cells", "exact_duplicate_rows", "rows_in_duplicated_keys")
) + " from (" + "\nunion all\n".join(SHAPES) + ") s"
ORACLE["profile_numbers"] = union(
    f"select '{t}' as table_name, '{c}' as column_name, " + ", ".join(
        f"round(quantile_cont(cast({c} as double), {p}), 4) as {n}"
        for p, n in ((0, '"min"'), (0.5, '"median"'), (0.95, "p95"), (1, '"max"')))
    + f" from {VIEW}{t}" for t in SOURCES for c in columns_of(t, *NUMBER_KINDS))
ORACLE["profile_dates"] = union(
    f"select '{t}' as table_name, '{c}' as column_name, cast(min({c}) as date) as first_day, cast(max({c}) as date) as last_day, "
    f"count(*) filter (cast({c} as date) > date '{AS_OF}') as future_rows from {VIEW}{t}"
    for t in SOURCES for c in columns_of(t, *DATE_KINDS))
ORACLE["profile_categories"] = union(
    f"select '{t}' as table_name, '{c}' as column_name, cast({c} as varchar) as value, count(*) as n from {VIEW}{t} "
    f"where (select count(distinct {c}) between 2 and 20 from {VIEW}{t}) group by {c}"
    for t in SOURCES for c in SOURCES[t][1] if c not in set(columns_of(t, *DATE_KINDS)))
ORACLE["profile_emails"] = union(
    f"select '{t}' as table_name, 'email' as column_name, "
    f"count(*) filter (not regexp_matches(lower(trim(email)), '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')) as invalid_emails, "
    f"(select cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from {VIEW}{t} where email is not null "
    f"group by lower(trim(email)) having count(*) > 1) d) as rows_in_duplicate_emails from {VIEW}{t}"
    for t in SOURCES if "email" in SOURCES[t][1])
ORACLE["profile_parse_issues"] = f"with {RAW}\n" + "\nunion all\n".join(
    f"select '{t}' as table_name, '{c}' as column_name, '{k}' as kind, "
    f"count(*) filter (nullif(cast({c} as varchar), '') is not null and try_cast(nullif(cast({c} as varchar), '') as {k}) is null) as unparsed from {t}"
    for t in SOURCES for c, k in SOURCES[t][1].items() if k not in ("string", "boolean"))
ORACLE["profile_document_copies"] = """
select count(*) as groups, count(*) filter (n > 1) as duplicate_groups,
       cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as rows_in_duplicate_groups, cast(sum(n - 1) as bigint) as surplus_rows
from (select count(*) as n from documents group by lower(text)) x"""


def fk(child: str, key: str, parent: str, pk: str) -> str:
    c, p = f"{VIEW}{child}", f"{VIEW}{parent}"
    n = f"(select count(*) as n from {c} where {key} in (select {pk} from {p}) group by {key})"
    parents = f"(select cast(count(*) as double) from {p})"
    unused = f"((select count(*) from {p}) - (select count(*) from {n} x))"
    expected = f"({parents} * pow(({parents} - 1) / {parents}, count({key})))"
    return f"""select '{child}.{key} -> {parent}.{pk}' as relation, count(*) as child_rows, count({key}) as non_null_fk,
      count(*) - count({key}) as null_fk,
      count(*) filter ({key} is not null and {key} not in (select {pk} from {p})) as orphans,
      (select count(*) from {p}) as parent_rows, (select count(*) from {n} x) as referenced_parents, {unused} as unreferenced_parents,
      {share(f'(select count(*) from {n} x)', f'(select count(*) from {p})', 2)} as parent_coverage_pct,
      (select round(avg(n), 2) from {n} x) as avg_children, (select round(quantile_cont(n, 0.5), 2) from {n} x) as median_children,
      (select round(quantile_cont(n, 0.95), 2) from {n} x) as p95_children, (select max(n) from {n} x) as max_children,
      round({expected}, 2) as expected_unreferenced, round({unused} - {expected}, 2) + 0.0 as observed_minus_expected from {c}"""


ORACLE["rel_foreign_keys"] = union(fk(*r) for r in FOREIGN_KEYS)


def key_check(view: str, table: str, keys) -> str:
    return (f"select '{table}' as table_name, count(*) as row_count, "
            f"(select cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from {view} group by {', '.join(keys)} having count(*) > 1) k) "
            f"as rows_in_duplicate_keys, count(*) filter ({' or '.join(f'{k} is null' for k in keys)}) as rows_with_null_key from {view}")


ORACLE["dq_silver_keys"] = on_silver("\nunion all\n".join(
    [key_check(f"s_{t}", t, primary_key(t)) for t in SOURCES]
    + [key_check("s_enrollment_grade_summary", "enrollment_grade_summary", ["enrollment_id"])]))
ORACLE["dq_gold_keys"] = on_gold("\nunion all\n".join(key_check(t, t, [k]) for t, k in GOLD_KEYS.items()))


def orphans(child: str, key: str, parent: str, pk: str, prefix: str) -> str:
    return (f"select '{child}.{key} -> {parent}.{pk}' as relation, count(*) as orphans from {prefix}{child} "
            f"where {key} is not null and {key} not in (select {pk} from {prefix}{parent})")


ORACLE["dq_silver_references"] = on_silver("\nunion all\n".join(orphans(*r, "s_") for r in FOREIGN_KEYS))
ORACLE["dq_gold_references"] = on_gold("\nunion all\n".join(orphans(*r, "") for r in GOLD_FOREIGN_KEYS))
ORACLE["dq_row_rules"] = on_silver("\nunion all\n".join(
    f"select '{t}' as table_name, '{label}' as rule, count(*) filter (not ({rule})) as violations from s_{t}" for t, label, rule in ROW_RULES))
ORACLE["dq_required"] = on_silver("\nunion all\n".join(
    f"select '{t}' as table_name, '{c}' as column_name, count(*) filter ({c} is null) as nulls from s_{t}"
    for t, columns in REQUIRED.items() for c in columns))
ORACLE["dq_overflow"] = on_silver("""
select 'enrollment_grade_summary' as table_name, 'n_grades' as column_name, count(*) filter (n_grades > 32767) as overflows from s_enrollment_grade_summary
union all select 'enrollment_grade_summary', 'weight_sum', count(*) filter (abs(weight_sum) >= 1000) from s_enrollment_grade_summary
union all select 'billing_invoices', 'total', count(*) filter (abs(total) >= 10000000000) from s_billing_invoices""")


def checked(section: str, label: str, got: str, expected: str = "0") -> str:
    return (f"select '{section}' as section, '{label}' as label, cast(({got}) as bigint) as got, cast(({expected}) as bigint) as expected, "
            f"({got}) = ({expected}) as ok")


ORACLE["gate_silver_rows"] = on_silver("\nunion all\n".join(
    checked("rows", t, f"select count(*) from s_{t}", f"select count(*) from {t}") for t in SOURCES))
ORACLE["gate_silver_flags"] = on_silver("\nunion all\n".join(
    "select '{0}.{1}' as label, count(*) filter ({2}) as got, (select count(*) from {3}) // 10 as expected, "
    "count(*) filter ({2}) = (select count(*) from {3}) // 10 as ok from s_{0}".format(
        t, flag.replace("'", "''"), flag, t if t in SOURCES else "university_grades") for t, flag, _ in FLAGS))
ORACLE["gate_silver_derived"] = on_silver("\nunion all\n".join((
    checked("derived", "invoices without total = without items",
            "select count(*) filter (total is null) - count(*) filter (has_no_items) from s_billing_invoices"),
    checked("derived", "invoices without payment band", "select count(*) from s_billing_invoices where payment_status_derived is null"),
    checked("derived", "subscriptions without end = inverted",
            "select count(*) filter (end_date is null) - count(*) filter (invalid_date_range) from s_billing_subscriptions"),
    checked("derived", "summaries without weighted score",
            "select count(*) from s_enrollment_grade_summary where final_score_weighted is null"),
    checked("derived", "scores outside 0..100", "select count(*) from s_university_grades where score < 0 or score > 100"))))
ORACLE["gate_gold_integrity"] = on_gold("\nunion all\n".join(
    checked("integrity", f"{c}.{k}", f"select count(*) from {c} where {k} is null or {k} not in (select {pk} from {p})")
    for c, k, p, pk in (
        ("fact_enrollment", "student_id", "dim_student", "student_id"), ("fact_enrollment", "enrolled_date", "dim_date", "date_key"),
        ("fact_invoice", "customer_id", "dim_customer", "customer_id"), ("fact_subscription", "product_id", "dim_product", "product_id"),
        ("fact_opportunity", "account_id", "dim_account", "account_id"))))
ORACLE["gate_gold_consistency"] = on_gold("\nunion all\n".join((
    checked("consistency", "fact_invoice rows", "select count(*) from fact_invoice", "select count(*) from s_billing_invoices"),
    checked("consistency", "fact_payment rows", "select count(*) from fact_payment", "select count(*) from s_billing_payments"),
    checked("consistency", "fact_enrollment rows", "select count(*) from fact_enrollment",
            "select count(*) from s_university_enrollments where is_duplicate_survivor"),
    checked("consistency", "invoiced_amount blanks", "select count(*) from fact_invoice where invoiced_amount is null"))))
ORACLE["gate_gold_rows"] = on_gold("\nunion all\n".join(
    checked("rows", g, f"select count(*) from {g}", f"select count(*) from {t}") for g, t in {
        "dim_student": "customer", "dim_customer": "customer", "dim_product": "part", "dim_course": "part",
        "dim_account": "supplier", "fact_invoice": "orders", "fact_subscription": "orders", "fact_opportunity": "part",
        "fact_activity": "events", "fact_lead": "documents", "fact_payment": "lineitem", "dim_semester": "university_semesters",
        "fact_enrollment": "(select distinct student_id, course_id, semester_id from university_enrollments) x",
        "dim_date": "(select unnest(generate_series(make_date(year(min(o_orderdate)) - 1, 1, 1), make_date(year(max(o_orderdate)) + 1, 12, 31), interval 1 day)) "
                    "from orders) x"}.items()))
ORACLE["gate_kpi_totals"] = on_kpi("\nunion all\n".join(checked("kpi", f"{k}: {label}", got, expected) for k, label, got, expected in (
    ("kpi_revenue_monthly", "invoices", "select sum(invoices) from kpi_revenue_monthly", "select count(*) from orders"),
    ("kpi_revenue_monthly", "currencies", "select count(distinct currency) from kpi_revenue_monthly",
     "select count(distinct currency) from billing_invoices"),
    ("kpi_collection_by_currency", "paid invoices", "select sum(paid_invoices) from kpi_collection_by_currency",
     "select count(*) from orders where o_orderstatus = ''F''".replace("''", "'")),
    ("kpi_academic_by_department", "enrollments", "select sum(enrollments) from kpi_academic_by_department",
     "select count(*) from (select distinct student_id, course_id, semester_id from university_enrollments) g"),
    ("kpi_subscription_status", "active", "select sum(subscriptions) from kpi_subscription_status where status = 'active'",
     "select count(*) from billing_subscriptions where status = 'active'"),
    ("kpi_sales_pipeline", "won", "select sum(opportunities) from kpi_sales_pipeline where stage = 'won'",
     "select count(*) from crm_opportunities where stage = 'won'"),
    ("kpi_sales_pipeline", "lost", "select sum(opportunities) from kpi_sales_pipeline where stage = 'lost'",
     "select count(*) from crm_opportunities where stage = 'lost'"),
    ("kpi_lead_funnel", "converted", "select sum(leads) from kpi_lead_funnel where status = 'converted'",
     "select count(*) from crm_leads where status = 'converted'"),
    ("kpi_student_vs_external", "invoices", "select sum(invoices) from kpi_student_vs_external", "select count(*) from orders"))))

_sql, _extra = deciles("orders", "o_orderstatus", "o_totalprice")
ORACLE["stat_decile_association"] = f"with {_extra}\n{_sql}"
ORACLE["stat_decile_counts"] = f"with {_extra}\nselect b as decile, count(*) as n from binned group by 1"
ORACLE["stat_cramers_v"] = v_of("orders", "o_orderstatus", "o_orderpriority")
ORACLE["stat_pearson"] = "select round(corr(l_quantity, l_extendedprice), 4) as pearson from lineitem"
ORACLE["stat_spearman"] = "select " + rank_corr("lineitem", "l_quantity", "l_extendedprice", "spearman")
ORACLE["stat_histogram"] = """
select cast(least(60, floor((x - lo) / ((hi - lo) / 60.0)) + 1) as bigint) as bin, count(*) as n
from (select l_extendedprice as x, min(l_extendedprice) over () as lo, max(l_extendedprice) over () as hi from lineitem) k group by 1"""
ORACLE["stat_share_match"] = """
select round(sum(p * q), 9) as probability from (select c_nationkey as k, count(*) / sum(count(*)) over () as p from customer group by 1) a
join (select s_nationkey as k, count(*) / sum(count(*)) over () as q from supplier group by 1) b using (k)"""
ORACLE["stat_quantiles_by_priority"] = "select o_orderpriority, " + ", ".join(
    f"round(quantile_cont(o_totalprice, {p}), 4) as {n}" for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.95, "p95"))
) + " from orders group by 1"
ORACLE["ranks_by_value"] = """
select l_extendedprice as value, cast(count(*) as bigint) as n,
       cast(sum(count(*)) over (order by l_extendedprice) as double) - count(*) + (count(*) + 1) / 2.0 as "rank"
from lineitem group by 1"""
ORACLE["ingest_row_hash"] = f"""with {RAW}
select customer_id, sha256(cast(to_json([{', '.join(SOURCES['billing_customers'][1])}]) as varchar)) as row_hash from billing_customers"""

PROPOSED = {
    "crm_activities": """
select activity_id, case when contact_id is not null and opportunity_id is not null then 'both' when contact_id is not null then 'contact_only'
         when opportunity_id is not null then 'opportunity_only' else 'unlinked' end as activity_scope,
       exists (select 1 from s_crm_opportunity_contacts b where b.opportunity_id = a.opportunity_id and b.contact_id = a.contact_id)
         as activity_pair_exists_in_bridge
from s_crm_activities a""",
    "university_enrollments": """
select enrollment_id, status = 'completed' and not has_grades as completed_without_grades,
       enrollment_id in (select enrollment_id from s_university_grades where assessment = 'final') as has_final_assessment,
       not enrolled_at_out_of_window and not coalesce(e.enrolled_at_raw < st.enrolled_at, false) as is_temporally_consistent
from s_university_enrollments e left join s_university_students st using (student_id)""",
    "enrollment_grade_summary": """
select enrollment_id, case when w = 1000 then 'exact' when abs(w - 1000) <= 10 then 'within_tolerance' when w < 1000 then 'below' else 'above' end
         as grade_weight_status
from g_sums""",
    "billing_customers": """
select customer_id, external_ref is not null as has_student_reference,
       coalesce(lower(trim(c.email)) <> lower(trim(s.email)) or lower(trim(c.first_name)) <> lower(trim(s.first_name))
         or lower(trim(c.last_name)) <> lower(trim(s.last_name)) or c.country <> s.country, false) as person_attributes_mismatch
from s_billing_customers c left join s_university_students s on c.external_ref = s.student_id""",
    "billing_invoices": """
select invoice_id,
       coalesce(currency = map {'CL': 'CLP', 'PE': 'PEN', 'AR': 'ARS', 'MX': 'MXN', 'BR': 'BRL', 'ES': 'EUR', 'CO': 'COP', 'US': 'USD'}[country], false)
         as country_currency_match,
       case when total is null then 'no_items' when total > total_reported then 'lines_greater' when total < total_reported then 'lines_less'
            else 'equal' end as invoice_line_reconciliation_status,
       case when p.v is null then 'unpaid' when p.v > total_reported then 'paid_greater' when p.v < total_reported then 'paid_less' else 'equal' end
         as payment_reconciliation_status,
       not coalesce(due_at < issued_at or cast(issued_at as timestamp) < cast(c.created_at as timestamp), false) as is_temporally_consistent
from s_billing_invoices i left join s_billing_customers c using (customer_id)
left join (select invoice_id, sum(amount) as v from s_billing_payments group by 1) p using (invoice_id)""",
    "billing_invoice_items": """
select invoice_item_id, case when h.inside then 'inside_contract' when h.inside is not null then 'subscribed' else 'never_subscribed' end
         as item_subscription_match_status
from s_billing_invoice_items t join s_billing_invoices i using (invoice_id)
left join (select i.customer_id, x.product_id, i.issued_at, bool_or(i.issued_at between s.start_date and s.end_date_raw) as inside
           from s_billing_invoice_items x join s_billing_invoices i using (invoice_id)
           join s_billing_subscriptions s on s.customer_id = i.customer_id and s.product_id = x.product_id group by 1, 2, 3) h
  on h.customer_id = i.customer_id and h.product_id = t.product_id and h.issued_at = i.issued_at""",
    "billing_subscriptions": """
select subscription_id, not invalid_date_range and not coalesce(cast(start_date as timestamp) < cast(created_at as timestamp), false)
         as is_temporally_consistent
from s_billing_subscriptions left join s_billing_customers using (customer_id)""",
}
for _table, _sql in PROPOSED.items():
    ORACLE[f"proposed_{_table}"] = on_silver(_sql)

VIEWS = (
    "kpi_revenue_monthly", "kpi_collection_by_currency", "kpi_academic_by_department", "kpi_subscription_status", "kpi_sales_pipeline",
    "kpi_lead_funnel", "kpi_student_vs_external", "kpi_mrr_breakdown", "kpi_lead_by_source", "kpi_headline")
ORACLE["layer_inventory"] = on_kpi("\nunion all\n".join(
    f"select '{layer}' as layer, '{kind}' as kind, '{name}' as object, count(*) as row_count from {prefix}{name}"
    for layer, kind, prefix, names in (("silver", "table", "s_", [*SOURCES, "enrollment_grade_summary"]), ("gold", "table", "", GOLD_KEYS),
                                       ("gold", "view", "", VIEWS)) for name in names))
SUMS = {"fact_invoice.invoiced_amount": "cast(sum(invoiced_amount) * 1000 as bigint)",
        "fact_enrollment.final_score": "cast(round(sum(cast(final_score as decimal(12,3))) * 1000) as bigint)"}
ORACLE["export_parity"] = on_kpi("\nunion all\n".join(
    [checked("rows", n, f"select count(*) from {n}", f"select count(*) from {n}") for n in (
        "dim_customer", "dim_semester", "fact_enrollment", "fact_invoice", "kpi_revenue_monthly")]
    + [checked("content", n, "select 0", "select 0") for n in ("dim_customer", "dim_semester", "fact_enrollment", "fact_invoice", "kpi_revenue_monthly")]
    + [checked("sums", label, f"select {e} from {label.split('.')[0]}", f"select {e} from {label.split('.')[0]}") for label, e in SUMS.items()]))
ORACLE["refresh_versions"] = on_silver("\nunion all\n".join(
    f"select '{seen}' as seen, '{name}' as object, count(*) as row_count from {table}" for seen in ("before", "between", "after")
    for name, table in (("invoices", "s_billing_invoices" + (" where status = 'paid'" if seen == "after" else "")), ("customers", "s_billing_customers"))))
ORACLE["ledger_totals"] = f"""with {RAW}
select 3 as versions, 2 as loaded, 1 as failed, 0 as unfinished, n as loaded_rows, n as expected_rows
from (select count(*) + count(*) filter (external_ref <> '') as n from billing_customers)"""
ORACLE["ingest_twice"] = """
select 1 as attempt, 'loaded' as status, count(*) as row_count, 0 as differing_rows from customer
union all select 2, 'skipped', count(*), 0 from customer"""

ORACLE["ledger_listing"] = """
select 'billing' as source_domain, 'customers' as source_table, count(*) as expected_rows, count(*) as loaded_rows, 'success' as status,
       12 as prefix_length, 0 as broken_rules from customer
union all select 'billing', 'products', count(*), count(*), 'success', 12, 0 from part"""

"""Independent SQL for the checks over sources with faults, and for cells that do not parse."""

from __future__ import annotations

import probes.oracle_audits  # noqa: F401  (adds its SQL)
import probes.oracle_checks  # noqa: F401
import probes.oracle_insights  # noqa: F401
from probes import dirty
from probes.bindings import AS_OF
from probes.oracle import ORACLE, RAW
from probes.queries import DIRTY_QUERIES
from strata.catalog import SOURCES

RAW_DIRTY, RAW_TEXT = dirty.ctes(dirty.DIRTY), dirty.ctes(dirty.TEXT)
for _name in DIRTY_QUERIES:
    ORACLE[f"dirty_{_name}"] = ORACLE[_name].replace(RAW, RAW_DIRTY)

ORACLE["dirty_profile_parse_issues"] = ORACLE["profile_parse_issues"].replace(RAW, RAW_TEXT)


def _value(column: str, kind: str) -> str:
    return f"(case {column} when 'True' then true when 'False' then false end)" if kind == "boolean" else f"try_cast(nullif({column}, '') as {kind})"


TYPED_COLUMNS = [(t, c, k) for t, (_, columns) in SOURCES.items() for c, k in columns.items() if k != "string"]
BAD = {(t, c): f"(nullif({c}, '') is not null and {_value(c, k)} is null)" for t, c, k in TYPED_COLUMNS}
KEYS = {"crm_opportunity_contacts": "opportunity_id || ':' || contact_id"}
ORACLE["reject_cells"] = f"with {RAW_TEXT}\n" + "\nunion all\n".join(
    f"select '{t}' as table_name, '{c}' as column_name, '{k}' as kind, count(*) as cells, min({c}) as sample, min({KEYS.get(t, SOURCES[t][0][0])}) as first_place, "
    f"max({KEYS.get(t, SOURCES[t][0][0])}) as last_place from {t} where {BAD[t, c]} having count(*) > 0" for t, c, k in TYPED_COLUMNS)
ORACLE["reject_gate"] = f"with {RAW_TEXT}\n" + "\nunion all\n".join(
    f"select 'rejects' as section, '{t} rows with cells that do not parse' as label, case when n > 0.02 * a then n else 0 end as got, not n > 0.02 * a as ok "
    f"from (select count(*) as a, count(*) filter ({' or '.join([BAD[x, c] for x, c, _ in TYPED_COLUMNS if x == t] or ['false'])}) as n from {t})" for t in SOURCES)
ORACLE["reject_typed_values"] = f"with {RAW_TEXT}\n" + "\nunion all\n".join(
    f"select '{t}' as table_name, '{c}' as column_name, count({_value(c, k)}) as filled from {t}" for t, c, k in TYPED_COLUMNS)
ORACLE["reject_silver_invoices"] = f"""with {RAW_TEXT},
i as (select invoice_id, try_cast(due_at as date) as due, try_cast(total as decimal(12,2)) as total, status from billing_invoices),
p as (select invoice_id, count(*) as n, sum(try_cast(amount as decimal(12,2))) as paid from billing_payments group by 1)
select case when paid is null then 'unpaid' when paid - total > 0.01 then 'overpaid' when total - paid > 0.01 then 'partial' else 'full' end as payment_status_derived,
       coalesce(due < date '{AS_OF}' and status <> 'paid', false) as is_past_due, due is not null as has_due, total is not null as has_total, count(*) as invoices
from i left join p using (invoice_id) group by all"""


def _rows(section: str, name: str, query: str, dims: tuple[str, ...] = ()) -> str:
    """The numbers of a query's result as rows of the audit document."""
    shown = " || ', ' || ".join(f"'{d}=' || {d}" for d in sorted(dims)) or "''"
    wide = f"select {shown} as __dims, columns(* exclude ({', '.join(dims)}))::double from ({query}) x" if dims else f"select '' as __dims, columns(*)::double from ({query}) x"
    return f"""select '{section}' as section, '{name}' as name, __dims as dims, metric, number, cast(null as varchar) as text
from ({wide}) w unpivot include nulls (number for metric in (columns(* exclude (__dims))))"""


ORACLE["audit_document"] = "\nunion all\n".join([
    f"select 'metadata' as section, 'audit' as name, '' as dims, 'as_of' as metric, cast(null as double) as number, '{AS_OF}' as text",
    *[f"select 'metadata', 'audit', '', '{m}', {n}, null" for m, n in (("sources", 18), ("relations", 18))],
    _rows("structure", "all", ORACLE["dirty_profile_structure"]), _rows("structure", "tables", ORACLE["dirty_profile_tables"], ("table_name",)),
    _rows("structure", "parse_issues", ORACLE["profile_parse_issues"].replace(RAW, RAW_DIRTY), ("table_name", "column_name", "kind")),
    _rows("relations", "foreign_keys", ORACLE["dirty_rel_foreign_keys"], ("relation",)),
    _rows("evidence", "evi_occupancy", ORACLE["evi_occupancy"].replace(RAW, RAW_DIRTY), ("relation",)),
    _rows("evidence", "evi_activity_missingness", ORACLE["evi_activity_missingness"].replace(RAW, RAW_DIRTY)),
    _rows("evidence", "evi_matches", ORACLE["evi_matches"].replace(RAW, RAW_DIRTY), ("evidence",))])

"""All registered queries: the library's operators, layers and reports over the bound test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probes import dirty
from probes.bindings import AS_OF, TestTables, bronze
from strata.catalog import DATE_KINDS, NUMBER_KINDS, SOURCES, SourceSpec, columns_of, primary_key
from strata.functions.text import row_hash
from strata.operators import profile, stats
from strata.operators.dedupe import duplicate_counts
from strata.operators.quality import same_rows, union_all
from strata.operators.quantiles import ValueCounts, exact_quantiles
from strata.plans import document, export, kpi, validators
from strata.plans.audits import billing, crm, crossdomain, university
from strata.plans.gold import gold
from strata.plans.insights import INSIGHTS, Model
from strata.plans.layer import Layer
from strata.plans.proposed import PROPOSED
from strata.plans.rejects import Accepted, accept, check_rejects
from strata.plans.silver import grade_summary, silver
from strata.plans.typed import issues, typed
from strata.session import shared_folder
from strata.plans.versions import Draft, read_layer
from strata.sources.delimited import SourceError
from strata.sources.ledger import batch_listing, current, ingest, read_bronze, totals


class Context:
    """The bound layers over one folder of test tables; with ``selects`` (``dirty``) over sources with faults."""

    def __init__(self, spark: SparkSession, folder: str, selects: dict[str, str] | None = None):
        self.spark, self.folder = spark, folder
        self.tables = TestTables(spark, folder)
        self.bronze = bronze(self.tables) if selects is None else dirty.over(spark, bronze(self.tables), selects)
        self.typed = typed(self.bronze)
        self.silver = silver(self.bronze, AS_OF)
        # Every date the facts refer to lies between the first order and the last shipment or contract end.
        span = self.tables["orders"].agg(
            F.make_date(F.year(F.min("o_orderdate")) - 1, F.lit(1), F.lit(1)).alias("first_day"),
            F.make_date(F.year(F.max("o_orderdate")) + 1, F.lit(12), F.lit(31)).alias("last_day"))
        self.gold = gold(self.silver, span)
        self.model = Model(self.silver, self.gold, AS_OF)


def comparable(df: DataFrame) -> DataFrame:
    """Plain result types: whole numbers as BIGINT, decimals as DOUBLE, timestamps as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


QUERIES: dict[str, Callable[[Context], DataFrame]] = {}


def query(name: str):
    def add(build: Callable[[Context], DataFrame]):
        QUERIES[name] = build
        return build
    return add


for _table in silver(Layer({})):
    QUERIES[f"silver_{_table}"] = lambda c, n=_table: c.silver[n]
for _table in gold(Layer({}), None):
    QUERIES[f"gold_{_table}"] = lambda c, n=_table: c.gold[n]
for _name, _build in {**kpi.KPIS, **kpi.CHARTS}.items():
    QUERIES[_name] = lambda c, f=_build: f(c.gold)
for _audits in (university, billing, crm, crossdomain):
    for _name, _build in _audits.AUDITS.items():
        QUERIES[_name] = lambda c, f=_build: f(c.typed, AS_OF)
for _name, _build in INSIGHTS.items():
    QUERIES[_name] = lambda c, f=_build: f(c.model)


@query("silver_grade_summary_fine_weights")
def silver_grade_summary_fine_weights(c: Context) -> DataFrame:
    """The grade summary of weights with five decimals, which no column type of Silver holds."""
    fine = "cast(weight as decimal(9,5)) + cast(length(grade_id) % 7 * 333 as decimal(9,0)) * cast(0.00001 as decimal(9,5))"
    return grade_summary(c.bronze["university_grades"].withColumn("weight", F.expr(fine)))


# ------------------------------------------------------------------ profiles

def _per_table(c: Context, build) -> DataFrame:
    return union_all(frame for frame in (build(c.typed[t], t) for t in SOURCES) if frame is not None)


def _dates(df: DataFrame, table: str) -> DataFrame | None:
    columns = list(columns_of(table, *DATE_KINDS))
    return profile.date_summary(df, columns, table, AS_OF) if columns else None


def _categories(df: DataFrame, table: str) -> DataFrame:
    dates = set(columns_of(table, *DATE_KINDS))
    return profile.small_categories(df, [c for c in df.columns if c not in dates], table)


@query("profile_columns")
def profile_columns(c: Context) -> DataFrame:
    return _per_table(c, profile.column_basics)


@query("profile_tables")
def profile_tables(c: Context) -> DataFrame:
    return _per_table(c, lambda df, t: profile.table_shape(df, t, primary_key(t)))


@query("profile_structure")
def profile_structure(c: Context) -> DataFrame:
    return profile_tables(c).agg(
        F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("row_count"), F.sum("column_count").alias("column_count"),
        F.sum("missing_cells").alias("missing_cells"), F.sum("exact_duplicate_rows").alias("exact_duplicate_rows"),
        F.sum("rows_in_duplicated_keys").alias("rows_in_duplicated_keys"))


@query("profile_numbers")
def profile_numbers(c: Context) -> DataFrame:
    return profile.number_summary({t: (c.typed[t], list(columns_of(t, *NUMBER_KINDS))) for t in SOURCES})


@query("profile_dates")
def profile_dates(c: Context) -> DataFrame:
    return _per_table(c, _dates)


@query("profile_categories")
def profile_categories(c: Context) -> DataFrame:
    return _per_table(c, _categories)


@query("profile_emails")
def profile_emails(c: Context) -> DataFrame:
    return _per_table(c, lambda df, t: profile.email_quality(df, "email", t) if "email" in df.columns else None)


@query("profile_parse_issues")
def profile_parse_issues(c: Context) -> DataFrame:
    return issues(c.bronze)


@query("profile_document_copies")
def profile_document_copies(c: Context) -> DataFrame:
    """Documents whose whole text, in lower case, occurs more than once."""
    prints = c.tables["documents"].select(F.sha2(F.lower("text"), 256).alias("print"))
    return duplicate_counts(prints, ["print"])


@query("audit_document")
def audit_document(c: Context) -> DataFrame:
    """Structure, relations and evidence of the audit, written as a JSON document and read back."""
    draft = document.write_document(c.spark, Context(c.spark, c.folder, dirty.DIRTY).bronze, AS_OF, f"{shared_folder(c.spark)}/audit-{uuid.uuid4()}",
                                    ["metadata", "structure", "relations", "evidence"])
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("dims")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")
    return document.read_document(draft).where("metric <> 'generated'").select("section", "name", shown.alias("dims"), "metric", "number", "text")


# ------------------------------------------------------------------ references, rules and gates

QUERIES["rel_foreign_keys"] = lambda c: validators.relationship_audit(c.typed)
QUERIES["dq_silver_keys"] = lambda c: validators.silver_keys(c.silver)
QUERIES["dq_gold_keys"] = lambda c: validators.gold_keys(c.gold)
QUERIES["dq_silver_references"] = lambda c: validators.silver_references(c.silver)
QUERIES["dq_gold_references"] = lambda c: validators.gold_references(c.gold)
QUERIES["dq_row_rules"] = lambda c: validators.silver_row_rules(c.silver)
QUERIES["dq_required"] = lambda c: validators.silver_required(c.silver)
QUERIES["dq_overflow"] = lambda c: validators.silver_overflow(c.silver)
QUERIES["gate_silver_rows"] = lambda c: validators.silver_rows(c.bronze, c.silver)


@query("gate_silver_flags")
def gate_silver_flags(c: Context) -> DataFrame:
    """Flag counts against one expected for each: a tenth of the table's rows. The verdicts differ, as the flags do."""
    rows = {t: c.bronze[t if t in SOURCES else "university_grades"].count() // 10 for t in {t for t, _, _ in validators.FLAGS}}
    return validators.silver_flags(c.silver, {(t, flag): rows[t] for t, flag, _ in validators.FLAGS}).select("label", "got", "expected", "ok")


QUERIES["gate_silver_derived"] = lambda c: validators.silver_derived(c.silver)
QUERIES["gate_gold_integrity"] = lambda c: validators.gold_integrity(c.gold)
QUERIES["gate_gold_consistency"] = lambda c: validators.gold_consistency(c.silver, c.gold)


@query("gate_gold_rows")
def gate_gold_rows(c: Context) -> DataFrame:
    """Dimensions and facts against the tables they come from."""
    base = {
        "dim_student": "customer", "dim_customer": "customer", "dim_product": "part", "dim_course": "part",
        "dim_account": "supplier", "fact_invoice": "orders", "fact_subscription": "orders", "fact_opportunity": "part",
        "fact_activity": "events", "fact_lead": "documents",
    }
    count = F.count(F.lit(1))
    orders = c.tables["orders"].agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    sections = c.bronze["university_enrollments"].select("student_id", "course_id", "semester_id").distinct()
    days = F.datediff(F.make_date(F.year("b") + 1, F.lit(12), F.lit(31)), F.make_date(F.year("a") - 1, F.lit(1), F.lit(1))) + 1
    expected = {g: F.lit(c.tables[t].agg(count).scalar()) for g, t in {**base, "fact_payment": "lineitem"}.items()}
    expected |= {"dim_semester": F.lit(c.bronze["university_semesters"].agg(count).scalar()), "fact_enrollment": F.lit(sections.agg(count).scalar()),
                 "dim_date": F.lit(orders.select(days).scalar())}
    return validators.gold_rows(c.gold, expected)


@query("gate_kpi_totals")
def gate_kpi_totals(c: Context) -> DataFrame:
    """KPI totals against direct counts on the bound sources."""
    b, typed_ = c.bronze, c.typed
    count = F.count(F.lit(1))
    of = lambda df: F.lit(df.agg(count).scalar())
    invoices = b["billing_invoices"]
    stage = typed_["crm_opportunities"]
    groups = typed_["university_enrollments"].select("student_id", "course_id", "semester_id").distinct()
    return validators.kpi_totals(c.gold, [
        of(invoices), F.lit(invoices.agg(F.count_distinct("currency")).scalar()), of(invoices.where("status = 'paid'")),
        of(groups), of(typed_["billing_subscriptions"].where("status = 'active'")), of(stage.where("stage = 'won'")),
        of(stage.where("stage = 'lost'")), of(typed_["crm_leads"].where("status = 'converted'")), of(invoices)])


# ------------------------------------------------------------------ statistics straight on the test tables

@query("stat_decile_counts")
def stat_decile_counts(c: Context) -> DataFrame:
    binned = stats.add_decile(c.tables["orders"], "o_totalprice")
    return binned.groupBy("decile").agg(F.count(F.lit(1)).alias("n"))


QUERIES["stat_cramers_v"] = lambda c: stats.cramers_v(c.tables["orders"], "o_orderstatus", "o_orderpriority")
QUERIES["stat_decile_association"] = lambda c: stats.decile_association(
    c.tables["orders"], "o_orderstatus", "o_totalprice", "cramers_v")
QUERIES["stat_pearson"] = lambda c: stats.safe_corr(c.tables["lineitem"], "l_quantity", "l_extendedprice", name="pearson")
QUERIES["stat_spearman"] = lambda c: stats.safe_corr(
    c.tables["lineitem"], "l_quantity", "l_extendedprice", "spearman", "spearman")
QUERIES["stat_histogram"] = lambda c: stats.histogram(c.tables["lineitem"], "l_extendedprice", 60)


@query("stat_share_match")
def stat_share_match(c: Context) -> DataFrame:
    return stats.share_match(c.tables["customer"], "c_nationkey", c.tables["supplier"], "s_nationkey").select(
        F.round("probability", 9).alias("probability"))


@query("stat_quantiles_by_priority")
def stat_quantiles_by_priority(c: Context) -> DataFrame:
    return exact_quantiles(c.tables["orders"], "o_totalprice", [0.25, 0.5, 0.75, 0.95], ["p25", "p50", "p75", "p95"],
                           ["o_orderpriority"])


@query("ranks_by_value")
def ranks_by_value(c: Context) -> DataFrame:
    """Average rank of every distinct line price, through the bucketed path that large tables take."""
    return ValueCounts(c.tables["lineitem"], "l_extendedprice").ranked()


@query("ingest_row_hash")
def ingest_row_hash(c: Context) -> DataFrame:
    """Row fingerprints of the customer source."""
    rows = c.bronze["billing_customers"]
    return rows.select("customer_id", row_hash(rows.columns).alias("row_hash"))


for _name, _build in PROPOSED.items():
    QUERIES[f"proposed_{_name}"] = lambda c, f=_build: f(c.silver)


@query("layer_inventory")
def layer_inventory(c: Context) -> DataFrame:
    """Rows per object of Silver and Gold, views included."""
    views = Layer({name: (lambda f=f: f(c.gold)) for name, f in kpi.KPIS.items()})
    return union_all((export.inventory(c.silver, "silver"), export.inventory(c.gold, "gold"),
                      export.inventory(views, "gold", lambda name: "view")))


@query("export_parity")
def export_parity(c: Context) -> DataFrame:
    """Gold written to the shared folder and read back: rows per object and the checked sums."""
    folder = f"{shared_folder(c.spark)}/export-{uuid.uuid4()}"
    names = ("dim_customer", "dim_semester", "fact_enrollment", "fact_invoice")
    written = Layer({**{n: (lambda n=n: c.gold[n]) for n in names}, "kpi_revenue_monthly": lambda: kpi.revenue_monthly(c.gold)})
    export.export_layer(c.spark, written, folder, "gold")
    return export.check_published(c.spark, folder)


@query("refresh_versions")
def refresh_versions(c: Context) -> DataFrame:
    """Two refreshes of a layer, the second with the paid invoices only and not published before it was read: rows readers see before, between and after."""
    folder = f"{shared_folder(c.spark)}/versions-{uuid.uuid4()}"
    invoices, customers = c.silver["billing_invoices"], c.silver["billing_customers"]
    first = Draft(c.spark, folder).write({"invoices": invoices, "customers": customers})
    first.publish()
    draft = Draft(c.spark, folder).write({"invoices": invoices.where("status = 'paid'"), "customers": customers})
    between = read_layer(c.spark, folder)
    draft.publish()
    seen = {"before": read_layer(c.spark, folder, version=first.version), "between": between, "after": read_layer(c.spark, folder)}
    return union_all(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(when).alias("seen"), F.lit(name).alias("object"), "row_count")
                     for when, layer in seen.items() for name, df in layer.items())


@query("ledger_listing")
def ledger_listing(c: Context) -> DataFrame:
    """Two sources loaded from folders of files parsed in blocks; the ledger as analysts list it, with the number of rules it breaks."""
    folder = f"{shared_folder(c.spark)}/ledger-{uuid.uuid4()}"
    for table in ("customers", "products"):
        source = c.bronze[f"billing_{table}"]
        source.write.csv(f"{folder}/raw/{table}", header=True, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        spec = SourceSpec("billing", table, tuple(source.columns), source.count(), f"{folder}/raw/{table}", line_breaks=False)
        ingest(c.spark, spec, f"{folder}/bronze", f"{folder}/ledger")
    broken = validators.check_ledger(current(c.spark, f"{folder}/ledger")).agg(F.count_if(~F.col("ok"))).scalar()
    return batch_listing(c.spark, f"{folder}/ledger").select(
        "source_domain", "source_table", "expected_rows", "loaded_rows", "status", F.length("checksum_prefix").alias("prefix_length"), broken.alias("broken_rules"))


@query("ledger_totals")
def ledger_totals(c: Context) -> DataFrame:
    """The ledger after a load, a load of other content, a failed one and a repeated one: file versions by state and the rows loaded."""
    folder = f"{shared_folder(c.spark)}/totals-{uuid.uuid4()}"

    def spec(table: str, rows: DataFrame, part: int, more: int = 0) -> SourceSpec:
        path = f"{folder}/raw/{table}-{part}"
        rows.write.csv(path, header=True, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        return SourceSpec("billing", table, tuple(rows.columns), rows.count() + more, path)

    customers, products = c.bronze["billing_customers"], c.bronze["billing_products"]
    loads = [spec("customers", customers, 1), spec("customers", customers.where("external_ref <> ''"), 2), spec("products", products, 1, more=1)]
    for one in (*loads, loads[0]):
        try:
            ingest(c.spark, one, f"{folder}/bronze", f"{folder}/ledger")
        except SourceError:  # the products: one row more is expected than there are
            continue
    return totals(c.spark, f"{folder}/ledger")


@query("ingest_twice")
def ingest_twice(c: Context) -> DataFrame:
    """The customer source written as delimited text, loaded twice and compared with its own rows."""
    folder = f"{shared_folder(c.spark)}/ingest-{uuid.uuid4()}"
    source = c.bronze["billing_customers"]
    source.write.csv(f"{folder}/raw", header=True, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False,
                     ignoreTrailingWhiteSpace=False)
    spec = SourceSpec("billing", "customers", tuple(source.columns), source.count(), f"{folder}/raw")
    loads = [ingest(c.spark, spec, f"{folder}/bronze", f"{folder}/ledger") for _ in range(2)]
    stored = read_bronze(c.spark, f"{folder}/bronze", f"{folder}/ledger", spec)
    wanted = source.select("customer_id", row_hash(source.columns).alias("_row_hash"))
    found = same_rows(wanted, stored, ["customer_id", "_row_hash"])
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("attempt"), F.lit(r.status).alias("status"), F.lit(r.rows).cast("bigint").alias("row_count"),
                 F.col("differing_rows").alias("differing_rows")) for i, r in enumerate(loads)])))


def _accepted(c: Context) -> Accepted:
    """The sources as text, some cells of which do not parse, typed with their rejects."""
    return accept(c.spark, Context(c.spark, c.folder, dirty.WIDE_TEXT).bronze, f"{shared_folder(c.spark)}/rejects-{uuid.uuid4()}")


@query("reject_cells")
def reject_cells(c: Context) -> DataFrame:
    """Rejected cells by column, with the first and last place."""
    return _accepted(c).cells.groupBy("table_name", "column_name", "kind").agg(
        F.count(F.lit(1)).alias("cells"), F.min("value").alias("sample"), F.min("place").alias("first_place"), F.max("place").alias("last_place"))


@query("reject_gate")
def reject_gate(c: Context) -> DataFrame:
    """Rows with a rejected cell, per source, where they are more than one row in fifty."""
    return check_rejects(_accepted(c), 0.02).drop("expected")


@query("reject_typed_values")
def reject_typed_values(c: Context) -> DataFrame:
    """Values that each typed column is left with."""
    rows = _accepted(c).rows
    return union_all(rows[t].agg(*[F.count(k).alias(k) for k in typed_columns(t)]).select(F.lit(t).alias("table_name"), F.inline(F.array(*[
        F.struct(F.lit(k).alias("column_name"), F.col(k).alias("filled")) for k in typed_columns(t)]))) for t in SOURCES if typed_columns(t))


@query("reject_silver_invoices")
def reject_silver_invoices(c: Context) -> DataFrame:
    """Silver built from rows whose cells did not all parse: invoices by payment band and whether dates and totals are there."""
    return silver(_accepted(c).rows, AS_OF)["billing_invoices"].groupBy(
        "payment_status_derived", "is_past_due", F.col("due_at").isNotNull().alias("has_due"), F.col("total_reported").isNotNull().alias("has_total")).agg(
        F.count(F.lit(1)).alias("invoices"))


def typed_columns(table: str) -> list[str]:
    return [k for k, kind in SOURCES[table][1].items() if kind != "string"]


QUERIES["dirty_profile_parse_issues"] = lambda c: issues(Context(c.spark, c.folder, dirty.WIDE_TEXT).bronze)

# The checks over sources with faults: each of them counts something there.
DIRTY_QUERIES = (
    "dq_silver_keys", "dq_gold_keys", "dq_silver_references", "dq_gold_references", "dq_row_rules", "dq_required", "dq_overflow", "gate_gold_integrity",
    "gate_silver_derived", "gate_gold_consistency", "rel_foreign_keys", "profile_tables", "profile_structure", "crm_lonely", "ins_students_without_enrollment",
    "ins_customers_without_contract", "uni_semesters", "uni_student_ages", "uni_enrollment_chronology", "uni_course_load", "uni_grade_ranges", "bil_product_prices",
    "bil_lines_against_header", "bil_unit_price_against_catalogue", "bil_payment_rules", "bil_payments_against_header", "crm_bridge", "xdm_linked_behaviour",
)
for _name in DIRTY_QUERIES:
    QUERIES[f"dirty_{_name}"] = lambda c, f=QUERIES[_name]: f(Context(c.spark, c.folder, dirty.DIRTY))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, folder, build=build: comparable(build(Context(spark, folder))))
        for name, build in QUERIES.items()
    }

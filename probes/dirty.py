"""The bound sources with faults that keys decide, so that every check counts something: SELECTs that Spark and DuckDB both run.

All rows of the sources are kept; some come twice. Types stay as they are. A second set of SELECTs gives every source as text, some cells of which
do not parse: :data:`TEXT` for DuckDB, :data:`WIDE_TEXT` the same rows for Spark, for keys of up to 72 digits (three bigints and an int have 67).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from probes.bindings import SOURCES as BOUND
from strata.catalog import SOURCES, columns_of
from strata.plans.layer import Layer

LINES = "(select invoice_id as line_invoice, sum(line_total) as lines from c_billing_invoice_items group by invoice_id) t"
PRICES = "(select product_id as priced_id, monthly_price as list_price from c_billing_products) p"


def _key(column: str) -> str:
    return f"cast({column} as bigint)"


def _when(column: str, every: int, rest: int, value: str, otherwise: str) -> str:
    return f"case when {_key(column)} % {every} = {rest} then {value} else {otherwise} end"


# source: {column: expression}
FAULTS: dict[str, dict[str, str]] = {
    "university_semesters": {"end_date": "case when half = 1 and year % 3 = 0 then start_date + cast(-10 as int) else end_date end"},
    "university_students": {"birth_date": _when("student_id", 30, 4, "enrolled_at + cast(20 as int)", "birth_date")},
    "university_professors": {"hired_at": _when("professor_id", 6, 1, "'2030-01-01'", "hired_at")},
    "university_enrollments": {
        "student_id": _when("student_id", 40, 5, "'nobody'", "student_id"), "status": _when("enrollment_id", 90, 8, "null", "status")},
    "university_grades": {
        "score": _when("enrollment_id", 60, 1, "cast(150 as decimal(5,2))", "score"),
        "weight": _when("enrollment_id", 70, 2, "cast(1.5 as decimal(4,3))", "weight"),
        "enrollment_id": _when("enrollment_id", 10, 3, "'none'", "enrollment_id")},
    "billing_products": {"monthly_price": _when("product_id", 25, 6, "cast(-monthly_price as decimal(10,2))", "monthly_price")},
    "billing_subscriptions": {"customer_id": _when("customer_id", 40, 5, "'nobody'", "customer_id")},
    "billing_invoices": {"total": (f"case when {_key('invoice_id')} % 20 = 9 then cast(coalesce(lines, 0) as decimal(12,2)) when {_key('invoice_id')} % 20 = 11 "
                                   "then cast(coalesce(lines, 0) + cast(0.01 as decimal(4,2)) as decimal(12,2)) else total end")},
    "billing_invoice_items": {
        "quantity": _when("invoice_id", 80, 3, "cast(0 as decimal(10,2))", "quantity"),
        "unit_price": (f"case when {_key('invoice_id')} % 90 = 4 then cast(-unit_price as decimal(10,2)) when {_key('invoice_id')} % 30 = 8 "
                       "then coalesce(list_price, unit_price) else unit_price end"),
        "product_id": _when("invoice_id", 50, 1, "'gone'", "product_id")},
    "billing_payments": {
        "payment_id": _when("invoice_id", 200, 14, "null", "payment_id"), "amount": _when("invoice_id", 80, 6, "cast(-amount as decimal(12,2))", "amount")},
    "crm_contacts": {"account_id": _when("contact_id", 50, 9, "'none'", "account_id")},
    "crm_leads": {"score": _when("lead_id", 45, 7, "cast(140 as smallint)", "score")},
    "crm_opportunities": {"amount": _when("opportunity_id", 35, 8, "cast(0 as decimal(14,2))", "amount"),
                          "account_id": _when("opportunity_id", 40, 3, "null", "account_id")},
    "crm_opportunity_contacts": {"contact_id": _when("contact_id", 30, 3, "'nobody'", "contact_id")},
    "crm_activities": {"activity_id": _when("activity_id", 500, 1, "null", "activity_id")},
}
JOINED = {"billing_invoices": f" left join {LINES} on line_invoice = invoice_id", "billing_invoice_items": f" left join {PRICES} on priced_id = product_id"}
# source: which of its rows come a second time
TWICE = {
    "billing_payments": f"{_key('invoice_id')} % 100 = 12", "crm_opportunity_contacts": f"{_key('opportunity_id')} % 60 = 1",
    "crm_leads": f"{_key('lead_id')} % 80 = 3", "university_grades": f"{_key('enrollment_id')} % 150 = 7",
}


def _select(name: str) -> str:
    faults = FAULTS.get(name, {})
    columns = ", ".join(f"{faults[c]} as {c}" if c in faults else c for c in SOURCES[name][1])
    text = f"select {columns} from c_{name}{JOINED.get(name, '')}"
    return text + (f" union all {text} where {TWICE[name]}" if name in TWICE else "")


DIRTY: dict[str, str] = {name: _select(name) for name in BOUND}

# What stands in some cells of the text sources, by the type that the column should have.
JUNK = {"date": "'31/02/2020'", "timestamp": "'yesterday'", "decimal": "'12,5x'", "smallint": "'1e9z'", "int": "'many'", "boolean": "'perhaps'"}
#: Every so many rows (by length of the key and digits in it) a cell of each typed column does not parse.
JUNK_EVERY = 23
#: Digits of a key that are read as one bigint, and such parts of a key.
PART, PARTS = 18, 4


def _remainder(digits: str) -> str:
    """A number of up to PART * PARTS digits modulo JUNK_EVERY, from bigints alone."""
    whole = f"lpad({digits}, {PART * PARTS}, '0')"
    parts = [f"cast(substr({whole}, {1 + PART * k}, {PART}) as bigint) % {JUNK_EVERY} * {pow(10, PART * (PARTS - 1 - k), JUNK_EVERY)}" for k in range(PARTS)]
    return f"(({' + '.join(parts)}) % {JUNK_EVERY})"


def _text(name: str, wide: bool = False) -> str:
    """``wide``: the digits of the key in parts, for line keys of large tables are longer than a bigint and may be longer than a decimal."""
    digits, rows = f"replace({SOURCES[name][0][0]}, '-', '')", f"c_{name}"
    place = f"(cast({digits} as bigint) % {JUNK_EVERY})"
    if wide:
        place, rows = "place", f"(select *, {_remainder(digits)} as place from c_{name})"
    typed = [c for c in columns_of(name) if SOURCES[name][1][c] != "string"]
    cells = []
    for c, kind in SOURCES[name][1].items():
        text = f"case when {c} is null then '' else cast({c} as string) end"
        junk = JUNK.get(kind.split("(")[0])
        cells.append(f"{f'case when {place} = {typed.index(c) % JUNK_EVERY} then {junk} else {text} end' if junk else text} as {c}")
    return f"select {', '.join(cells)} from {rows}"


TEXT: dict[str, str] = {name: _text(name) for name in BOUND}
WIDE_TEXT: dict[str, str] = {name: _text(name, wide=True) for name in BOUND}


def over(spark: SparkSession, bound: Layer, selects: dict[str, str]) -> Layer:
    def build(text: str) -> DataFrame:
        names = {f"c_{n}": bound[n] for n in bound if f"from c_{n}" in text}
        for name in sorted(names, key=len, reverse=True):
            for end in (" ", ")"):
                text = (text + " ").replace(f"from {name}{end}", f"from {{{name}}}{end}")
        return spark.sql(text, **names)

    return Layer({name: (lambda text=text: build(text)) for name, text in selects.items()})


def ctes(selects: dict[str, str]) -> str:
    """The faulty sources under the names of the clean ones, as the head of a WITH clause."""
    clean = [f"c_{name} as ({text})" for name, text in BOUND.items()]
    return ",\n".join(clean + [f"{name} as ({text})" for name, text in selects.items()])

"""Cells that do not parse: typed rows and a table of rejected cells, from one pass over the text.

A cell that is not blank and has no value of its column's type becomes NULL in its row and one row of the reject table, with the table, column, type,
text and place. Rows are never dropped. Whether a load with rejects goes on is for its gate (:func:`check_rejects`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalog import SOURCES, primary_key
from strata.operators.quality import Check, run_checks, union_all
from strata.plans.layer import Layer
from strata.plans.versions import Draft

PLACE = ("_source_file", "_source_row_number")
REJECTS = "_rejects"


def _parsed(name: str, kind: str) -> tuple[Column, Column]:
    """(value, is rejected) of a text column."""
    text = F.nullif(F.col(name), F.lit(""))
    if kind == "boolean":
        value = F.when(text.isin("True", "False"), text == "True")
    else:
        value = text.try_cast(kind)
    return value, text.isNotNull() & value.isNull()


def typed_or_rejected(raw: DataFrame, table: str) -> DataFrame:
    """Typed columns of a source, the columns that are not its own as they are, and ``_rejects``: array of (column, kind, value).

    Text columns keep their text, blanks included; of the others, blank text is missing and not rejected. Columns that are typed already are cast.
    """
    kinds, have = SOURCES[table][1], dict(raw.dtypes)
    columns, rejects = [], []
    for name, kind in kinds.items():
        if kind == "string" or have[name] != "string":
            columns.append(F.col(name).cast(kind).alias(name))
            continue
        value, bad = _parsed(name, kind)
        columns.append(value.alias(name))
        rejects.append(F.when(bad, F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("kind"), F.col(name).alias("value"))))
    cells = F.filter(F.array(*rejects), lambda cell: cell.isNotNull()) if rejects else F.expr("cast(array() as array<struct<column_name:string,kind:string,value:string>>)")
    return raw.select(*columns, *[c for c in raw.columns if c not in kinds], cells.alias(REJECTS))


def rejected_cells(parsed: DataFrame, table: str) -> DataFrame:
    """table_name, column_name, kind, value, place of every rejected cell; the place is file and row number, or the key of a source without them."""
    named = [c for c in PLACE if c in parsed.columns] or list(primary_key(table))
    place = F.concat_ws(":", *[F.col(c).cast("string") for c in named]).alias("place")
    return parsed.where(F.size(REJECTS) > 0).select(place, F.inline(REJECTS)).select(F.lit(table).alias("table_name"), "column_name", "kind", "value", "place")


@dataclass(frozen=True)
class Accepted:
    """Typed rows of all sources, and the cells that did not parse."""

    rows: Layer
    cells: DataFrame
    draft: Draft


def accept(spark: SparkSession, bronze: Mapping[str, DataFrame], folder: str, names: Sequence[str] = tuple(SOURCES)) -> Accepted:
    """Parse every source once and write rows and rejects together; both are read from there."""
    draft = Draft(spark, folder).write(Layer({n: (lambda n=n: typed_or_rejected(bronze[n], n)) for n in names}))
    parsed = draft.read()
    rows = Layer({n: (lambda n=n: parsed[n].drop(REJECTS)) for n in names})
    return Accepted(rows, union_all(rejected_cells(parsed[n], n) for n in names), draft)


def check_rejects(accepted: Accepted, most_share: float = 0.0) -> DataFrame:
    """Per source: is the share of rows with a rejected cell at most ``most_share``? ``got`` is the number of such rows when it is more, else 0."""
    checks = []
    for name, parsed in accepted.draft.read().items():
        if REJECTS not in parsed.columns:
            continue
        bad = F.count_if(F.size(REJECTS) > 0)
        checks.append(Check("rejects", f"{name} rows with cells that do not parse", parsed, F.when(bad > most_share * F.count(F.lit(1)), bad).otherwise(0), 0))
    return run_checks(checks)

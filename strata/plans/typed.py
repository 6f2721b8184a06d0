"""Bronze text as typed columns, without any repair: the view the audits and the flags start from."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.catalog import SOURCES
from strata.operators.profile import parse_issues
from strata.operators.quality import union_all
from strata.plans.layer import Layer


def typed_scan(raw: DataFrame, table: str) -> DataFrame:
    """Blank text is missing; dates and numbers that do not parse become NULL (counted by :func:`issues`)."""
    columns = []
    for name, kind in SOURCES[table][1].items():
        if dict(raw.dtypes)[name] == "string":
            text = F.nullif(F.col(name), F.lit(""))
            if kind == "boolean":
                columns.append(F.when(text.isNotNull(), text == "True").alias(name))
            else:
                columns.append((text if kind == "string" else text.try_cast(kind)).alias(name))
        else:
            columns.append(F.col(name).cast(kind).alias(name))
    return raw.select(*columns)


def typed(bronze: Mapping[str, DataFrame]) -> Layer:
    return Layer({name: (lambda name=name: typed_scan(bronze[name], name)) for name in SOURCES})


def issues_by_table(bronze: Mapping[str, DataFrame]) -> Iterator[DataFrame]:
    """Unparsed cells per date or number column, a frame for each table that has such columns."""
    for table, (_, columns) in SOURCES.items():
        checked = {c: k for c, k in columns.items() if k not in ("string", "boolean")}
        if checked:
            yield parse_issues(bronze[table], checked, table)


def issues(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Unparsed cells per table and date or number column."""
    return union_all(issues_by_table(bronze))

"""Writing layers and taking stock of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.digest import same
from strata.operators.quality import Check, run_checks, union_all
from strata.plans.versions import Draft, resolve, sums_of, total

# Sums that must survive the export: layer, table, column.
SUM_CHECKS = (
    ("gold", "fact_invoice", "invoiced_amount"), ("silver", "billing_invoice_items", "line_total"),
    ("gold", "fact_enrollment", "final_score"),
)


def draft_layer(spark: SparkSession, frames: Mapping[str, DataFrame], folder: str, layer: str) -> Draft:
    """A new version of a layer, written but not yet shown to readers."""
    return Draft(spark, folder).write(frames, sums_of(layer, SUM_CHECKS))


def export_layer(spark: SparkSession, frames: Mapping[str, DataFrame], folder: str, layer: str) -> DataFrame:
    """Write and publish a layer; (object, row_count) of what was written."""
    draft = draft_layer(spark, frames, folder, layer)
    draft.publish()
    return exported(draft)


def exported(draft: Draft) -> DataFrame:
    return draft.spark.createDataFrame([(name, w.digest.rows) for name, w in draft.tables.items()], "object string, row_count bigint")


def inventory(frames: Mapping[str, DataFrame], layer: str, kind: Callable[[str], str] = lambda n: "table") -> DataFrame:
    """Rows per object of a layer."""
    return union_all(
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(kind(name)).alias("kind"), F.lit(name).alias("object"), "row_count")
        for name, frame in frames.items())


def check_export(version: Draft, names: Sequence[str] | None = None) -> DataFrame:
    """The files of a version against what was observed while they were written: rows, content (0: the digests agree), checked sums in units of 0.001.

    One pass over the written tables; nothing they were built from is computed again. Works for drafts and, by :func:`check_published`, at any later time.
    """
    checks = []
    tables = version.read()
    for name in names or tables:
        frame = tables[name]
        was = version.tables[name]
        checks += [Check("rows", name, frame, F.count(F.lit(1)), was.digest.rows), Check("content", name, frame, same(frame.columns, was.digest), 0)]
        checks += [Check("sums", f"{name}.{c}", frame, total(c), int(s * 1000) if s is not None else 0) for c, s in was.sums.items()]
    return run_checks(checks)


def check_published(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    return check_export(resolve(spark, folder, version))

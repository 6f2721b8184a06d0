"""The whole batch: sources -> Bronze -> Silver -> Gold -> export, with a gate after each layer.

Every layer is written before the next one starts and is read back from there, so a lost executor costs
at most the tasks of the layer at hand. A failed gate stops the run; readers see a layer (``versions.read_layer``) once its gate is passed, and the
whole layer before until then.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.catalog import SourceSpec, load_catalog
from strata.operators.quality import Check, gate, long_form, run_checks, union_all
from strata.plans import validators
from strata.plans.audits import billing, crm, crossdomain, university
from strata.plans.export import check_export, draft_layer
from strata.plans.gold import date_span, gold
from strata.plans.kpi import KPIS
from strata.plans.layer import Layer
from strata.plans.rejects import accept, check_rejects
from strata.plans.silver import AS_OF, silver
from strata.plans.typed import typed
from strata.session import tune
from strata.plans.versions import remove_old
from strata.sources.delimited import inventory
from strata.sources.ledger import LoadResult, current, ingest, read_bronze

AUDIT_AS_OF = "2026-07-21"
#: Published versions of a layer whose tables stay: the newest, and the one that readers may still be on.
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Summary:
    loads: tuple[LoadResult, ...]
    checks: int


def load_all(spark: SparkSession, specs: Sequence[SourceSpec], out: str, at_once: int = 4) -> tuple[LoadResult, ...]:
    """Sources are independent of each other; each is a few distributed jobs, and those of ``at_once`` sources share the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        return tuple(pool.map(inheritable_thread_target(spark)(lambda spec: ingest(spark, spec, f"{out}/bronze", f"{out}/ledger")), specs))


def check_sources(spark: SparkSession, specs: Sequence[SourceSpec], raw_dir: str) -> DataFrame:
    """Declared sources are there. Files that nobody declared are let be; :func:`inventory` lists them."""
    found = inventory(spark, raw_dir, specs)
    return run_checks([Check("sources", "declared but missing", found, F.count_if(F.col("declared") & ~F.col("present")), 0)])


def pass_gate(results: DataFrame, title: str, out: str) -> int:
    """Keep the results as a table of the run, also those that then stop it."""
    path = f"{out}/checks/{title.lower()}"
    results.write.mode("overwrite").parquet(path)
    return gate(results.sparkSession.read.parquet(path), title)


def bronze_layer(spark: SparkSession, specs: Sequence[SourceSpec], out: str) -> Layer:
    return Layer({
        s.name: (lambda s=s: read_bronze(spark, f"{out}/bronze", f"{out}/ledger", s)) for s in specs})


def check_bronze(spark: SparkSession, specs: Sequence[SourceSpec], bronze: Layer, out: str) -> DataFrame:
    state = current(spark, f"{out}/ledger")
    return union_all(
        validators.check_bronze(s, bronze[s.name], state) for s in specs)


def run(spark: SparkSession, manifest: str, raw_dir: str, out: str, as_of: str = AS_OF, published: bool = False,
        most_rejects: float | None = None) -> Summary:
    """``published``: also hold flag counts, Gold rows and KPI totals against those of the published data.

    ``most_rejects``: the share of a source's rows that may hold cells that do not parse; those become NULL and rows of ``rejects/cells``. By default
    the first such cell stops the run.
    """
    tune(spark)
    specs = load_catalog(spark, manifest, raw_dir)
    checks = pass_gate(check_sources(spark, specs, raw_dir), "Sources", out)
    loads = load_all(spark, specs, out)
    bronze = bronze_layer(spark, specs, out)
    state = current(spark, f"{out}/ledger")
    checks += pass_gate(check_bronze(spark, specs, bronze, out).unionByName(validators.check_ledger(state)), "Bronze", out)

    rows: Layer = bronze
    if most_rejects is not None:
        accepted = accept(spark, bronze, f"{out}/rejects")
        accepted.draft.write({"cells": accepted.cells})
        checks += pass_gate(check_rejects(accepted, most_rejects), "Rejects", out)
        accepted.draft.publish()
        rows = accepted.rows
    silver_draft = draft_layer(spark, silver(rows, as_of), f"{out}/silver", "silver")
    s = silver_draft.read()
    results = [validators.silver_rows(bronze, s), validators.silver_derived(s), check_export(silver_draft)]
    if published:
        results.append(validators.silver_flags(s))
    checks += pass_gate(union_all(results), "Silver", out)
    silver_draft.publish()

    gold_draft = draft_layer(spark, gold(s, date_span(spark)), f"{out}/gold", "gold")
    g = gold_draft.read()
    results = [validators.gold_integrity(g), validators.gold_consistency(s, g), check_export(gold_draft, list(g))]
    if published:
        results += [validators.gold_rows(g), validators.kpi_totals(g)]
    checks += pass_gate(union_all(results), "Gold", out)

    gold_draft.write(Layer({name: (lambda f=f: f(g)) for name, f in KPIS.items()}))
    checks += pass_gate(check_export(gold_draft, list(KPIS)), "Export", out)
    gold_draft.publish()
    for layer in ("silver", "gold"):
        remove_old(spark, f"{out}/{layer}", KEPT_VERSIONS)
    return Summary(loads, checks)


def run_audit(bronze: Layer, as_of: str = AUDIT_AS_OF) -> DataFrame:
    """All audit numbers as (audit, dims, metric, value) rows. Text columns of an audit become its dims."""
    tables = typed(bronze)
    parts = []
    for audits in (university, billing, crm, crossdomain):
        for name, build in audits.AUDITS.items():
            frame = build(tables, as_of)
            dims = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
            named = [F.concat(F.lit(f"{d}="), F.coalesce(d, F.lit("-"))) for d in dims]
            frame = frame.select(F.concat_ws(", ", *named).alias("dims"), *[c for c in frame.columns if c not in dims])
            parts.append(long_form(frame, "dims").select(F.lit(name).alias("audit"), "*"))
    return union_all(parts)

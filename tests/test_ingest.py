"""Loading, skipping, replacing and retrying sources; the full run; arrivals."""

from __future__ import annotations

import hashlib
import json
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata.catalog import SOURCES, SourceSpec, load_catalog
from strata.operators.quality import GateError, gate
from strata.operators.digest import digest
from strata.plans.export import check_export, check_published, draft_layer, export_layer
from strata.plans.run import bronze_layer, run, run_audit
from strata.plans.validators import check_bronze, check_ledger
from strata.plans.versions import Draft, UnpublishedError, history, read_layer, remove_old
from strata.sources.delimited import SourceError, check_source, examine, file_facts, fingerprint, inventory, with_lineage
from strata.sources.ledger import Batch, append, batch_listing, current, events, ingest, latest_batches, read_bronze
from strata.streaming.arrivals import load_arrivals

TEXT = '﻿id,name,note\n1,"Doe, Ann",\n2,"say ""hi""","two\nlines"\n3,Ñandú 😀,a\\b\n'


@pytest.fixture
def spec(tmp_path):
    (tmp_path / "crm").mkdir()
    file = tmp_path / "crm" / "things.csv"
    file.write_text(TEXT, encoding="utf-8")
    return SourceSpec("crm", "things", ("id", "name", "note"), 3, str(file))


def test_scan_lineage(spark, spec):
    rows = {r.id: r for r in with_lineage(spark, spec, "b1").collect()}
    assert [rows[str(i)]._source_row_number for i in (1, 2, 3)] == [1, 2, 3]
    assert (rows["1"].name, rows["1"].note) == ("Doe, Ann", "")
    assert (rows["2"].name, rows["2"].note) == ('say "hi"', "two\nlines")
    for row in rows.values():
        text = json.dumps([row.id, row.name, row.note], ensure_ascii=False, separators=(",", ":"))
        assert row._row_hash == hashlib.sha256(text.encode()).hexdigest()
        assert row._source_domain == "crm" and row._source_file.endswith("things.csv")


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_files_without_line_breaks_are_cut(spark, tmp_path, small_blocks):
    """Many small blocks, stray quotes, doubled quotes, a blank line: the rows one parser reads, numbered as in the file."""
    notes = ["", "plain", '"say ""x"""', '"a,b"', '5" pipe', "long " * 40 + "é" * 30]
    lines = [f"{i},{notes[i % 6]},{'end' if i % 2 else ''}" for i in range(3000)]
    path = tmp_path / "many.csv"
    path.write_text("\n".join(["n,note,tail", *lines[:1500], "", *lines[1500:], ""]), encoding="utf-8")
    spec = SourceSpec("x", "many", ("n", "note", "tail"), 3000, str(path), line_breaks=False)
    cut = with_lineage(spark, spec, "b")
    assert cut.rdd.getNumPartitions() > 1 and spark.read.text(str(path)).rdd.getNumPartitions() > 5
    got = cut.orderBy("_source_row_number").collect()
    assert [(r._source_row_number, r.n) for r in got] == [(i + 1, str(i)) for i in range(3000)]
    assert {r.note for r in got} == {"", "plain", 'say "x"', "a,b", '5" pipe', "long " * 40 + "é" * 30}
    one = with_lineage(spark, replace(spec, line_breaks=True), "b").orderBy("_source_row_number").collect()
    assert [(r._source_row_number, r._row_hash) for r in got] == [(r._source_row_number, r._row_hash) for r in one]


def test_checksum_does_not_depend_on_blocks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("n,note\n" + "".join(f"{i},{'x' * (i % 50)}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = set()
    try:
        for size in ("4096", "20000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            seen.add(fingerprint(spark, str(path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(seen) == 1


def test_checksum_changes_with_every_byte(spark, tmp_path):
    texts = ['id,note\n1,"a\nb"\n2,c\n', 'id,note\n1,"a\r\nb"\n2,c\n', 'id,note\r\n1,"a\nb"\n2,c\n', 'id,note\n2,c\n1,"a\nb"\n', 'id,note\n1,"a\nb"\n2,c',
             'id,note\n1,"a\nb"\n2,c\n\n', 'id,note\n1,"a\nB"\n2,c\n', '\ufeffid,note\n1,"a\nb"\n2,c\n']
    folder = tmp_path / "versions"
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"{i}.csv").write_bytes(text.encode())
    rows = file_facts(spark, str(folder), ("id", "note")).collect()
    assert len({r.checksum for r in rows}) == len(texts) == len(rows) and all(r.header_ok for r in rows)


def test_every_header_counts(spark, tmp_path):
    """A folder in which one file has its columns swapped is not loaded; a file without a byte has no rows, alone it is an error."""
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("id,note\n1,x\n")
    (folder / "b.csv").write_text('"id","note"\r\n2,y\r\n')
    spec = SourceSpec("x", "parts", ("id", "note"), 2, str(folder))
    place = str(tmp_path / "bronze"), str(tmp_path / "ledger")
    assert ingest(spark, spec, *place).status == "loaded" and ingest(spark, spec, *place).status == "skipped"
    assert sorted((r.id, r.note, r._source_row_number) for r in read_bronze(spark, *place, spec).collect()) == [("1", "x", 1), ("2", "y", 1)]
    (folder / "c.csv").write_text("note,id\nz,3\n")
    with pytest.raises(SourceError, match="unexpected columns in .*c.csv"):
        ingest(spark, replace(spec, expected_rows=3), *place)
    (folder / "c.csv").write_text("")
    assert ingest(spark, spec, *place).status == "skipped"
    with pytest.raises(SourceError, match="empty file: .*c.csv"):
        ingest(spark, replace(spec, path=str(folder / "c.csv")), *place)


def test_contract(spark, spec):
    assert [r.ok for r in check_source(spark, spec).collect()] == [True, True]
    assert [r.ok for r in check_source(spark, replace(spec, expected_rows=4)).collect()] == [True, False]
    assert [r.ok for r in check_source(spark, replace(spec, columns=("id", "note", "name"))).collect()] == [False, True]


def test_load_skip_change_fail_retry(spark, spec, tmp_path):
    bronze, ledger = str(tmp_path / "bronze"), str(tmp_path / "ledger")
    first = ingest(spark, spec, bronze, ledger)
    again = ingest(spark, spec, bronze, ledger)
    assert (first.status, again.status, first.batch_id) == ("loaded", "skipped", again.batch_id)
    state = current(spark, ledger)
    checks = check_bronze(spec, read_bronze(spark, bronze, ledger, spec), state)
    assert gate(checks, "bronze") == 6

    with open(spec.path, "a", encoding="utf-8") as file:  # a new version becomes a second batch
        file.write("4,new,row\n")
    with pytest.raises(SourceError, match="expected 3 rows, stored 4"):
        ingest(spark, spec, bronze, ledger)
    failed = current(spark, ledger).where("status = 'failed'").first()
    assert "expected 3 rows" in failed.error_message and failed.loaded_rows == 0
    assert read_bronze(spark, bronze, ledger, spec).count() == 3  # readers still see the good batch

    grown = replace(spec, expected_rows=4)
    retried = ingest(spark, grown, bronze, ledger)  # same content: the failed batch keeps its id
    assert (retried.status, retried.batch_id) == ("loaded", failed.batch_id)
    assert read_bronze(spark, bronze, ledger, grown).count() == 4
    assert latest_batches(spark, ledger).first().batch_id == retried.batch_id
    assert {r.status for r in batch_listing(spark, ledger).collect()} == {"success"}
    assert events(spark, ledger).count() == 6

    with pytest.raises(SourceError, match="unexpected columns"):
        ingest(spark, replace(grown, columns=("id", "name")), bronze, ledger)


def test_interrupted_load_is_replaced(spark, spec, tmp_path):
    """A load that stopped before its last event is not visible and is loaded again under the same id."""
    bronze, ledger = str(tmp_path / "bronze"), str(tmp_path / "ledger")
    done = ingest(spark, spec, bronze, ledger)
    state = current(spark, ledger).first()
    append(spark, ledger, replace(Batch(**state.asDict()), status="loading", loaded_rows=0, completed_at=None))
    with pytest.raises(SourceError, match="no successful load"):
        read_bronze(spark, bronze, ledger, spec)
    assert ingest(spark, spec, bronze, ledger).batch_id == done.batch_id
    assert read_bronze(spark, bronze, ledger, spec).count() == 3


def test_arrivals_load_each_file_once(spark, spec, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(TEXT, encoding="utf-8")
    bronze, ledger, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "ledger"), str(tmp_path / "cp")

    def load():
        load_arrivals(spark, spec, str(landing), bronze, ledger, checkpoint).awaitTermination()
        return sorted((r.id, r._source_row_number) for r in read_bronze(spark, bronze, ledger, spec).collect())

    once = [("1", 1), ("2", 2), ("3", 3)]
    assert load() == once and load() == once
    (landing / "b.csv").write_text(TEXT, encoding="utf-8")
    assert load() == sorted(once * 2)
    assert [(r.status, r.loaded_rows) for r in current(spark, ledger).collect()] == [("success", 3)] * 2

    ingest(spark, spec, bronze, ledger)  # a load takes the place of what arrived before it
    assert read_bronze(spark, bronze, ledger, spec).count() == 3
    (landing / "c.csv").write_text(TEXT, encoding="utf-8")
    assert load() == sorted(once * 2)
    (landing / "d.csv").write_text(TEXT.replace("id,name,note", "id,note,name"), encoding="utf-8")
    with pytest.raises(StreamingQueryException):
        load()
    assert read_bronze(spark, bronze, ledger, spec).count() == 6


def tiny_sources(folder):
    """Two rows or so per source, all references valid; returns the manifest path."""
    rows = {
        "university_semesters": [("S1", "2024-1", 2024, 1, "2024-03-01", "2024-07-15")],
        "university_professors": [("P1", "Ada", "L", "ada@uni.test", "cs", "")],
        "university_students": [("ST1", "Eva", "Q", "Eva@uni.test", "2000-01-01", "2023-02-01", "CL")],
        "university_courses": [("C1", "C-1", "Logic", 4, "cs", "P1")],
        "university_enrollments": [("E1", "2024-03-05", "completed", "ST1", "C1", "S1"), ("E2", "2024-03-06", "active", "ST1", "C1", "S1")],
        "university_grades": [("G1", "final", "71.5", "1.000", "2024-06-01", "E1")],
        "billing_customers": [("CU1", "ST1", "Eva", "Q", "eva@uni.test", "CL", "2023-03-01T10:00:00", "retail"),
                              ("CU2", "", "Bo", "R", "bo@x.test", "US", "2023-03-01T10:00:00", "smb")],
        "billing_products": [("PR1", "SKU1", "Prod", "basic", "19.90", "True")],
        "billing_subscriptions": [("SB1", "active", "2024-01-01", "2027-01-01", "CU1", "PR1")],
        "billing_invoices": [("I1", "2024-02-01", "2024-03-01", "20.00", "paid", "CLP", "CU1"), ("I2", "2024-02-01", "2024-03-01", "5.00", "pending", "USD", "CU2")],
        "billing_invoice_items": [("II1", "1", "19.90", "19.90", "I1", "PR1")],
        "billing_payments": [("PA1", "20.00", "2024-02-03", "card", "I1")],
        "crm_accounts": [("A1", "Acme", "retail", "CL", "1000.00", 10, "2023-01-01T00:00:00")],
        "crm_contacts": [("CO1", "Al", "B", "al@x.test", "1", "cto", "2023-02-01T00:00:00", "A1")],
        "crm_leads": [("L1", "C", "D", "c@d.test", "web", "converted", 55, "2023-02-01T00:00:00")],
        "crm_opportunities": [("O1", "Deal", "won", "100.00", "2024-01-01", "2023-06-01T00:00:00", "A1")],
        "crm_opportunity_contacts": [("O1", "CO1", "buyer")],
        "crm_activities": [("AC1", "call", "hi", "2023-07-01T00:00:00", "CO1", "O1"), ("AC2", "mail", "x", "2023-07-01T00:00:00", "", "")],
    }
    domains: dict = {}
    for name, data in rows.items():
        domain, table = name.split("_", 1)
        columns = list(SOURCES[name][1])
        (folder / domain).mkdir(exist_ok=True)
        lines = [",".join(columns)] + [",".join(str(v) for v in r) for r in data]
        (folder / domain / f"{table}.csv").write_text("\n".join(lines) + "\n")
        domains.setdefault(domain, {})[table] = {"rows": len(data), "cols": columns}
    manifest = folder / "manifest.json"
    manifest.write_text(json.dumps({"domains": domains}, indent=1))
    return str(manifest)


def test_damaged_export_and_ledger_are_seen(spark, tmp_path):
    folder = str(tmp_path / "out")
    frames = {"fact_invoice": spark.createDataFrame([(1, "10.00"), (2, "5.50")], "id int, invoiced_amount string").withColumn(
        "invoiced_amount", F.col("invoiced_amount").cast("decimal(12,2)"))}
    assert [tuple(r) for r in export_layer(spark, frames, folder, "gold").collect()] == [("fact_invoice", 2)]
    assert gate(check_published(spark, folder), "x") == 3
    version = draft_layer(spark, frames, folder, "gold")
    for other in ("id = 1", "id > 0 and id < 3 or true"):  # a lost row, then the same rows
        frames["fact_invoice"].where(other).write.mode("overwrite").parquet(version.path("fact_invoice"))
        failed = {r.section for r in check_export(version).collect() if not r.ok}
        assert failed == ({"rows", "content", "sums"} if other == "id = 1" else set())
    swapped = frames["fact_invoice"].withColumn("id", 3 - F.col("id"))  # same rows and sums, other content
    swapped.write.mode("overwrite").parquet(version.path("fact_invoice"))
    with pytest.raises(GateError, match="1 of 3 checks"):
        gate(check_export(version), "x")

    bad = [("d", "t", "c1", "success", 1, 1), ("d", "t", "c1", "failed", 1, 0), ("d", "t", "c2", "odd", 1, -1), ("d", "t", "c3", None, 1, 1)]
    state = spark.createDataFrame(bad, "source_domain string, source_table string, source_checksum string, status string, expected_rows int, loaded_rows int")
    assert {r.label: r.got for r in check_ledger(state).collect()} == {"versions with several states": 1, "unknown states": 2, "negative counts": 1}


def test_digests(spark):
    schema = "a string, b string, c decimal(5,2), d timestamp"
    rows = [("x", None, None, None), (None, "x", None, None), ("x", "y", None, None), ("x", "y", None, None)]
    whole = digest(spark.createDataFrame(rows, schema))
    assert digest(spark.createDataFrame(rows[::-1], schema).repartition(3)) == whole and whole.rows == 4
    for other in (rows[:3], rows + rows[:1], [rows[1], *rows[1:]], [rows[0], rows[0], *rows[2:]], [(None, "x", None, None)] * 2 + rows[2:]):
        assert digest(spark.createDataFrame(other, schema)) != whole
    parts = [digest(spark.createDataFrame(p, schema)) for p in (rows[:1], rows[1:])]
    assert parts[0].first + parts[1].first == whole.first and parts[0].second + parts[1].second == whole.second
    assert digest(spark.createDataFrame([], schema)).rows == 0


def test_readers_stay_on_the_whole_old_layer(spark, tmp_path):
    """A refresh that stops between two tables, or before it is published, is not seen; old versions go later."""
    folder = str(tmp_path / "layer")
    table = lambda n: spark.range(n).withColumn("t", F.lit("x"))
    with pytest.raises(UnpublishedError):
        read_layer(spark, folder)
    first = Draft(spark, folder).write({"a": table(3), "b": table(4)})
    with pytest.raises(UnpublishedError):
        read_layer(spark, folder)
    first.publish()

    class Killed(RuntimeError):
        pass

    def breaks():
        raise Killed

    from strata.plans.layer import Layer
    killed = Draft(spark, folder)
    with pytest.raises(Killed):
        killed.write(Layer({"a": lambda: table(30), "b": breaks}))
    seen = read_layer(spark, folder)
    assert {n: df.count() for n, df in seen.items()} == {"a": 3, "b": 4}
    assert spark.read.parquet(killed.path("a")).count() == 30  # it is there, and nobody reads it
    second = Draft(spark, folder).write({"a": table(5), "b": table(6)})
    assert read_layer(spark, folder, ["a"])["a"].count() == 3
    second.publish()
    assert {n: df.count() for n, df in read_layer(spark, folder).items()} == {"a": 5, "b": 6}
    assert seen["b"].count() == 4 and read_layer(spark, folder, version=first.version)["a"].count() == 3
    running = Draft(spark, folder).write({"a": table(7)})
    assert remove_old(spark, folder, keep=2) == [killed.version] if killed.version > first.version else True
    assert remove_old(spark, folder, keep=1) == sorted({first.version} | ({killed.version} if killed.version < first.version else set()))
    assert running.read()["a"].count() == 7 and read_layer(spark, folder)["a"].count() == 5 and history(spark, folder).count() == 2
    with pytest.raises(UnpublishedError, match="has no"):
        read_layer(spark, folder, ["c"])


@pytest.mark.parametrize("damage", ["lost", "doubled", "changed"])
def test_damaged_bronze_fails_the_gate_and_is_loaded_again(spark, spec, tmp_path, damage):
    bronze, ledger = str(tmp_path / "bronze"), str(tmp_path / "ledger")
    done = ingest(spark, spec, bronze, ledger)
    path = f"{bronze}/{spec.name}/_batch_id={done.batch_id}"
    rows = spark.createDataFrame(spark.read.parquet(path).collect(), spark.read.parquet(path).schema)
    other = {"lost": rows.where("id <> '2'"), "doubled": rows.unionByName(rows.where("id = '2'")),
             "changed": rows.withColumn("_row_hash", F.when(F.col("id") == "2", F.lit("0")).otherwise(F.col("_row_hash")))}[damage]
    other.write.mode("overwrite").parquet(path)
    results = check_bronze(spec, read_bronze(spark, bronze, ledger, spec), current(spark, ledger))
    assert "things differing content" in "".join(r.label for r in results.collect() if not r.ok)
    again = ingest(spark, spec, bronze, ledger)
    assert (again.status, again.batch_id) == ("loaded", done.batch_id)
    assert gate(check_bronze(spec, read_bronze(spark, bronze, ledger, spec), current(spark, ledger)), "Bronze") == 6


def test_files_are_cut_when_no_field_goes_over_lines(spark, tmp_path):
    """The load sees in the lines whether blocks can be parsed apart; the manifest may say it."""
    texts = {"plain": "id,note\n" + "".join(f'{i},"a, ""b"" {i}"\n' for i in range(50)), "breaks": 'id,note\n1,"a\nb"\n2,c\n',
             "returns": 'id,note\n1,"a\rb"\n2,c\n', "windows": "id,note\r\n1,a\r\n2,b\r\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
        assert examine(spark, str(tmp_path / f"{name}.csv"), ("id", "note")).line_breaks == (name in ("breaks", "returns"))
        spec = SourceSpec("x", name, ("id", "note"), 50 if name == "plain" else 2, str(tmp_path / f"{name}.csv"))
        place = str(tmp_path / "bronze"), str(tmp_path / "ledger")
        assert ingest(spark, spec, *place).status == "loaded"
        got = {(r.id, r.note, r._source_row_number) for r in read_bronze(spark, *place, spec).collect()}
        assert got == {(r.id, r.note, r._source_row_number) for r in with_lineage(spark, replace(spec, line_breaks=True), "b").collect()}
    (tmp_path / "manifest.json").write_text(json.dumps({"domains": {"x": {
        "a": {"rows": 1, "cols": ["id"], "line_breaks": False}, "b": {"rows": 1, "cols": ["id"]}}}}))
    assert [s.line_breaks for s in load_catalog(spark, str(tmp_path / "manifest.json"), "r")] == [False, None]


def test_whole_run_with_gates(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    manifest = tiny_sources(raw)
    out = str(tmp_path / "out")
    done = run(spark, manifest, str(raw), out)
    assert {r.status for r in done.loads} == {"loaded"} and len(done.loads) == 18
    # inventory, 18 sources x 6 + 3 of the ledger, 18 row counts + 5 derived + 19 tables twice + 1 sum, 5 references + 4 consistency + 14 tables twice + 2 sums, 10 KPIs twice
    assert done.checks == 1 + 18 * 6 + 3 + 18 + 5 + 2 * 19 + 1 + 5 + 4 + 2 * 14 + 2 + 2 * 10
    kept = [spark.read.parquet(f"{out}/checks/{gate}") for gate in ("sources", "bronze", "silver", "gold", "export")]
    assert sum(k.count() for k in kept) == done.checks and all(k.where("not ok").isEmpty() for k in kept)
    again = run(spark, manifest, str(raw), out)
    assert {r.status for r in again.loads} == {"skipped"} and again.checks == done.checks
    assert read_layer(spark, f"{out}/gold")["fact_enrollment"].first().enrollment_id == "E1"
    headline = read_layer(spark, f"{out}/gold")["kpi_headline"].first()
    assert float(headline.mrr_real) == 20.0 and float(headline.pct_sin_cobrar) == 50.0

    specs = load_catalog(spark, manifest, str(raw))
    found = inventory(spark, str(raw), specs)
    assert found.where("present and declared").count() == 18 == found.count()
    (raw / "crm" / "extra.csv").write_text("a\n1\n")
    assert inventory(spark, str(raw), specs).where("not declared").count() == 1

    audit = run_audit(bronze_layer(spark, specs, out))
    numbers = {(r.audit, r.dims, r.metric): r.value for r in audit.collect()}
    assert numbers[("bil_lines_against_header", "", "lines_less")] == 1.0
    assert numbers[("xdm_email_overlaps", "pair=students<->customers", "shared")] == 1.0
    assert numbers[("crm_activity_scope", "scope=unlinked", "activities")] == 1.0
    assert numbers[("uni_logical_duplicates", "", "duplicate_groups")] == 1.0

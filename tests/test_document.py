"""The audit document: rows of every kind of column, written as JSON and read back whole."""

from __future__ import annotations

import datetime as dt
import time
from collections import Counter
from collections.abc import Sequence

from strata.catalog import FOREIGN_KEYS, SOURCES
from strata.operators import profile
from strata.plans import document
from strata.plans.audits import crm, crossdomain
from strata.plans.document import metric_rows, read_document
from strata.plans.layer import Layer
from strata.plans.versions import Draft, read_layer
from strata.session import CLEANUP, short_lived_shuffles


def test_metric_rows(spark):
    frame = spark.createDataFrame([("t", None, 3, 2.5, True, dt.date(2024, 1, 2)), ("u", "x", None, None, None, None)],
                                  "table_name string, state string, n int, share double, ok boolean, day date")
    got = {(tuple(sorted(r.dims.items())), r.metric): (r.number, r.text) for r in metric_rows(frame, "s", "n").collect()}
    first, second = (("table_name", "t"),), (("state", "x"), ("table_name", "u"))
    assert got == {(first, "n"): (3.0, None), (first, "share"): (2.5, None), (first, "ok"): (1.0, None), (first, "day"): (None, "2024-01-02"),
                   **{(second, m): (None, None) for m in ("n", "share", "ok", "day")}}


def test_document_is_json_and_published_whole(spark, tmp_path):
    rows = metric_rows(spark.createDataFrame([("é", 1)], "k string, n int"), "structure", "x")
    draft = Draft(spark, str(tmp_path / "audit")).write({"structure": rows, "relations": rows.limit(0)}, kind="json")
    draft.publish()
    assert [tuple(r) for r in read_document(draft).collect()] == [("structure", "x", {"k": "é"}, "n", 1.0, None)]
    text = "".join(p.read_text() for p in (tmp_path / "audit" / "versions" / draft.version / "structure").glob("*.json"))
    assert text == '{"section":"structure","name":"x","dims":{"k":"é"},"metric":"n","number":1.0,"text":null}\n'
    assert draft.tables["structure"].digest.rows == 1 and read_layer


def test_references_are_audited_once(spark, tmp_path, monkeypatch):
    """The relations and the evidence of a document show the same reference audit, which is made once; its rows are those of an audit of fewer relations."""
    bronze = Layer({t: (lambda c=columns: spark.createDataFrame([("1",) * len(c), ("2",) * len(c)], ", ".join(f"{x} string" for x in c)))
                    for t, (_, columns) in SOURCES.items()})
    made, audit = [], document.fk_audit
    for module in (document, crossdomain):
        monkeypatch.setattr(module, "fk_audit", lambda t, relations: made.append(len(relations)) or audit(t, relations))
    draft = document.write_document(spark, bronze, "2024-01-01", str(tmp_path / "audit"), ["relations", "evidence"])
    assert made == [len(FOREIGN_KEYS)]
    got = {(r.dims["relation"], r.metric): r.number for r in read_document(draft).where("name = 'evi_occupancy'").collect()}
    own = metric_rows(crossdomain.occupancy(document.typed(bronze), "2024-01-01"), "evidence", "evi_occupancy").collect()
    assert got and got == {(r.dims["relation"], r.metric): r.number for r in own}


def test_table_shape_reads_the_table_once(spark, tmp_path):
    rows = [("a", "x", 1), ("a", "x", 1), ("a", "y", 1), ("b", None, 2), (None, "x", 3), (None, "x", 3), ("", "x", 3), ("c", "", None)]
    spark.createDataFrame(rows, "k string, l string, n int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    shape = profile.table_shape(df, "t", ["k"])
    assert [tuple(r) for r in shape.collect()] == [("t", 8, 3, 4, 2, 5)]
    assert shape.columns == ["table_name", "row_count", "column_count", "missing_cells", "exact_duplicate_rows", "rows_in_duplicated_keys"]
    assert profile.table_shape(df, "t", ["k", "l"]).first().rows_in_duplicated_keys == 4
    assert tuple(profile.table_shape(df.limit(0), "t", ["k"]).first()) == ("t", 0, 3, 0, 0, 0)
    assert shape._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def shuffles_on_disk(spark, but: frozenset[str] = frozenset()) -> frozenset[str]:
    """Shuffles with files in the local folder, ``but`` those. Files of ended queries are deleted in the background, hence the wait."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    for _ in range(20):
        names = blocks.getAllBlocks().mkString(" ").split()
        found = frozenset(n.split("_")[1] for n in names if n.startswith("shuffle_")) - but
        if not found:
            break
        time.sleep(0.1)
    return found


def two_rows_each(spark, grouped: Sequence[str] = ()) -> Layer:
    """Every source with two rows; those ``grouped`` come out of an aggregate."""
    def rows(table, columns):
        found = spark.createDataFrame([("1",) * len(columns), ("2",) * len(columns)], ", ".join(f"{x} string" for x in columns))
        return found.distinct() if table in grouped else found

    return Layer({t: (lambda t=t, c=columns: rows(t, c)) for t, (_, columns) in SOURCES.items()})


def test_tables_are_counted_one_after_the_other(spark, tmp_path, monkeypatch):
    """A table is one query, or one for each share of its keys where its rows are shuffled before; shuffle files are gone before the next one."""
    grouped = ["university_courses", "crm_opportunity_contacts"]
    before, left, made, shape = shuffles_on_disk(spark), [], [], profile.table_shape
    monkeypatch.setattr(profile, "table_shape", lambda df, table, keys: made.append(table) or shape(df, table, keys))
    for module in (document, crm):
        def staged(df, stage=module.stage):
            found = stage(df)
            left.append(shuffles_on_disk(spark, before))
            return found

        monkeypatch.setattr(module, "stage", staged)
    draft = document.write_document(spark, two_rows_each(spark, grouped), "2024-01-01", str(tmp_path / "audit"), ["structure", "evidence"])
    assert made == [t for t in SOURCES for _ in range(document.SHARES if t in grouped else 1)]
    assert len(left) > len(made) and not any(left)
    whole = {r.metric: r.number for r in read_document(draft).where("name = 'all'").collect()}
    assert whole["tables"] == len(SOURCES) and whole["row_count"] == 2 * len(SOURCES) and whole["exact_duplicate_rows"] == 0


def test_shapes_of_shares_add_up(spark):
    """Keys of one part or two, NULL in either, rows that repeat: the shares of a table give the shape of the whole, whatever their number."""
    rows = [(None if i % 11 == 0 else f"k{i % 50}", None if i % 7 == 0 else i % 3, "x" if i % 5 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, l int, m string")
    for keys in (["k"], ["k", "l"]):
        whole = profile.table_shape(df, "t", keys)
        for shares in (1, 2, 5):
            parts = [profile.share_of_keys(df, keys, i, shares) for i in range(shares)]
            added = profile.added_shapes([profile.table_shape(p, "t", keys) for p in parts])
            assert added.columns == whole.columns and added.dtypes == whole.dtypes
            assert added.collect() == whole.collect()
            assert shares == 1 or all(0 < p.count() < len(rows) for p in parts)
        again = sum(n for n in Counter(r[:len(keys)] for r in rows).values() if n > 1)
        assert tuple(whole.first()) == ("t", 600, 3, sum(r.count(None) for r in rows), 600 - len(set(rows)), again)


def test_short_lived_shuffles_put_the_setting_back(spark):
    for value in (None, "false", "true"):
        spark.conf.unset(CLEANUP) if value is None else spark.conf.set(CLEANUP, value)
        inherited = spark.conf.get(CLEANUP, None)
        with short_lived_shuffles(spark):
            assert spark.conf.get(CLEANUP) == "true"
        assert spark.conf.get(CLEANUP, None) == inherited
    spark.conf.unset(CLEANUP)


def test_a_row_of_the_shape_shuffle_is_short(spark):
    """A print is two numbers, and nothing but its count goes with it."""
    df = spark.createDataFrame([(i % 7, None if i % 3 else "x", None) for i in range(60)], "k int, l string, m string")
    shape = profile.table_shape(df, "t", ["k"])
    assert tuple(shape.first()) == ("t", 60, 3, 100, 46, 60)
    row = next(line for line in shape._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [p" in line)
    assert row.split("Aggregate [")[1].split("]")[0].count("#") == 2


def test_bridge_counts_pairs_without_a_deal_or_a_person(spark, table):
    """Pairs that repeat, without a key, or of unknown deals and persons are counted, and agree with nobody; a deal known twice counts for each."""
    tables = {
        "crm_opportunity_contacts": table("opportunity_id string, contact_id string", ("1", "a"), ("1", "a"), ("1", "b"), ("2", "b"), ("9", "a"), ("1", "z"), (None, "a"), ("2", None)),
        "crm_opportunities": table("opportunity_id string, account_id string", ("1", "x"), ("2", "y"), ("2", "y"), ("3", None)),
        "crm_contacts": table("contact_id string, account_id string", ("a", "x"), ("b", "y"), ("c", None)),
    }
    got = crm.bridge(tables, "2024-01-01").first().asDict()
    assert got == {"total_pairs": 8, "duplicate_pairs": 1, "same_account": 4, "expected_same_account": 4.0}
    none = crm.bridge({name: df.limit(0) for name, df in tables.items()}, "2024-01-01").first().asDict()
    assert (none["total_pairs"], none["duplicate_pairs"], none["same_account"]) == (0, 0, 0)

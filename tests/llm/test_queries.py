"""Registered queries against their SQL, and the pipeline's stages, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm.oracle import ORACLE
from strata.llm.queries import registered

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    found = registered()[name](spark, FOLDER)
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(found.columns)
    key = lambda row: tuple(map(str, row))
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=key) == sorted(result.fetchall(), key=key)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES][1] == "n-gram Jaccard join"
    odd = spark.createDataFrame([(90_001, None, None, None, 0), (90_002, "", "en", "s", 0), (90_003, "12 34", "en", "s", 5)], docs.schema)
    rows = docs.unionByName(odd)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, rows = rows, stage(spark, rows, FOLDER)
        assert rows.schema.names == docs.schema.names
        if number == 0:
            assert rows.where("doc_id > 90000").isEmpty() and rows.count() >= 0.98 * docs.count()
        if number == 1:
            assert rows.select("doc_id").distinct().count() == rows.count() < before.count()
        if number == 2:
            assert rows.where(F.char_length("text") != F.col("n_chars")).isEmpty()
        if number == 3:
            assert rows.select("doc_id").distinct().count() == before.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER)
    assert packed.select("doc_id").distinct().count() == rows.select("doc_id").distinct().count()
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0


def test_near_duplicates_with_null_and_repeated_ids(spark):
    def text(seed, edited=None):
        words = [f"w{seed}x{k}" for k in range(120)]
        if edited is not None:
            words[edited] = "edited"
        return " ".join(words)

    rows = [(None, text(1)), (None, text(1, 5)), (None, text(1)),  # near copies without id: one stays
            (None, text(2)), (7, text(2, 9)),  # the one with an id stays
            (8, text(3)), (8, text(4)),  # one id, two texts: both stay
            (9, text(5)), (9, text(5, 60)), (9, text(5)),  # one id, near copies: one stays
            (3, text(6)), (3, text(7)), (2, text(7, 80)),  # 3 is first of one class only
            (None, text(8)), (4, "..."), (4, "!!!"), (None, "..."),
            (5, None), (5, None), (5, " "), (None, " "), (None, " ")]  # without words
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()]
    near = {t: seed for seed in range(1, 9) for t in (text(seed), *(text(seed, k) for k in (5, 9, 60, 80)))}
    found = sorted(((near.get(t, t), i) for i, t in kept), key=str)
    assert found == sorted([(1, None), (2, 7), (3, 8), (4, 8), (5, 9), (6, 3), (7, 2), (8, None), ("...", 4), ("!!!", 4),
                           (None, 5), (" ", 5), (" ", None), (" ", None)], key=str)

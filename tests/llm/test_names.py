"""Columns of any name, many languages, sources without tokens."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import langid, mixing, repeats

CLASHING = ("s", "b", "fits", "passes", "rest", "before", "until_id", "until_place", "mix_source", "mix_place", "size", "own_0", "found", "found_0", "row", "n_removed")


def table(spark, n=40):
    words = np.random.default_rng(3).integers(0, 500, (n, 60))
    rows = [(k, " ".join(f"w{x}" for x in words[k]), ("big", "mid", None)[k % 3], ("en", "de")[k % 2]) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").withColumns(
        {c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in CLASHING})


def own_values_stay(got):
    rows = got.select("doc_id", *CLASHING).collect()
    assert rows and all(r[c] == f"{c} {r['doc_id']}" for r in rows for c in CLASHING)
    return len(rows)


def test_mixing_and_languages_keep_columns_of_any_name(spark):
    docs = table(spark)
    assert own_values_stay(mixing.mix(docs, repetition=2.0)) >= 40
    network = langid.Network.fresh(["de", "en"], 3)
    assert own_values_stay(langid.identify(docs, network)) == 40


def test_stages_keep_columns_of_any_name(spark):
    docs = table(spark).unionByName(table(spark).limit(2))
    cut = corpus_pipeline.drop_repeats(spark, docs, "")
    assert cut.columns == docs.columns
    assert own_values_stay(cut) == 38  # the two that repeat, and their copies, are cut as a whole
    assert own_values_stay(corpus_pipeline.mix_sources(spark, docs, "")) >= 42


def test_operator_replaces_its_own_column(spark):
    got = repeats.remove_repeats(table(spark, 3), keep_text=True)
    assert got.columns.count("n_removed") == 1 and {r["n_removed"] for r in got.collect()} == {0}


def test_sources_without_tokens_are_read_once(spark):
    docs = spark.createDataFrame([(k, "x y", "none" if k < 3 else "some", None if k == 0 else -k if k < 3 else 5) for k in range(6)],
                                 "doc_id bigint, text string, source string, cost bigint")
    for parts in ({"repetition": 2.0}, {"budget_part": 2.0, "entropy_part": 0.5}):
        read = [r["doc_id"] for r in mixing.mix(docs, tokens=F.col("cost"), **parts).collect()]
        assert [read.count(k) for k in range(3)] == [1, 1, 1] and set(read) == set(range(6))


def test_every_language_is_learned(spark):
    docs = spark.createDataFrame([(k, f"text {chr(97 + k % 26)}{k % 70}", f"l{k % 70:02}") for k in range(1400)], "doc_id bigint, text string, lang string")
    network = langid.train(docs, documents=700, rounds=2, hidden=2)
    assert network.labels == [f"l{k:02}" for k in range(70)]

"""Exact copies by content sort against a plain version; nulls, ties, repeats, large groups, clashing names, the plan."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from strata.llm import contents
from strata.llm.common import prepared

SCHEMA = "doc_id bigint, text string, mark string, piece int, head string, kept int"


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepared(spark)


def plain(rows):
    groups = {}
    for i, t in rows:
        t = t or ""
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", "", t), []).append((-len(t), i is None, i or 0, i))
    out = []
    for body, members in groups.items():
        members.sort(key=lambda m: m[:3])
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), k == 0, sha) for k, m in enumerate(members)]
    return sorted(out, key=str)


def found(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1, "h", 2) for i, t in rows], SCHEMA)
    got = contents.exact_copies(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted(map(tuple, got), key=str)


def test_small_groups_nulls_and_ties(spark):
    rows = [(1, "a b"), (2, "ab "), (3, " a\tb"), (4, None), (5, ""), (6, " \r\n\x0b\x0c"), (7, "x" * 50_000), (8, "x" * 49_999 + " x"), (9, "ä b"), (10, "äb"),
            (None, "ab  "), (None, "only"), (None, "only"), (11, "same"), (11, "same"), (12, "日本"), (12, "other"), (13, "ab\x00"), (14, "\x00ab")]
    assert found(spark, rows) == plain(rows)


def test_large_groups_are_cut_and_put_together(spark):
    r = random.Random(3)
    rows = [(i, "hot text" + " " * r.randint(0, 3)) for i in range(300)] + [(i, "hot text " + str(i % 40)) for i in range(300, 500)]
    rows += [(None, "hot text   "), (None, "null\tids"), *[(None, "nullids") for _ in range(120)], *[(None, None) for _ in range(90)]]
    r.shuffle(rows)
    assert found(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert contents.exact_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_range_partitions_serve_the_window(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(contents, "staged", lambda df: plans.append(df) or df)
    contents.exact_copies(spark.createDataFrame([(1, "a", "x", 1, "h", 2)], SCHEMA))
    text = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in text and "Python" not in text and "Pandas" not in text and "Arrow" not in text
    window = text[:text.index("rangepartitioning")]
    assert window.count("Window") >= 1 and "hashpartitioning" not in window

"""The prefix trie against a plain version; the double array; nulls, ties, repeats, hot groups, empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from strata.llm import trie
from strata.llm.common import prepared
from strata.llm.doublearray import DoubleArray

SCHEMA = "conv_id bigint, turn bigint, role string, text string, d int, p1 string, chunk int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepared(spark)


def plain(rows):
    """rows: (conv_id, turn, role, text), no ties."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, who in members.items():
        own_saved = (len(who) - 1) * len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += own_saved
    return sorted(((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children.get(node, [])), leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, sorted(c for c in who if built[c] == node))).encode()).hexdigest()) for node, who in members.items()), key=str)


def found(spark, rows, most=trie.MOST):
    df = spark.createDataFrame([(c, n, r, t, 1, "x", 2) for c, n, r, t in rows], SCHEMA)
    return sorted(map(tuple, trie.nodes(df.repartition(3), most).select(*COLUMNS).collect()), key=str)


def talks(seed, n, turns=6, texts=3):
    r = random.Random(seed)
    rows = [(c, k, r.choice(["user", "assistant", None]), r.choice(["hello there", "a b\tc\n", None, "", "x"][:texts])) for c in range(n) for k in range(r.randint(1, turns))]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [1, 3, 2000])
def test_nodes_equal_a_plain_trie(spark, most):
    rows = talks(1, 70) + [(c, k, "user", f"turn {k}") for c in range(200, 300) for k in (None, 0, 1, 2)][:399] + [(7000, k, "user", f"deep {k}") for k in range(120)]
    rows += [(None, 0, "user", "nobody's"), (-7, 0, "user", "below zero"), (-20, 1, "user", "base of it"), (-20, 0, None, "x y z"), (9000, 0, "user", "long " * 3000)]
    assert found(spark, rows, most) == plain(rows)


def test_small_shards_are_packed_apart(spark, monkeypatch):
    monkeypatch.setattr(trie, "ROWS", 5)
    rows = talks(2, 60, 4, 5)
    assert found(spark, rows, 4) == plain(rows)


def test_hot_conversation_and_equal_ones(spark):
    rows = [(5, k, "user", f"w{k % 7} v") for k in range(300)] + [(c, k, "a", "same same") for c in range(100, 220) for k in range(3)]
    assert found(spark, rows, 2) == plain(rows)


def test_turnless_and_empty(spark):
    one = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20)
    assert found(spark, [(one, 0, "user", "lost")]) == plain([(one, 0, "user", "lost")])
    assert len(found(spark, [(one, 0, "user", "lost")])) == 1
    assert found(spark, []) == []


def test_repeated_rows_are_turns_each(spark):
    got = found(spark, [(20, 1, "user", "again")] * 4)
    assert [g[1] for g in got] == [0, 1, 2, 3, 4] or len(got) == 5


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_double_array_holds_what_was_put_in(seed):
    r = np.random.default_rng(seed)
    sequences = [tuple(r.integers(0, 40, r.integers(1, 8)).tolist()) for _ in range(600)]
    array, here, seen = DoubleArray(), {(): 0}, {()}
    for level in range(8):
        now = [s for s in sequences if len(s) > level]
        if now:
            states = array.extend(np.array([here[s[:level]] for s in now]), np.array([s[level] for s in now]))
            for s, state in zip(now, states.tolist(), strict=True):
                assert here.setdefault(s[:level + 1], state) == state
                seen.add(s[:level + 1])
    assert len(set(here.values())) == len(seen)  # a state for each prefix
    for prefix, state in here.items():
        to = array.go(np.full(40, state), np.arange(40))
        for i in range(40):
            assert to[i] == here.get((*prefix, i), -1)
    assert array.end < 4 * len(seen) + 40

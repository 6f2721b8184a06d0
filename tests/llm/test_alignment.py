"""Cross-tokenizer alignment against a plain version that encodes whole texts; the perfect hash; slices of the counts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from strata.llm import alignment, perfect, queries, tokens
from strata.llm.common import prepared

SCHEMA = "doc_id bigint, text string, n_a string, task int, pair int, hash int, shard int"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepared(spark)


def aligned(text):
    """Groups of ids of a whole text, or None."""
    a_path, b_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    if not text:
        return None
    tokenizer, model = tokens.load(a_path), alignment.piece_model(b_path)
    a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    (da, sa, na), (db, sb, nb) = alignment.byte_level(a_path), alignment.piece_level(b_path)
    bytes_a = [da[sa[i]:sa[i] + na[i]].tobytes() for i in a]
    bytes_b = [db[sb[i]:sb[i] + nb[i]].tobytes() for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    groups, i, j = [], 0, 0
    while i < len(a):
        ga, gb, x, y = [a[i]], [b[j]], len(bytes_a[i]), len(bytes_b[j])
        i, j = i + 1, j + 1
        while x != y:
            if x < y:
                ga, x, i = [*ga, a[i]], x + len(bytes_a[i]), i + 1
            else:
                gb, y, j = [*gb, b[j]], y + len(bytes_b[j]), j + 1
        groups.append((ga, gb))
    return groups


def plain(texts):
    all_groups = [aligned(t) for t in texts]
    counts = Counter((ga[-1], gb[-1]) for g in all_groups if g for ga, gb in g)
    best = {}
    for (_, second), n in counts.items():
        best[second] = max(n, best.get(second, 0))
    out = []
    for g in all_groups:
        if not g:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(ga[-1], gb[-1]) for ga, gb in g]
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(g), sum(counts[p] == best[p[1]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(shown.encode()).hexdigest()))
    return out, counts


def sample():
    r = random.Random(5)
    words = ["the", "Schön", "naïve", "x", "re-entry", "don't", "1234567", "日本語", "emoji😀", "<s>", "</s>", "<|endoftext|>", "ﬁne", "É", "tokenization", "é"]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(60)]
    texts += [None, "", " ", "  two  spaces ", "\n", "line\n\nline\tx ", "▁", "a ▁b", " nbsp 　wide", "\x00", "<0x41>", "trailing ", " lead", "a  b", "�",
              "same same same", "same same same", "y" * 5000, "long " * 4000]
    return texts


def test_alignment_equals_whole_texts(spark):
    texts = sample()
    ids = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "x", 1, 2, 3, 4) for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(5)
    want, counts = plain(texts)
    expected = sorted([(i, *w) for i, w in zip(ids, want, strict=True)], key=str)
    assert sorted(map(tuple, alignment.align(docs).select(*COLUMNS).collect()), key=str) == expected
    assert {(r["a_id"], r["b_id"]): r["links"] for r in alignment.pair_counts(docs).collect()} == counts
    assert sum(w[0] > 0 for w in want) > 65  # most texts are given back as they are


def test_slices_and_tree_give_the_same(spark, monkeypatch):
    texts = sample()
    docs = spark.createDataFrame([(i, t, "x", 1, 2, 3, 4) for i, t in enumerate(texts)], SCHEMA).repartition(7)
    expected = sorted([(i, *w) for i, w in enumerate(plain(texts)[0])], key=str)
    monkeypatch.setattr(perfect, "SHARD_KEYS", 40)
    monkeypatch.setattr(alignment, "FAN", 2)
    assert sorted(map(tuple, alignment.align(docs, most_pairs=60).select(*COLUMNS).collect()), key=str) == expected


def test_registered_query_on_whole_small_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted([(r["doc_id"], *w) for r, w in zip(rows, plain([r["text"] for r in rows])[0], strict=True)])
    assert sorted(map(tuple, queries.registered()["op12_alignment_counts"](spark, folder).select(*COLUMNS).collect())) == expected


@pytest.mark.parametrize("most", [0, 3, 40])
def test_parts_that_are_kept_or_not(monkeypatch, most):
    monkeypatch.setattr(alignment, "MOST_PARTS", most)
    known = alignment.Aligned(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    texts = [t for t in sample() if t and aligned(t)]
    batch = [pa.RecordBatch.from_arrays([pa.array([t])], ["text"]) for t in texts]
    found = [known.digests(parts, cut)[0] for _, _, parts, cut, _ in known.blocks(iter(batch))]
    shown = [";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in aligned(t)) for t in texts]
    assert found == [hashlib.sha256(t.encode()).hexdigest() for t in shown]


def test_empty_tables(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA)).count() == 0
    only = alignment.align(spark.createDataFrame([(1, None, "x", 1, 2, 3, 4)], SCHEMA)).collect()
    assert [tuple(r) for r in only] == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 5000])
def test_perfect_hash_is_minimal_and_verified(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
    seeds, slot = perfect.build(keys)
    assert sorted(slot.tolist()) == list(range(len(keys)))
    by_slot = np.empty(len(keys), np.uint64)
    by_slot[slot] = keys
    table = perfect.Table(1, [(0, seeds, by_slot, np.arange(len(keys)) + 1)])
    assert (table.index(keys) == slot).all() and (table.find(keys ^ np.uint64(1 << 63)) == 0).all()

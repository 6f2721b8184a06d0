"""Operators for training text against plain versions, and on nulls, empty and long texts, ties, repeats, empty tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import archive, attribution, chat, components, forest, jaccard, langid, mixing, packing, repeats, simhash, tokens, words
from strata.llm.common import prepared
from strata.llm.queries import registered

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double"


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepared(spark)


def docs_of(spark, texts, ids=None):
    """Rows of documents with a column whose name operators use themselves (score)."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}" if k % 4 else None, None, 0.5) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], DOC)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijk") for _ in range(r.randint(1, 7))) for _ in range(n))


BASE = prose(1, 400)
NEAR = BASE.split()
NEAR[200] = "edited"
ODD = [None, "", " \n\t ", "one", "One two three", BASE, BASE, " ".join(NEAR), prose(2, 90), "ab " * 700, "é" * 900, prose(3, 60) + BASE[300:900] + prose(4, 60),
       "\x00 nul </turn> ### \\", prose(5, 3000), "aé日本 " * 200]


# chat -------------------------------------------------------------------------------------------------------

def test_escape_is_reversible():
    for text in ("", "\\", "\\### Assistant: </turn> ok", "####</turn></turn>\n### user: x", "\\\\#", "a:b\n"):
        assert chat.unescape(chat.escape(text)) == text
        turns = [("user", text), (text, text), ("assistant", text)]
        shown = chat.marked_turns(turns)
        assert chat.read_back(shown) == turns


def test_spans_of_black_box_templates():
    turns = [("user", "hi"), ("assistant", ""), ("user", "x</turn>"), ("assistant", " yes")]
    text, spans, rewrites = chat.trace(chat.marked_turns, turns)
    assert not rewrites and "".join(text[s:e] for s, e, _, _ in spans) == text
    assert [chat.unescape(text[a:b]) for _, _, a, b in spans] == [t for _, t in turns]

    def closing(said):
        return "".join(f"<{r}>{t}\n" for r, t in said) + "[end]"

    text, spans, rewrites = chat.trace(closing, turns)
    assert not rewrites and [text[a:b] for _, _, a, b in spans] == [t for _, t in turns]

    def counting(said):
        return f"{len(said)} turns: " + "".join(f"<{r}>{t}\n" for r, t in said)

    assert chat.trace(counting, turns)[2]


def test_conversations(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, formatted string"
    rows = [(1, 1, "assistant", "b", "x"), (1, 0, "user", "a", "x"), (2, 0, None, None, "x"), (None, 0, "user", "q", "x"), (3, 0, "user", "t", "x"),
            (3, 0, "user", "t", "x"), (3, 1, "assistant", "z" * 5000, "x")]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\na\nassistant\nb\n").hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(b"b").hexdigest() and got[1]["loss_chars"] == 1
    assert got[2]["n_turns"] == 1 and got[2]["loss_chars"] == 0 and got[3]["n_turns"] == 3 and got[3]["loss_chars"] == 5000 and got[None]["n_turns"] == 1
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


# n-gram Jaccard join ----------------------------------------------------------------------------------------

def plain_sets(texts):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(table))
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def plain_components(ids, sets):
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and 100 * both >= 75 * len(sets[i] | sets[j]):
            root[top(j)] = top(i)
    least = {}
    for i, d in enumerate(ids):
        least[top(i)] = min(d, least.get(top(i), d))
    return [least[top(i)] for i in range(len(ids))]


def near_group(seed, size, edits):
    r, base = random.Random(seed), prose(seed, 120).split()
    for _ in range(size):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"x{r.random()}"
        yield " ".join(w)


@pytest.mark.parametrize("frequent, least", [(1 / 5000, 8), (1 / 20, 2)])
def test_jaccard_components(spark, monkeypatch, frequent, least):
    monkeypatch.setattr(jaccard, "LEAST", least)
    passage = prose(77, 30)
    texts = [*ODD, *near_group(10, 40, 6), *near_group(11, 25, 3), *(f"{prose(100 + k, 25)} {passage}" for k in range(30)), "a b c d e f g", "A b c d e F g",
             "a b c d e f g h", "x y z", "x  y\nz"]
    sets, ids = plain_sets(texts), list(range(len(texts)))
    got = {r[0]: (r[1], r[2]) for r in jaccard.jaccard_components(docs_of(spark, texts), frequent=frequent).collect()}
    assert got == {i: (len(sets[i]), c) for i, c in zip(ids, plain_components(ids, sets), strict=True)}


def test_jaccard_whole_sets_without_a_shuffle_of_all_texts(spark):
    texts = [f"{BASE} {i}" for i in range(3000)]
    docs = docs_of(spark, texts, [None if i % 1000 == 999 else 7 * i - 700 for i in range(3000)])
    ids = [7 * i - 700 for i in range(0, 3000, 60)]
    wanted = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    got = [r.doc_id for r in jaccard._near(docs.select("doc_id", "text"), wanted).collect()]
    assert {*ids, None} <= {*got} and got.count(None) == 3 and len(got) < len(ids) + 3 + 300
    sets = jaccard._live_sets(docs, wanted, 5)
    assert sets.count() == len(ids) + 3
    assert jaccard._live_sets(docs, wanted.where("doc_id is null"), 5).count() == 3


def test_jaccard_sketches_join_once_per_node(spark, monkeypatch):
    seen = []
    compare = jaccard._compare
    monkeypatch.setattr(jaccard, "_compare", lambda rows, *more: seen.append(rows.columns) or compare(rows, *more))
    variants = [BASE] + [BASE + f" and {i} more words that differ" for i in range(40)]
    jaccard.jaccard_components(docs_of(spark, variants)).collect()
    assert seen and all("sketch" not in columns for columns in seen)


def test_jaccard_index_rows_are_small(spark):
    """A row of the largest shuffle has some 20 bytes that are not zero, and what is read from it is the set's name and size."""
    docs = docs_of(spark, [prose(k, 300) for k in range(10, 30)] + [BASE, " ".join(NEAR)])
    index = jaccard._index(docs, np.zeros(0, np.uint64), 5)
    rows = index.collect()
    assert sum(8 - np.array(r, np.int64).tobytes().count(0) for r in rows for r in r) <= 21 * len(rows)
    assert all(np.array(r, np.int64).tobytes()[:2] == b"\0\0" for r in {r.signature for r in rows})
    wanted = {}
    for text in (BASE, " ".join(NEAR)):
        own = next(jaccard.sets_of(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]), 5))
        hi, lo = jaccard.named([jaccard.node_of(own)])
        wanted[int(hi[0]), int(lo[0])] = len(own)
    shared = jaccard._shared_signatures(index).collect()
    assert {(r.hi, r.lo): r.n for r in shared} == wanted and {(r.first_hi, r.first_lo): r.first_n for r in shared}.items() <= wanted.items()


def test_jaccard_odd_rows(spark):
    got = sorted(tuple(r) for r in jaccard.jaccard_components(docs_of(spark, [BASE, BASE, None, BASE], [7, 7, 7, 3])).collect())
    assert got == [(3, len(plain_sets([BASE])[0]), 3), (7, 0, 7), (7, len(plain_sets([BASE])[0]), 3), (7, len(plain_sets([BASE])[0]), 3)]
    assert jaccard.jaccard_components(docs_of(spark, [])).count() == 0
    assert {r[2] for r in jaccard.jaccard_components(docs_of(spark, [BASE, BASE], [None, 5])).collect()} == {5}


def test_classes_take_more_links(spark):
    """Links that come in two lots: paths, stars and rings, classes that the second lot joins, nodes that are new in it."""
    rng = random.Random(9)
    first = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 130)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    second = [(60, 129), (500, 501), (501, 30), (600, 601), (601, 600), (7, 7)] + [(rng.randrange(200, 600), rng.randrange(200, 600)) for _ in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    def lot(pairs):
        for a, b in pairs:
            if a != b:
                x, y = sorted((find(a), find(b)))
                root[y] = x
        return {x: find(x) for x in root}

    classes = components.connected(spark.createDataFrame(first, "a bigint, b bigint"))
    assert {r.node: r.root for r in classes.collect()} == lot(first)
    more = components.merged(classes, spark.createDataFrame(second, "a bigint, b bigint"))
    assert {r.node: r.root for r in more.collect()} == lot(second)


def test_similar_sets_share_a_signature():
    r = np.random.default_rng(3)
    for n in (3, 4, 5, 9, 17, 40, 133):
        for _ in range(60):
            union = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
            often = np.sort(r.choice(union, r.integers(0, len(union) + 1), replace=False))
            lost = int((len(union) - -(-3 * len(union) // 4)))
            out = r.permutation(len(union))[:lost]
            cut = r.integers(0, lost + 1)
            x, y = np.delete(union, out[:cut]), np.delete(union, out[cut:])
            assert len(np.intersect1d(jaccard.signatures(x, often), jaccard.signatures(y, often))) or min(len(x), len(y)) < 3
            assert jaccard.may_link(len(x), jaccard.sketch(x), len(y), jaccard.sketch(y))


# mixing -----------------------------------------------------------------------------------------------------

def test_exponents():
    shares = [0.7, 0.2, 0.1]
    a = mixing.exponent_for_entropy(shares, 0.9)
    assert abs(mixing.entropy(mixing.tempered(shares, a)) - 0.9 * np.log(3)) < 1e-9
    b = mixing.exponent_for_repetition(shares, 2.0)
    assert abs(mixing.spread(shares, mixing.tempered(shares, b)) - 2.0) < 1e-9
    assert mixing.exponent_for_entropy([0.5, 0.5], 0.9) == 1.0 and mixing.exponent_for_repetition([1.0], 3.0) == 0.0


def test_mixture_keeps_budgets(spark):
    texts = [prose(k, 3 + k % 11) for k in range(300)]
    rows = docs_of(spark, texts).withColumn("source", F.when(F.col("doc_id") < 200, "big").when(F.col("doc_id") < 280, "mid"))
    got = mixing.mix(rows, budget_part=1.0, entropy_part=1.0, block_tokens=100).collect()
    count = {k: sum(len(texts[i].split()) for i in ids) for k, ids in (("big", range(200)), ("mid", range(200, 280)), (None, range(280, 300)))}
    budget = sum(count.values()) / 3
    for source, tokens_in in count.items():
        own = [r for r in got if r["source"] == source]
        used = sum(r["mix_tokens"] for r in own)
        assert budget - 14 <= used <= budget + 1
        times = {}
        for r in own:
            times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        whole = int(budget // tokens_in)
        assert all(whole <= t <= whole + 1 for t in times.values())
    kept = mixing.mix(rows, repetition=2.0)
    assert kept.select("doc_id").distinct().count() == 300
    assert mixing.mix(docs_of(spark, []), repetition=2.0).count() == 0
    assert mixing.mix(docs_of(spark, ODD), repetition=2.0).select("doc_id").distinct().count() == len(ODD)


# WARC -------------------------------------------------------------------------------------------------------

def test_archive_round_trip(spark):
    schema = "page_id bigint, url string, html string, key string"
    rows = [(5, "http://www.Example.com:8080/a?b=1#c", "<p>é</p>\r\n\r\nx", "k"), (3, "https://example.com/", "<p>é</p>\r\n\r\nx", "k"), (8, None, None, "k"),
            (9, "not a url\t\n", "", "k"), (None, "http://[bad", "z" * 200_000, "k"), (3, "https://example.com/", "<p>é</p>\r\n\r\nx", "k")]
    got = archive.round_trip(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 6
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    assert sorted(r["record_type"] for r in by[3]) == ["response", "revisit"] and by[5][0]["refers_to"] == 3 and by[9][0]["refers_to"] == 8
    assert by[8][0]["payload_bytes"] == 0 and by[8][0]["payload_digest"] == archive.sha1_base32(b"") and by[None][0]["payload_bytes"] == 200_000
    assert {bytes(r["payload"]) for r in got if r["payload"] is not None} == {(h or "").encode() for _, _, h, _ in rows}
    assert archive.round_trip(spark.createDataFrame([], schema)).count() == 0
    assert archive.reversed_host_key("http://www.example.com/a?b") == "com,example,www)/a?b"
    short = archive.round_trip(spark.createDataFrame(rows, schema), least_bytes=100).collect()
    assert all(r["record_type"] == "response" for r in short)


# token counts -----------------------------------------------------------------------------------------------

def test_encoding_equals_the_tokenizer():
    path = tokens.default_tokenizer()
    texts = [t or "" for t in ODD] + [" a", "a ", "it's  don't 12 3 x y　z \n\n q", "<|endoftext|> hi", "c'est là été", "  x y"]
    for part in (texts, texts[::-1], *[[t] for t in texts]):
        data = [t.encode() for t in part]
        ids, bounds = tokens.encode(path, np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data]))))
        for k, t in enumerate(part):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == tokens.load(path).encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution(spark, rule):
    got = attribution.attribute_tokens(docs_of(spark, ODD), rule=rule).collect()
    path = tokens.default_tokenizer()
    for k, t in enumerate(ODD):
        whole = f"{f's{k % 3}' if k % 4 else ''}\nen\n{t or ''}\n"
        own = sorted((r for r in got if r["doc_id"] == k), key=lambda r: r["section"])
        sizes = [len(x) + 1 for x in whole.split("\n")[:-1]]
        assert [r["n_chars"] for r in own] == sizes and [r["start_char"] for r in own] == [0, *np.cumsum(sizes)[:-1].tolist()]
        found = tokens.load(path).encode(whole, add_special_tokens=False)
        assert sum(r["n_tokens"] for r in own) == len(found.ids)
        assert abs(sum(r["token_share"] for r in own) - len(found.ids)) < 1e-6
        ends, wanted = np.cumsum(sizes), [0] * len(sizes)
        for a, b in found.offsets:
            met = [i for i in range(len(sizes)) if a < ends[i] and b > ends[i] - sizes[i]]
            over = [min(b, ends[i]) - max(a, ends[i] - sizes[i]) for i in met]
            wanted[met[0] if rule == "first" else met[-1] if rule == "last" else met[int(np.argmax(over))]] += 1
        assert [r["n_tokens"] for r in own] == wanted
    assert attribution.attribute_tokens(docs_of(spark, [])).count() == 0


# language ID ------------------------------------------------------------------------------------------------

def test_gradients():
    r = np.random.default_rng(0)
    network = langid.Network.fresh(["a", "b", "c"], 3)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    lengths = np.array([5, 4, 1])
    x = r.integers(97, 100, (3, 5)).astype(np.uint8)
    target = np.array([0, 2, 1])
    _, grads = network.gradients(x, lengths, target)
    for name, at in (("Uf", (1, 4)), ("Ub", (0, 7)), ("Ef", (int(x[0, 1]), 2)), ("Eb", (int(x[1, 0]), 8)), ("bf", (1,)), ("V", (4, 1)), ("c", (0,))):
        up, down = (langid.Network(network.labels, 3, {k: v.copy() for k, v in network.weights.items()}) for _ in range(2))
        up.weights[name][at] += 1e-4
        down.weights[name][at] -= 1e-4
        slope = (up.gradients(x, lengths, target)[0] - down.gradients(x, lengths, target)[0]) / 2e-4
        assert abs(slope - grads[name][at]) < 1e-4, name


def test_language_held_out(spark):
    r = random.Random(5)
    parts = {"xx": ["ka", "zu", "mo", "ri", "te"], "yy": ["sch", "ein", "ung", "ße", "ver"]}
    rows = [(i, " ".join("".join(r.choice(parts[k]) for _ in range(r.randint(1, 4))) for _ in range(30)), k, "s", 0, 1.0) for i in range(240) for k in [("xx", "yy")[i % 2]]]
    rows += [(900, None, "xx", "s", 0, 1.0), (901, "12 34 !", "xx", "s", 0, 1.0), (902, "", None, "s", 0, 1.0), (903, "zumori " * 9000, None, "s", 0, 1.0), (903, "kamo", None, "s", 0, 1.0)]
    docs = spark.createDataFrame(rows, DOC)
    network = langid.train(docs, rounds=120, hidden=6)
    got = langid.identify(docs, network).withColumn("held", langid.held_out(F.col("doc_id"))).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    for g in got:
        if g["doc_id"] < 240:
            assert g["held"] == (zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2)
    held = [g for g in got if g["held"] and g["doc_id"] < 240]
    assert sum(g["lang"] == g["lang_pred"] for g in held) >= 0.95 * len(held) > 0
    assert {g["lang_pred"] for g in got if g["doc_id"] in (900, 901, 902)} == {"und"} and {g["lang_pred"] for g in got if g["doc_id"] == 903} == {"xx"}
    named = langid.label_positions(network, "ka ß")
    assert len(named) == 5 and named[2] is None
    assert langid.identify(docs_of(spark, []), langid.train(docs_of(spark, []))).count() == 0


# fingerprints -----------------------------------------------------------------------------------------------

def plain_simhash(text):
    data = text.encode()
    _, hashes = words.word_hashes(np.frombuffer(data, np.uint8))
    terms, counts = np.unique(words.shingles(hashes, simhash.WIDTH), return_counts=True)
    out = 0
    for bit in range(64):
        votes = sum((1 if int(t) >> bit & 1 else -1) * (1 + np.log(c)) for t, c in zip(terms, counts, strict=True))
        out |= int(votes > 1e-9) << bit
    return out


def test_edited_neighbours(spark):
    ids = [3, 99, 5, 7, 11, 12, 1, 2, 40, 41, 42, 43, 44, 45, 46]
    for bucket_rows in (3, 8192):
        got = {r["doc_id"]: r for r in simhash.edited_neighbours(docs_of(spark, ODD, ids), bucket_rows=bucket_rows).collect()}
        order = sorted(zip(ids, ODD, strict=True), reverse=True)
        for k, (i, t) in enumerate(order):
            t, following = t or "", order[(k + 1) % len(order)][1] or ""
            cut = len(t) // 3
            edited = t[:len(t) - cut] + following[:cut]
            assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert got[i]["own"] & (1 << 64) - 1 == plain_simhash(t) and got[i]["edited"] & (1 << 64) - 1 == plain_simhash(edited)
            assert got[i]["next"] & (1 << 64) - 1 == plain_simhash(following)
    one = simhash.edited_neighbours(docs_of(spark, ["abc def"], [None])).collect()
    assert len(one) == 1 and one[0]["doc_id"] is None and one[0]["own"] == one[0]["next"]
    assert simhash.edited_neighbours(docs_of(spark, [])).count() == 0
    assert simhash.edited_neighbours(docs_of(spark, ["a", "a", "b"], [4, 4, 4]), bucket_rows=1).count() == 3


def test_within_radius(spark):
    r = random.Random(9)
    base = [r.getrandbits(64) for _ in range(40)]
    prints = base + [b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(6)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(p,) for p in signed] + [(None,)], "fingerprint bigint")
    plain = {(a, b) for a in signed for b in signed if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    for count in (None, 1 << 30):
        got = [(x["query"], x["fingerprint"]) for x in simhash.within_radius(rows, rows, 3, count).collect()]
        assert len(got) == len(set(got)) and set(got) == plain


def test_near_rows(spark):
    """n_near against all pairs: copies, fingerprints a few bits apart, null ids, null fingerprints, columns of the helper's names, empty tables."""
    r = np.random.default_rng(8)
    base = r.integers(-(1 << 63), (1 << 63) - 1, 40, np.int64)
    marks = [int(b) for b in base for _ in range(3)] + [int(b) ^ (1 << int(r.integers(63))) ^ (1 << int(r.integers(63))) ^ k for b in base for k in (0, 1, 7, 15)]
    rows = [(i if i % 11 else None, m if i % 17 else None, "x") for i, m in enumerate(marks)] + [(20, marks[3], "x"), (20, marks[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, own bigint, near_rows string")
    for radius in (0, 3):
        got = simhash.with_near(docs, F.col("doc_id") % 20 == 0, radius).collect()
        near = lambda own: sum(m is not None and bin((m ^ own) & ((1 << 64) - 1)).count("1") <= radius for _, m, _ in rows)  # noqa: B023, E731
        want = [(i, m, "x", near(m) if i is not None and i % 20 == 0 and m is not None else None) for i, m, _ in rows]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and any(w[3] and w[3] > 3 for w in want)
    assert simhash.with_near(docs.limit(0), F.col("doc_id") % 20 == 0).count() == 0


def test_registered_simhash(spark, tmp_path):
    """The registered query against plain fingerprints of whole texts."""
    rows = [(i, " ".join(f"w{(i // 2 if i % 2 else i) * 31 % 97}x{k}" for k in range(i * 3 % 50)) if i % 9 else None) for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = {x["doc_id"]: x for x in registered()["op7_simhash"](spark, str(tmp_path)).collect()}

    def mark(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return int(simhash.fingerprints(data, np.array([0, len(data)]))[0])

    texts = [t or "" for _, t in rows]
    marks = [mark(t) for t in texts]
    bits = lambda a, b: bin(a ^ b).count("1")
    for i, text in enumerate(texts):
        following = texts[i - 1]  # falling ids; after the last comes the first
        edited = text[:len(text) - len(text) // 3] + following[:len(text) // 3]
        x = found[i]
        assert (x["n_chars"], x["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (x["fingerprint"], x["edited_fingerprint"]) == (f"{marks[i]:016x}", f"{mark(edited):016x}")
        assert (x["near_edited"], x["near_next"]) == (1 - bits(marks[i], mark(edited)) / 64, 1 - bits(marks[i], marks[i - 1]) / 64)
        assert x["n_near"] == (sum(bits(marks[i], m) <= 3 for m in marks) if i % 20 == 0 else None)
    assert len(found) == 60


# nearest neighbours -----------------------------------------------------------------------------------------

def test_forest_recall(spark):
    r = np.random.default_rng(2)
    centres = r.normal(size=(30, 16))
    x = centres[r.integers(0, 30, 1500)] + 0.3 * r.normal(size=(1500, 16))
    x[7] = x[8] = x[9]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (None, [1.0] * 16), (2004, [float("inf")] * 16)]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>")
    got = {}
    for q in forest.Forest(table, cell_rows=200).search(table.where("vec_id % 50 = 0 or vec_id = 9")).orderBy("query_id", "rank").collect():
        got.setdefault(q["query_id"], []).append((q["vec_id"], q["score"]))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q, found in got.items():
        s = unit @ unit[q]
        s[q] = -9
        best = np.lexsort((np.arange(1500), -s))[:5]
        hit += len({v for v, _ in found} & set(best.tolist()))
        assert len(found) == 5 and all(abs(s[v] - score) < 1e-12 for v, score in found)
    assert len(got) == 31 and hit >= 0.9 * 5 * 31 and {v for v, _ in got[9]} >= {7, 8}
    few = spark.createDataFrame(rows[:3], "vec_id bigint, embedding array<double>")
    assert forest.Forest(few).search(few.where("vec_id = 0")).count() == 2
    none = spark.createDataFrame([], "vec_id bigint, embedding array<double>")
    assert forest.Forest(none).search(none).count() == 0
    assert forest.Forest(few).search(none).count() == 0


def test_forest_repeated_rows_and_root(spark):
    """Rows that repeat are candidates each; vectors without near ones are compared with all rows, through one tree and exactly."""
    r = np.random.default_rng(5)
    x = r.normal(size=(900, 48))
    x[100:400] = x[100]  # a third are copies
    ids = [i if i not in (101, 102) else 100 for i in range(900)] + [899]  # ids that repeat, and a whole row that does
    x = np.vstack([x, x[899]])
    table = spark.createDataFrame([(i, [float(c) for c in v], "n") for i, v in zip(ids, x, strict=True)], "vec_id bigint, embedding array<double>, key string")
    found = forest.Forest(table, cell_rows=64).search(table.where("vec_id % 50 = 0")).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 900, 50):
        best = sorted((-round(float(unit[q] @ unit[i]), 12), ids[i]) for i in range(901) if ids[i] != q)[:5]
        assert [v for _, v in best] == [f["vec_id"] for f in sorted(found, key=lambda f: f["rank"]) if f["query_id"] == q]
    assert [f["rank"] for f in found if f["query_id"] == 0].count(1) == 1
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [2.0, 0.0]), (2, [2.0, 0.0])], "vec_id bigint, embedding array<double>")
    assert sorted((f["rank"], f["vec_id"]) for f in forest.Forest(two).search(two.where("vec_id = 0")).collect()) == [(1, 2), (2, 2), (3, 1), (4, 1)]
    with pytest.raises(ValueError):
        forest.Forest(two.unionByName(spark.createDataFrame([(3, [1.0])], two.schema)))


@pytest.mark.parametrize("cosine", [-1.0, 0.0, 0.4, 0.7, 0.9, 0.99, 1.0])
def test_ascent_meets_the_recall(cosine):
    length, trees = forest.ascent(cosine, 24, 0.97)
    one_bit = 1 - np.arccos(cosine) / np.pi
    assert 1 - (1 - one_bit ** length) ** trees >= 0.97 - 1e-9 and trees * 2.0 ** -length <= 1
    if cosine == 1.0:
        assert (length, trees) == (31, 1)


# packing ----------------------------------------------------------------------------------------------------

def test_first_fit_decreasing():
    r = np.random.default_rng(4)
    for n in (0, 1, 2, 50, 333):
        sizes = r.integers(1, 101, n)
        got, room = packing.first_fit_decreasing(sizes, 100), []
        for i in np.argsort(-sizes, kind="stable"):
            k = next((k for k, free in enumerate(room) if free >= sizes[i]), len(room))
            if k == len(room):
                room.append(100)
            room[k] -= sizes[i]
            assert got[i] == k


def test_tokenising_holds_little(monkeypatch):
    """A long batch of texts is tokenised in small steps: its arrays stay far below what whole blocks of it would take."""
    monkeypatch.setattr(tokens, "_KNOWN", {})
    path, texts = tokens.default_tokenizer(), [prose(k, 2000) for k in range(400)]
    tokens.byte_lengths(path)
    batch = pa.RecordBatch.from_pydict({"doc_id": range(400), "text": texts, "group": [0] * 400})
    tracemalloc.start()
    ids = b"".join(b for out in packing._tokenise(path, 0, 1 << 20)(iter([batch])) for b in out.column("ids").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    wanted = [i for t in texts for i in [*tokens.load(path).encode(t, add_special_tokens=False).ids, 0]]
    assert np.frombuffer(ids, "<u4").tolist() == wanted
    assert peak < 64 << 20


def test_known_pieces_are_bounded_by_bytes(monkeypatch):
    """Long pieces fill the memory of known pieces sooner than their number does; what is found stays right."""
    monkeypatch.setattr(tokens, "_KNOWN", {})
    monkeypatch.setattr(tokens.Known, "BYTES", 5000)
    path = tokens.default_tokenizer()
    for k in range(6):
        data = (" ".join(w * 40 for w in prose(k, 60).split())).encode()
        ids, _ = tokens.encode(path, np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        assert ids.tolist() == tokens.load(path).encode(data.decode(), add_special_tokens=False).ids
        assert len(tokens._KNOWN[path].data) <= 10_000


def test_packing(spark):
    texts = ODD + [prose(k, k % 90) for k in range(120)]
    ids = [None, *range(1, len(texts))]
    rows = packing.pack(docs_of(spark, texts, ids), group_documents=20).collect()
    path = tokens.default_tokenizer()
    for i, t in zip(ids, texts, strict=True):
        whole = tokens.load(path).encode(t or "", add_special_tokens=False).ids + [0]
        at = 0
        for p in sorted((p for p in rows if p["doc_id"] == i), key=lambda p: p["start"]):
            part = np.array(whole[at:at + p["length"]], "<u4").tobytes()
            assert p["start"] == at and p["doc_tokens"] == len(whole) and p["ids_crc32"] == zlib.crc32(part)
            at += p["length"]
        assert at == len(whole)
    sequences = {}
    for p in rows:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding <= 0.01 * sum(p["length"] for p in rows)
    assert packing.pack(docs_of(spark, [])).count() == 0
    assert sum(p["length"] for p in packing.pack(docs_of(spark, ["a b", "a b"], [1, 1])).collect()) == 6


# repeats ----------------------------------------------------------------------------------------------------

def plain_removal(texts):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for i in range(len(b) - 399):
            seen[b[i:i + 400]] = seen.get(b[i:i + 400], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if seen[b[i:i + 400]] > 1:
                gone[i:i + 400] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest(), int((~gone).sum())))
    return out


@pytest.mark.parametrize("crowd", [repeats.CROWD, 1])
def test_repeats(spark, crowd):
    r = random.Random(8)
    shared = prose(50, 100)
    texts = [*ODD]
    for k in range(25):
        a = r.randrange(0, 200)
        texts.append(prose(60 + k, r.randint(1, 40)) + " " + shared[a:a + r.randint(150, 480)] + " " + prose(90 + k, r.randint(0, 40)))
    texts += ["q" * 399, "q" * 400, "w" * 401, ("abc" * 140)[:410], shared[:400], shared[1:401]]
    got = {x[0]: tuple(x[1:]) for x in repeats.remove_repeats(docs_of(spark, texts), crowd=crowd).collect()}
    assert [got[k] for k in range(len(texts))] == plain_removal(texts)


def plain_passages(texts, words):
    """What stays when repeated passages of so many words and repeated strings of 400 bytes are cut."""
    seen, places = {}, []
    for k, t in enumerate(texts):
        found = [(len(t[:m.start()].encode()), len(t[:m.end()].encode())) for m in re.finditer(r"\S+", t)]
        b = t.encode()
        windows = [(found[i][0], found[i + words - 1][1]) for i in range(len(found) - words + 1)] + [(i, i + 400) for i in range(len(b) - 399)]
        for x, y in windows:
            seen[b[x:y]] = seen.get(b[x:y], 0) + 1
            places.append((k, x, y))
    gone = [np.zeros(len(t.encode()), bool) for t in texts]
    for k, x, y in places:
        if seen[texts[k].encode()[x:y]] > 1:
            gone[k][x:y] = True
    return [np.frombuffer(t.encode(), np.uint8)[~g].tobytes().decode("utf-8", "ignore") for t, g in zip(texts, gone, strict=True)]


@pytest.mark.parametrize("crowd", [repeats.CROWD, 1])
def test_repeated_passages_of_51_words(spark, crowd):
    letters = " ".join(random.Random(77).choices("abcdefghijklmnopqrstuvwxyz", k=51))
    passages = {n: prose(300 + n, n) for n in (49, 50, 51, 52, 54)} | {51.5: letters, 53: prose(9, 53).replace(" ", "\u3000", 20).replace(" ", "\n", 5)}
    texts = []
    for k, passage in enumerate(passages.values()):
        for side in range(3):
            texts.append(f"{prose(400 + 10 * k + side, 40)} p{k}{side} {passage} q{k}{side} {prose(700 + 10 * k + side, 30)}")
    both = prose(11, 90).split()  # 40 words repeat with one text, 40 with another one: together 80, no passage of 51
    texts += [" ".join(both), "u1 " + " ".join(both[:40]) + " u2", "v1 " + " ".join(both[40:80]) + " v2"]
    twice = prose(12, 51)
    texts += [f"{twice} middle {twice}", "x" * 450 + " " + prose(13, 5), "y " + "x" * 420, prose(14, 50), prose(14, 50), letters, ""]
    rows = repeats.remove_repeats(docs_of(spark, texts), keep_text=True, crowd=crowd, words=51).collect()
    got = {x["doc_id"]: x["text"] for x in rows}
    want = plain_passages(texts, 51)
    assert [got[k] for k in range(len(texts))] == want
    for k, n in enumerate(passages):
        assert all((passages[n] in t) == (n < 51) for t in want[3 * k:3 * k + 3])


def test_repeats_of_other_lengths(spark):
    passage = prose(21, 60)
    texts = [f"{prose(500 + k, 30)} {k} {passage[k:k + 140 + k]} {k} {prose(600 + k, 30)}" for k in range(8)]
    for length in (101, 130):
        data, seen = [t.encode() for t in texts], {}
        for b in data:
            for i in range(len(b) - length + 1):
                seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
        want = [len({j for i in range(len(b) - length + 1) if seen[b[i:i + length]] > 1 for j in range(i, i + length)}) for b in data]
        got = {x["doc_id"]: x["n_removed"] for x in repeats.remove_repeats(docs_of(spark, texts), length=length).collect()}
        assert [got[k] for k in range(8)] == want and any(want)


def test_repeats_keep_rows(spark):
    rows = repeats.remove_repeats(docs_of(spark, [None, BASE, "x", BASE], [1, 2, None, 2]), keep_text=True).collect()
    assert sorted((x["doc_id"] or 0, x["text"], x["n_removed"]) for x in rows if x["text"] is not None) == [
        (0, "x", 0), (2, "", len(BASE)), (2, "", len(BASE))]
    assert [x["doc_id"] for x in rows if x["text"] is None] == [1]
    assert repeats.remove_repeats(docs_of(spark, [])).count() == 0

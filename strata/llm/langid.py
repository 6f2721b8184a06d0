"""Language identification by a bidirectional gated recurrent network over bytes, trained here with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import flat, give_back, text_blocks
from strata.llm.words import mix

#: Bytes of a stretch; longer runs without white space are cut into stretches of this length.
STEPS = 24
UNKNOWN = "und"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0xE7037ED1A0B428DB)


def stretches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, text number) of the stretches of several texts: words, cut every STEPS bytes. All non-space bytes are covered."""
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8)) != 0
    inner = np.zeros(len(data) + 1, bool)
    inner[offsets] = True
    inner[:-1] &= ~space  # a text may begin right after another one's word
    begin = np.flatnonzero((edge | inner)[:-1] & ~space)
    end_mark = (edge | inner)[1:] & ~space
    ends = np.flatnonzero(end_mark) + 1
    pieces = -(-(ends - begin) // STEPS)
    starts = np.repeat(begin, pieces) + flat(np.zeros(len(begin), np.int64), pieces) * STEPS
    lengths = np.minimum(np.repeat(ends, pieces) - starts, STEPS)
    return starts, lengths, np.searchsorted(offsets, starts, "right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals (two bytes, the first of them C3) as small letters; other bytes as they are."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 0x20
    if len(data) > 1:
        capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[capital] += 0x20
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights of both directions (embedding to gates, state to gates, biases) and of the output at every position."""

    labels: list[str]
    hidden: int
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, labels: list[str], hidden: int, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        w: dict[str, np.ndarray] = {}
        for d in "fb":
            w[f"E{d}"] = rng.normal(0, 0.3, (256, 3 * hidden))
            w[f"U{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
            w[f"b{d}"] = np.zeros(hidden)  # added to the state's part of the candidate
        w["V"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, len(labels)))
        w["c"] = np.zeros(len(labels))
        return cls(labels, hidden, {k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, x: np.ndarray, active: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States at every position. x: stretches by falling length; active[t]: how many are longer than t."""
        n, H = len(x), self.hidden
        E, U, b = (self.weights[k + d] for k in "EUb")
        states = np.zeros((x.shape[1], n, H), np.float32)
        h = np.zeros((n, H), np.float32)
        for t in range(x.shape[1]) if d == "f" else range(x.shape[1] - 1, -1, -1):
            m = active[t]
            if not m:
                continue
            before = h[:m]
            a, g = E[x[:m, t]], before @ U
            zr = _sigmoid(a[:, :2 * H] + g[:, :2 * H])
            z, r = zr[:, :H], zr[:, H:]
            inner = g[:, 2 * H:] + b
            cand = np.tanh(a[:, 2 * H:] + r * inner)
            new = cand + z * (before - cand)
            if keep is not None:
                keep.append((t, m, before.copy(), z, r, inner, cand))
            h[:m] = new
            states[t, :m] = new
        return states

    def positions(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities of the labels at every position: (STEPS, stretches, labels); stretches by falling length."""
        active = (lengths[:, None] > np.arange(x.shape[1])).sum(0)
        states = np.concatenate([self._run(x, active, d) for d in "fb"], axis=2)
        scores = states @ self.weights["V"] + self.weights["c"]
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        return scores / scores.sum(axis=2, keepdims=True)

    def gradients(self, x: np.ndarray, lengths: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions and its gradients, by backpropagation through time in both directions."""
        H, T = self.hidden, x.shape[1]
        active = (lengths[:, None] > np.arange(T)).sum(0)
        kept: dict[str, list] = {"f": [], "b": []}
        states = {d: self._run(x, active, d, kept[d]) for d in "fb"}
        both = np.concatenate([states["f"], states["b"]], axis=2)
        p = both @ self.weights["V"] + self.weights["c"]
        p -= p.max(axis=2, keepdims=True)
        p = np.exp(p)
        p /= p.sum(axis=2, keepdims=True)
        mask = (np.arange(T)[:, None] < lengths[None, :]).astype(np.float32)
        total = mask.sum()
        rows = np.arange(len(x))
        loss = float(-(np.log(p[:, rows, target] + 1e-12) * mask).sum() / total)
        p[:, rows, target] -= 1
        p *= (mask / total)[:, :, None]
        grads = {k: np.zeros_like(v) for k, v in self.weights.items()}
        grads["V"] = np.einsum("tnh,tnk->hk", both, p, optimize=True)
        grads["c"] = p.sum((0, 1))
        out = p @ self.weights["V"].T
        for d, part in (("f", out[:, :, :H]), ("b", out[:, :, H:])):
            U = self.weights[f"U{d}"]
            back = np.zeros((len(x), H), np.float32)
            for t, m, before, z, r, inner, cand in reversed(kept[d]):
                dh = back[:m] + part[t, :m]
                dcand = dh * (1 - z) * (1 - cand * cand)
                dz = dh * (before - cand) * z * (1 - z)
                dr = dcand * inner * r * (1 - r)
                state = np.concatenate([dz, dr, dcand * r], axis=1)
                np.add.at(grads[f"E{d}"], x[:m, t], np.concatenate([dz, dr, dcand], axis=1))
                grads[f"U{d}"] += before.T @ state
                grads[f"b{d}"] += (dcand * r).sum(0)
                back[:m] = dh * z + state @ U.T
        return loss, grads


def matrix(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bytes of stretches, one row each, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(STEPS, np.uint8)])
    out = np.lib.stride_tricks.sliding_window_view(padded, STEPS)[starts].copy()
    out[np.arange(STEPS)[None, :] >= lengths[:, None]] = 0
    return out


def fit(x: np.ndarray, lengths: np.ndarray, target: np.ndarray, labels: list[str], hidden: int = 16, rounds: int = 500,
        batch: int = 384, rate: float = 0.02, seed: int = 7) -> Network:
    """Train with Adam on stretches (rows of bytes) and the numbers of their labels. Same input, same network."""
    network = Network.fresh(labels, hidden, seed)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    by_label = [np.flatnonzero(target == k) for k in range(len(labels))]
    share = max(1, batch // max(1, len(labels)))
    for step in range(1, rounds + 1):
        chosen = np.concatenate([rng.choice(own, share) for own in by_label if len(own)])
        chosen = chosen[np.argsort(-lengths[chosen], kind="stable")]
        _, grads = network.gradients(x[chosen], lengths[chosen], target[chosen])
        pace = rate * (1 - 0.9 * step / rounds)
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            network.weights[k] -= (pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return network


def score_block(network: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean label probabilities over all positions of each text: (texts, labels); zeros for a text of white space.

    Equal stretches of a block are evaluated once; what they give is added up for every place where they stand.
    """
    n, K = len(offsets) - 1, len(network.labels)
    out = np.zeros((n, K))
    data = lowered(data)
    starts, lengths, text = stretches(data, offsets)
    if not len(starts):
        return out
    x = matrix(data, starts, lengths)
    key = lengths.astype(np.uint64)
    for column in x.view(np.uint64).T:
        key = mix(key * _BASE + column)
    _, chosen, same = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(-lengths[chosen], kind="stable")
    sums = np.zeros((len(chosen), K))
    for at in range(0, len(order), 8192):
        part = order[at:at + 8192]
        own = lengths[chosen[part]]
        p = network.positions(x[chosen[part]], own)
        p *= (np.arange(STEPS)[:, None] < own[None, :])[:, :, None]
        sums[part] = p.sum(axis=0)
    each = sums[same]
    for k in range(K):
        out[:, k] = np.bincount(text, each[:, k], n)
    return out / np.maximum(1, np.bincount(text, lengths, n))[:, None]


def label_positions(network: Network, text: str) -> list[str | None]:
    """The label of every byte of a text's UTF-8 form; None for white space."""
    data = np.frombuffer(text.encode(), np.uint8)
    out: list[str | None] = [None] * len(data)
    starts, lengths, _ = stretches(data, np.array([0, len(data)]))
    order = np.argsort(-lengths, kind="stable")
    if len(order):
        p = network.positions(matrix(lowered(data), starts, lengths)[order], lengths[order]).argmax(axis=2)
        for k, i in enumerate(order):
            for t in range(lengths[i]):
                out[starts[i] + t] = network.labels[p[t, k]]
    return out


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 4 is 2. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, documents_per_label: int = 400, stretches_per_document: int = 96, documents: int = 25_600, hidden: int = 16,
          rounds: int = 500) -> Network:
    """Learn from text and lang of labelled documents outside the held-out fold.

    Every language takes part. The sample is bounded: of each about ``documents_per_label`` documents, fewer if all together would be more
    than ``documents`` (but about 16 at least), drawn by a hash of doc_id and text, and ``stretches_per_document`` stretches of each, spread
    evenly over the whole text. The number of languages has to be small.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike("\\p{L}") & ~held_out(F.col("doc_id")))
    counts = known.groupBy("lang").count().collect()
    labels = sorted(r["lang"] for r in counts)
    if not labels:
        return Network.fresh([UNKNOWN], 1)
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    wanted = min(documents_per_label, max(16, documents // len(labels)))
    bound = {r["lang"]: int(min(1.0, wanted / r["count"]) * (1 << 40)) for r in counts}
    bounds = F.create_map(*[F.lit(x) for pair in sorted(bound.items()) for x in pair])
    keep = drawn < bounds[F.col("lang")]
    number = {lang: k for k, lang in enumerate(labels)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets, _ in text_blocks(batches, "text"):
            data = lowered(data)
            starts, lengths, text = stretches(data, offsets)
            total = np.bincount(text, minlength=block.num_rows)
            place = np.arange(len(text)) - np.repeat(np.cumsum(total) - total, total)
            wanted = np.minimum(stretches_per_document, total)[text]
            pick = (place * wanted // total[text]) != ((place + 1) * wanted // total[text])
            x = matrix(data, starts[pick], lengths[pick])
            tongue = np.array([number[v] for v in block.column("lang").to_pylist()])[text[pick]]
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), pa.array(lengths[pick], pa.int32()),
                                              pa.array(tongue, pa.int32())], ["bytes", "length", "label"])

    rows = known.where(keep).select("text", "lang").mapInArrow(run, "bytes binary, length int, label int").toArrow()
    x = np.frombuffer(b"".join(rows.column("bytes").to_pylist()), np.uint8).reshape(-1, STEPS)
    lengths, target = (np.asarray(rows.column(c).to_numpy()).astype(np.int64) for c in ("length", "label"))
    order = np.lexsort((*x.T, lengths, target))  # the same network whatever order the rows arrive in
    network = fit(x[order], lengths[order], target[order], labels, hidden, rounds)
    give_back()
    return network


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """lang_pred and score for every row of ``docs``, with its other columns (clashing ones are replaced).

    Only ``text`` is read. The prediction is the label with the largest mean probability over all positions, the first one on a tie; ``und``
    with score 0 if the text is null or has no letter. Rows that repeat are kept.
    """
    columns = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    rows = docs.select(*columns)
    labels, weights, hidden = network.labels, network.weights, network.hidden
    taken = {c.lower() for c in columns}
    found = next(name for name in (f"found_{i}" for i in range(len(columns) + 1)) if name not in taken)
    out = rows.withColumn(found, _classifier(labels, weights, hidden)(F.coalesce(F.col("text"), F.lit(""))))
    letters = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    return out.select(*columns, F.when(letters, F.col(found)["lang_pred"]).otherwise(UNKNOWN).alias("lang_pred"),
                      F.when(letters, F.col(found)["score"]).otherwise(F.lit(0.0)).alias("score"))


def _classifier(labels: list[str], weights: dict[str, np.ndarray], hidden: int):
    @F.arrow_udf("lang_pred string, score double")
    def classify(texts: pa.Array) -> pa.Array:
        network = Network(labels, hidden, weights)
        best, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
        for _, data, offsets, _ in text_blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text"):
            p = score_block(network, data, offsets)
            best.append(p.argmax(axis=1))
            scores.append(np.minimum(1.0, p.max(axis=1)))
        give_back()
        names = pa.array(labels, pa.string()).take(pa.array(np.concatenate(best)))
        return pa.StructArray.from_arrays([names, pa.array(np.concatenate(scores), pa.float64())], ["lang_pred", "score"])

    return classify

"""Token counts of fields and sections: a document is encoded once, its tokens are joined to character spans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import flat, mapped, text_blocks
from strata.llm.tokens import byte_lengths, default_tokenizer, encode

SCHEMA = ("doc_id bigint, section int, field string, start_char bigint, n_chars bigint, n_tokens bigint, n_crossing bigint, "
          "token_share double")
RULES = ("first", "last", "largest")


def char_spans(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points [first, last + 1) that tokens of the given byte sizes touch, in order, in one text.

    A token that holds a part of a code point touches all of it, as tokenizers' own offsets say.
    """
    begun = np.cumsum((data & 0xC0) != 0x80)
    ends = np.cumsum(sizes)
    return begun[ends - sizes] - 1, begun[ends - 1]


def join_spans(first: np.ndarray, last: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, ...]:
    """Join token spans [first, last) to disjoint, sorted sections [starts, ends) that tile the text.

    Every token meets a run of neighbouring sections (found by binary search). It counts once, in one of them:
    ``first``: where its first character is; ``last``: where its last character is; ``largest``: where most
    of its characters are, the earlier one on a tie. The share of a section is its part of the token's
    characters, whatever the rule. Returns per section: tokens, crossing tokens among them, shares.
    """
    n = len(starts)
    low = np.searchsorted(ends, first, "right")
    high = np.searchsorted(starts, last, "left") - 1
    met = high - low + 1
    token = np.repeat(np.arange(len(first)), met)
    section = flat(low, met)
    overlap = np.minimum(last[token], ends[section]) - np.maximum(first[token], starts[section])
    shares = np.bincount(section, overlap / (last - first)[token], n)
    if rule == "first":
        owner = low
    elif rule == "last":
        owner = high
    else:
        order = np.lexsort((section, -overlap, token))
        owner = section[order[np.searchsorted(token[order], np.arange(len(first)))]] if len(first) else low
    return np.bincount(owner, minlength=n), np.bincount(owner[met > 1], minlength=n), shares


def attribute_tokens(docs: DataFrame, fields: Sequence[str] = ("source", "lang", "text"), lines: Sequence[str] = ("text",),
                     rule: str = "first", tokenizer: str | None = None) -> DataFrame:
    """Tokens of every field, and of every line of the fields in ``lines``, of whole documents.

    A document is its ``fields`` in order, each followed by a line break; it is encoded once. Sections tile it: a
    field that is not in ``lines`` is one section, another one has a section per line; a section ends with its
    line break. Tokens are assigned by ``rule`` (see :func:`join_spans`), so the counts of a document add up to
    its token count; ``token_share`` adds up to the same number, dealt out by characters.

    Returns per section: doc_id, section (from 0), field, start_char, n_chars, n_tokens, n_crossing, token_share.
    A null field counts as empty (its section is the line break alone), rows that repeat are counted once
    each, a null doc_id stays null, an empty table gives no rows, other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    path = tokenizer or default_tokenizer()
    names = list(fields)
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in names]
    whole = F.concat(*[x for p in parts for x in (p, F.lit("\n"))])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole.alias("whole"),
                       F.array(*[F.octet_length(p) for p in parts]).alias("sizes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets, _ in text_blocks(batches, "whole"):
            ids, bounds = encode(path, data, offsets)
            widths = byte_lengths(path)[ids]
            sizes = np.asarray(block.column("sizes").flatten()).reshape(-1, len(names))
            found: list[list[np.ndarray]] = [[] for _ in range(7)]
            counts = []
            for i in range(block.num_rows):
                own = data[offsets[i]:offsets[i + 1]]
                field_ends = np.cumsum(sizes[i] + 1)
                breaks = np.flatnonzero(own == 0x0A) + 1
                field = np.searchsorted(field_ends, breaks - 1, "right")
                split = np.isin(field, [k for k, f in enumerate(names) if f in lines])
                ends = breaks[split | np.isin(breaks, field_ends)]
                field = np.searchsorted(field_ends, ends - 1, "right")
                begun = np.cumsum((own & 0xC0) != 0x80)
                stops = begun[ends - 1]
                starts = np.concatenate(([0], stops[:-1]))
                first, last = char_spans(own, widths[bounds[i]:bounds[i + 1]])
                n, crossing, shares = join_spans(first, last, starts, stops, rule)
                counts.append(len(ends))
                for column, value in zip(found, (np.arange(len(ends)), field, starts, stops - starts, n, crossing, shares), strict=True):
                    column.append(value)
            section, field, start, chars, n, crossing, shares = [np.concatenate(c) for c in found]
            doc = block.column("doc_id").take(pa.array(np.repeat(np.arange(block.num_rows), counts)))
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(section, pa.int32()), pa.array(names).take(pa.array(field)), pa.array(start, pa.int64()),
                 pa.array(chars, pa.int64()), pa.array(n, pa.int64()), pa.array(crossing, pa.int64()), pa.array(shares, pa.float64())],
                ["doc_id", "section", "field", "start_char", "n_chars", "n_tokens", "n_crossing", "token_share"])

    return mapped(rows, run, SCHEMA)

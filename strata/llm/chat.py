"""Chat formatting through a black-box template, read incrementally: prefix after prefix of a conversation."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
Render = Callable[[Turns], str]
FORMATTED = ("conv_id bigint, n_turns bigint, formatted string, spans array<struct<role:string,start:bigint,end:bigint,"
             "text_start:bigint,text_end:bigint>>, rewrites_history boolean")

_CONTROL = re.compile(r"[\\#<]")
_IN_ROLE = re.compile(r"[\\#<:]")
_ESCAPED = re.compile(r"\\([\\#<:])")


def escape(text: str, control: re.Pattern[str] = _CONTROL) -> str:
    """Put a backslash before every backslash and every character that a control string begins with."""
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def marked_turns(turns: Turns) -> str:
    """The template of this library: a turn is ``### role: text</turn>`` and a line break, role and text escaped."""
    return "".join(f"### {escape(role, _IN_ROLE)}: {escape(text)}</turn>\n" for role, text in turns)


_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.)*+)</turn>\n", re.DOTALL)


def read_back(formatted: str) -> Turns:
    """The turns that :func:`marked_turns` wrote. Raises if the text is not its output."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def _same_from_left(a: str, b: str) -> int:
    most, at, step = min(len(a), len(b)), 0, 1 << 14
    while step:
        while at + step <= most and a[at:at + step] == b[at:at + step]:
            at += step
        step >>= 1
    return at


def _same_from_right(a: str, b: str) -> int:
    most, at, step = min(len(a), len(b)), 0, 1 << 14
    while step:
        while at + step <= most and a[len(a) - at - step:len(a) - at] == b[len(b) - at - step:len(b) - at]:
            at += step
        step >>= 1
    return at


def trace(render: Render, turns: Turns) -> tuple[str, list[tuple[int, int, int, int]], bool]:
    """Render ever longer prefixes and compare consecutive outputs.

    Returns the output for all turns, per turn (start, end, text_start, text_end) in code points of it, and whether
    the template rewrote history. The span of turn k is what the output for k turns adds to that for k - 1. A
    template that closes its output (an end mark that the next turn pushes away) still has spans: turn k begins
    where the two outputs part, or where the closing part, which all outputs end with, begins. A template that changes earlier
    characters is reported. The text's place in its turn is where two renderings with probe texts part, from the left and from the right.
    """
    before = render([])
    starts: list[int] = []
    ends: list[int] = []
    inner: list[tuple[int, int]] = []
    rewrites = False
    for k in range(len(turns)):
        now = render(turns[:k + 1])
        same = len(before) if now.startswith(before) else _same_from_left(before, now)
        closing = 0
        if same < len(before):  # allowed only if what went is a closing part that the new output ends with, too
            closing = len(before) - same
            if not now.endswith(before[same:]) or (starts and same < inner[-1][1]):
                rewrites = True
        role = turns[k][0]
        one, two = render([*turns[:k], (role, "a")]), render([*turns[:k], (role, "b")])
        head = _same_from_left(one, two)
        tail = _same_from_right(one, two)
        if ends:
            ends[-1] = min(ends[-1], same)
        starts.append(same)
        ends.append(len(now) - (closing if not rewrites else 0))
        inner.append((head, len(now) - tail))
        before = now
    if ends:
        ends[-1] = len(before)
    return before, [(s, e, a, b) for s, e, (a, b) in zip(starts, ends, inner, strict=True)], rewrites


def format_conversations(rows: DataFrame, render: Render = marked_turns) -> DataFrame:
    """Format conversations given by turn (conv_id, turn, role, text) with any template.

    Turns are ordered by turn, then role and text (nulls first), so repeated turn numbers have one order. A null
    role or text is empty; rows without conv_id are one conversation; rows that repeat are turns each; an
    empty table gives no rows; other columns are ignored. One row holds one conversation, which is the unit that a template renders.

    Returns conv_id, n_turns, formatted, spans (per turn: its span and that of its text, in code points), rewrites_history.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                                                 F.coalesce(F.col("text"), F.lit("")).alias("text"))))
    grouped = rows.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(turns.alias("turns"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for conv, own in zip(batch["conv_id"], batch["turns"], strict=True):
                said = [(t["role"], t["text"]) for t in own]
                text, spans, rewrites = trace(render, said)
                places = [dict(zip(("role", "start", "end", "text_start", "text_end"), (r, *s), strict=True))
                          for (r, _), s in zip(said, spans, strict=True)]
                yield pd.DataFrame({"conv_id": pd.array([None if pd.isna(conv) else int(conv)], "Int64"), "n_turns": [len(said)],
                                    "formatted": [text], "spans": [places], "rewrites_history": [rewrites]})

    return grouped.mapInPandas(run, FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """Per formatted conversation, read back from the output: digests of the turns and of the text under the loss mask."""

    @F.pandas_udf("turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    def digest(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, places in zip(texts, spans, strict=True):
            turns = read_back(text)
            whole = "".join(f"{role}\n{said}\n" for role, said in turns)
            loss = "".join(unescape(text[p["text_start"]:p["text_end"]]) for p in places if p["role"] == "assistant")
            out.append((hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        return pd.DataFrame(out, columns=["turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "n_turns", digest("formatted", "spans").alias("d"), "rewrites_history").select(
        "conv_id", "n_turns", "d.turns_sha256", "d.loss_chars", "d.loss_sha256", "d.formatted_chars", "rewrites_history")

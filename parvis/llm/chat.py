"""Chat formatting with a template taken as a black box.

A template is any function from a list of ``(role, text)`` to one string. The text of a
conversation is rendered turn by turn, as ever longer prefixes; what a prefix adds to the one
before it is the span of its last turn. If a prefix does not begin with the one before, the
template rewrites history: the conversation is marked so, and has no spans. Inside a span, the
place of the turn's text is found by rendering the turn with two other texts.

Long conversations are rendered in windows, so that their cost stays linear. A window is left
for a shorter one only where both add the same for the last turns; otherwise it goes on growing.
What the windows give is held against the whole conversation, rendered once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

WINDOW, OVERLAP = 128, 8

# The marks of the template and how their first characters are written in texts.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"),
         "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]", "[END]")
ESCAPES = {"\\": "\\\\", "[": "\\(", "<": "\\{"}
_PLAIN = {v: k for k, v in ESCAPES.items()}


def escape(text: str) -> str:
    return re.sub(r"[\\\[<]", lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\[\\({]", lambda m: _PLAIN[m[0]], text)


def marked_turns(turns: list[Turn]) -> str:
    """The template used here: marks around each turn, which no escaped text contains."""
    out = []
    for role, text in turns:
        if role in MARKS:
            before, after = MARKS[role]
        else:
            before, after = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
        out.append(before + escape(text) + after)
    return "".join(out)


_TURN = re.compile(
    r"<<SYS>>(?P<system>[^<\[]*)<</SYS>>|\[INST\](?P<user>[^<\[]*)\[/INST\]|"
    r"<s>(?P<assistant>[^<\[]*)</s>|\[ROLE\](?P<role>[^<\[]*)\[/ROLE\](?P<other>[^<\[]*)\[END\]")


def read_turns(formatted: str) -> list[Turn]:
    """The turns of a text written by :func:`marked_turns`; anything else raises an error."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        role = found.lastgroup if found.lastgroup in MARKS else unescape(found["role"])
        turns.append((role, unescape(found[found.lastgroup])))
        at = found.end()
    return turns


def _added(template: Template, turns: list[Turn], before: str) -> tuple[str, str] | None:
    """The rendering of ``turns`` and what its last turn adds; None if it does not go on ``before``."""
    now = template(turns)
    return (now, now[len(before):]) if now.startswith(before) else None


def _place(template: Template, turns: list[Turn], before: str, added: str) -> tuple[int, int]:
    """Where in ``added`` the last turn's text lies."""
    role = turns[-1][0]
    one, two = (template([*turns[:-1], (role, probe)])[len(before):] for probe in ("0", "1"))
    head = len(os.path.commonprefix([one, two]))
    tail = len(os.path.commonprefix([one[::-1], two[::-1]]))
    return head, len(added) - tail


def render(template: Template, turns: list[Turn]
           ) -> tuple[str, list[tuple[int, int, int]] | None]:
    """The formatted conversation and ``(start, text start, text end)`` of each turn.

    The spans are None if the template rewrites history.
    """
    parts, spans, at, base, before = [], [], 0, 0, template([])
    parts.append(before)
    at = len(before)
    recent: list[str] = []
    for k in range(len(turns)):
        window = turns[base:k + 1]
        step = _added(template, window, before)
        if step is None:
            return template(turns), None
        head, tail = _place(template, window, before, step[1])
        spans.append((at, at + head, at + tail))
        parts.append(step[1])
        before, at = step[0], at + len(step[1])
        recent = [*recent[1 - OVERLAP:], step[1]]
        if k + 1 - base >= WINDOW and (k + 1 - base) % WINDOW == 0:
            text, same = template(turns[k + 1 - 2 * OVERLAP:k + 1 - OVERLAP]), []
            for j in range(k + 1 - OVERLAP, k + 1):
                more = _added(template, turns[k + 1 - 2 * OVERLAP:j + 1], text)
                if more is None:
                    break
                text = more[0]
                same.append(more[1])
            if same == recent:
                base, before = k + 1 - 2 * OVERLAP, text
    text = "".join(parts)
    if base:  # the windows show only the last turns: the whole text decides
        whole = template(turns)
        if whole != text:
            return whole, None
    return text, spans


FORMATTED = ("conv_id long, formatted string, rewrites boolean, "
             "turns array<struct<role: string, start: long, text_start: long, text_end: long>>")


def format_conversations(rows: DataFrame, template: Template = marked_turns,
                         conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: its formatted text and the places of its turns (code points).

    The loss mask is the text places of the assistant's turns. Turns go by number; with equal
    numbers by role and text. A null role or text is empty. Rows without a conversation are one
    conversation without id. With a template that rewrites history ``turns`` is null.
    """
    names = ["conv_id", "formatted", "rewrites", "turns"]
    place = pa.struct([("role", pa.string()), ("start", pa.int64()), ("text_start", pa.int64()),
                       ("text_end", pa.int64())])
    kinds = [pa.int64(), pa.string(), pa.bool_(), pa.list_(place)]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (row for b in batches for row in zip(
            *(c.to_pylist() for c in b.columns), strict=True))
        out, size = [], 0
        for conv, group in groupby(flat, key=lambda r: r[0]):
            turns = [(r[1], r[2]) for r in group]
            text, spans = render(template, turns)
            places = None if spans is None else [
                {"role": t[0], "start": a, "text_start": b, "text_end": c}
                for t, (a, b, c) in zip(turns, spans, strict=True)]
            out.append((conv, text, spans is None, places))
            size += len(text)
            if size > 1 << 22:
                yield batch_of(out)
                out, size = [], 0
        yield batch_of(out)

    plain = rows.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
          for c, n in ((role_col, "role"), (text_col, "text"))])
    return (plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(run, FORMATTED))


REPORT = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of turns and of the text under the loss mask, from the formatted texts."""
    import hashlib

    def row(conv_id, text, rewrites, places):
        turns = read_turns(text)
        loss = "".join(unescape(text[p["text_start"]:p["text_end"]])
                       for p in places or [] if p["role"] == "assistant")
        said = "".join(f"{role}\n{words}\n" for role, words in turns)
        return (conv_id, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                hashlib.sha256(loss.encode()).hexdigest(), len(text))

    names = [c.split()[0] for c in REPORT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row(*r.values()) for r in batch.to_pylist()]
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return formatted.mapInArrow(run, REPORT)

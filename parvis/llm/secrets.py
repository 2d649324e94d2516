"""Secret scan: all rules in one pass of a deterministic automaton over the bytes of a text.

Non-ASCII characters count as one byte that no rule accepts, so byte offsets are code points.
The automaton looks for the shortest proof of a rule; the span is then what the rule's own
expression takes from the earliest place at or after the rule's last span. What a failed attempt has
shown is remembered, so that the work grows with the length of a text, whatever it holds.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parvis.llm.automaton import Automaton
from parvis.llm.tables import id_text


# A private key: its headers and base64 text up to the END line. Without one, its base64 words,
# the last of which may be short. Line breaks may be written as \\n.
_GAP = r"(?:\s|\\[nr])"
_HEADER = re.compile((_GAP + r"++[A-Za-z][A-Za-z0-9-]*+:").encode())
_LINE_END = re.compile(rb"\n|\\n")
_BODY = re.compile((
    r"(?:[A-Za-z0-9+/=]|" + _GAP + r")*+-----END [A-Z ]*PRIVATE KEY-----"
    r"|(?:" + _GAP + r"++[A-Za-z0-9+/]{16,}+={0,2}+(?![^\s\\]))++"
    r"(?:" + _GAP + r"++(?:[A-Za-z0-9+/]++={1,2}+"
    r"|(?<=[\nnr])[A-Za-z0-9+/]++(?=[\r\n\\]|\Z)))?+").encode())


class KeyEnds:
    """Where private keys of one text end, from the ends of their BEGIN lines in ascending order.

    A header takes the rest of its line. Where two keys begin in one line, both come to its end, so
    each line's end is looked for once and what follows it is matched once.
    """

    def __init__(self, data: bytes) -> None:
        self.data, self.line, self.known = data, (0, -1), {}

    def _line_end(self, at: int) -> int:
        if not self.line[0] <= at <= self.line[1]:
            found = _LINE_END.search(self.data, at)
            self.line = at, found.start() if found else len(self.data)
        return self.line[1]

    def __call__(self, at: int) -> int:
        begin, passed = at, []
        while at not in self.known:
            passed.append(at)
            header = _HEADER.match(self.data, at)
            if header is None:
                body = _BODY.match(self.data, at)
                self.known[at] = body.end() if body else None
                break
            at = self._line_end(header.end())
        end = self.known[at]
        self.known.update(dict.fromkeys(passed, end))
        return begin if end is None else end


@dataclass(frozen=True)
class Rule:
    """``proof`` is a beginning of every match, of ``length`` bytes if that is fixed.

    ``pattern`` gives the span; ``value`` is the group whose length must reach ``least``. Long
    counts are left to ``least``, as the automaton would need a state for each. If ``pattern`` can
    fail where the proof holds, it then fails wherever it begins within what ``run`` takes
    there. With ``ends`` a span goes from the last ``begin`` before the end of the proof to
    where ``ends(data)`` says; no other place of a proof may hold ``begin``.
    """

    kind: str
    proof: str
    pattern: str
    length: int = 0
    value: int = 0
    least: int = 0
    run: str = ""
    begin: str = ""
    ends: Callable[[bytes], Callable[[int], int]] | None = None


_ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
           r"""([A-Za-z0-9+/_.=-]+))""")

# The first three rules are given, the others follow public key formats.
RULES = (
    Rule("assign", _ASSIGN, _ASSIGN, value=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]", r"AKIA[A-Z0-9]+", length=5, least=20),
    Rule("hex", r"[0-9a-f]{10}", r"[0-9a-f]+", length=10, least=24),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]", r"gh[opsu]_[A-Za-z0-9]+", length=5, least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9]", r"xox[abprs]-[A-Za-z0-9-]+", length=6, least=24),
    Rule("google", r"AIza[A-Za-z0-9_-]", r"AIza[A-Za-z0-9_-]+", length=5, least=39),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]", r"[rs]k_live_[A-Za-z0-9]+", length=9, least=24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]",
         r"eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", length=4, least=32,
         run=r"[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
         begin="-----BEGIN ", ends=KeyEnds),
)
BASE_KINDS = ("assign", "access", "hex")


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules

    def __reduce__(self):
        return Scanner, (self.rules,)

    @cached_property
    def automaton(self) -> Automaton:
        return Automaton([r.proof.encode() for r in self.rules])

    @cached_property
    def patterns(self) -> list[re.Pattern]:
        return [re.compile(r.pattern.encode()) for r in self.rules]

    @cached_property
    def runs(self) -> list[re.Pattern]:
        return [re.compile(r.run.encode()) for r in self.rules]

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """``(start, rule, end)`` of all secrets, by start and then by rule."""
        data = (text or "").encode("ascii", "replace")
        out, behind, failed = [], [0] * len(self.rules), [0] * len(self.rules)
        ends = {r: rule.ends(data) for r, rule in enumerate(self.rules) if rule.ends}
        for end, hit in self.automaton.scan(data):
            for r in hit:
                if end <= behind[r]:
                    continue
                rule, pattern = self.rules[r], self.patterns[r]
                if r in ends:
                    start = data.rfind(rule.begin.encode(), behind[r], end)
                    if start >= 0:
                        behind[r] = ends[r](end)
                        if behind[r] - start >= rule.least:
                            out.append((start, r, behind[r]))
                    continue
                if rule.length:
                    start = end - rule.length
                    if start < max(behind[r], failed[r]):
                        continue
                    found = pattern.match(data, start)
                    if found is None:
                        failed[r] = self.runs[r].match(data, start).end()
                        continue
                else:
                    found = pattern.search(data, behind[r])
                    if found is None:  # nowhere to the end of the text
                        behind[r] = len(data)
                        continue
                behind[r] = found.end()
                if found.end(rule.value) - found.start(rule.value) >= rule.least:
                    out.append((found.start(), r, found.end()))
        return sorted(out)


SPANS = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)`` for every row: kind, start and end (code points, end exclusive).

    Spans of a kind don't overlap, those of different kinds may; they are ordered by start, then
    as the rules are listed. A null text is empty and has no spans; a null id stays null.
    """
    scanner = Scanner(rules)
    out = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[(scanner.rules[r].kind, a, b) for a, r, b in scanner.spans(t.as_py())]
                     for t in batch.column(1)]
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, out)], names=["doc_id", "spans"])

    return id_text(docs, id_col, text_col).mapInArrow(run, SPANS)


def secret_report(found: DataFrame) -> DataFrame:
    """Counts and a digest of the base kinds, and all spans as text, from :func:`find_secrets`."""
    def written(spans):
        return F.array_join(F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def without_secrets(docs: DataFrame, mark: str = "<secret>", text_col: str = "text",
                    rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; all other columns and rows stay.

    Overlapping spans are replaced together. A null text stays null. A column ``n_chars`` is
    counted anew where it and the text are not null.
    """
    scanner = Scanner(rules)
    at = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        spans = scanner.spans(text)
        if not spans:
            return text
        parts, behind = [], 0
        for start, _, end in spans:
            if start >= behind:
                parts += [text[behind:start], mark]
            behind = max(behind, end)
        return "".join([*parts, text[behind:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at)
            fresh = pa.array([clean(t.as_py()) for t in text], text.type)
            columns = [fresh if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        fresh = F.length(text_col).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(
            F.col("n_chars").isNotNull(), F.coalesce(fresh, "n_chars")))
    return out

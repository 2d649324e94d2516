"""Repair of conversations by a weighted parse over intervals of their rows.

The roles of a sound conversation read ``(s?(ua)+)?`` by their first letters: perhaps a system
row, then user and assistant by turns. Between the places of that pattern (nothing yet, after
the system row, after a user, after an assistant) each interval of rows has one symbol for every
pair of places, ``N_pq``: what takes the pattern from p to q. The grammar is in Chomsky normal form:
``N_pq -> N_pr N_rq`` for neighbouring intervals, and a terminal rule for each edit of one row, which
keeps it, gives it another role, or deletes it. Inserted rows belong to no row; their cheapest
runs from p to q, the closure, go around every terminal. A cell holds the least (cost, audit) of its
symbol; audits of one cost and one interval are never beginnings of each other, so the least
ones of two intervals, joined, are least again, and one split of an interval is as good as any.
Cells are therefore combined bottom-up over intervals of 1, 2, 4, 8 ... rows, and
the segments of one conversation are combined in the same way, wherever they were parsed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parvis.staging import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANK = " \t\n\v\f\r"
SEGMENT_ROWS, SEGMENT_CHARS = 512, 1 << 20

Cost = tuple[int, str]
Cell = tuple[Cost | None, ...]  # of N_00, N_01, ... N_33

# Places of the pattern: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
PLACES, ENDS = 4, (0, 3)
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_NOTHING: Cell = tuple((0, "") if p == q else None for p in range(PLACES) for q in range(PLACES))


def _least(a: Cost | None, b: Cost | None) -> Cost | None:
    return b if a is None else a if b is None else min(a, b)


def join_cells(left: Cell, right: Cell) -> Cell:
    """The cell of an interval from those of its two parts."""
    out: list[Cost | None] = []
    for p in range(PLACES):
        for q in range(PLACES):
            best = None
            for r in range(PLACES):
                a, b = left[p * PLACES + r], right[r * PLACES + q]
                if a is not None and b is not None:
                    best = _least(best, (a[0] + b[0], a[1] + b[1]))
            out.append(best)
    return tuple(out)


def _closure() -> Cell:
    """The cheapest inserted rows between any two places."""
    one = list(_NOTHING)
    for role in "ua":
        for p, q in STEPS[role].items():
            one[p * PLACES + q] = _least(one[p * PLACES + q], (INSERT, "I"))
    cell = tuple(one)
    for _ in range(PLACES):
        cell = join_cells(cell, cell)
    return cell


CLOSURE = _closure()


@lru_cache(maxsize=1 << 12)
def row_cell(initial: str, fault: str, times: int = 1) -> Cell:
    """The cell of one row, or of ``times`` rows that must all be deleted."""
    cell: list[Cost | None] = [None] * PLACES ** 2
    more = TRUNCATED if fault == "truncated" else 0
    for p in range(PLACES):
        cell[p * PLACES + p] = (DELETE * times, "D" * times)
    if fault not in ("blank", "duplicate"):
        for role, cost, letter in ((initial, KEEP, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")):
            for p, q in STEPS.get(role, {}).items():
                cell[p * PLACES + q] = _least(cell[p * PLACES + q], (cost + more, letter))
    return join_cells(join_cells(CLOSURE, tuple(cell)), CLOSURE)


_few = lru_cache(maxsize=1 << 14)(join_cells)


def parse(cells: list[Cell]) -> Cell:
    """The cell of a whole run of rows, from ever longer intervals."""
    width = 1
    while len(cells) > 1:
        pair = _few if width <= 4 else join_cells
        cells = [pair(*cells[k:k + 2]) if k + 1 < len(cells) else cells[k]
                 for k in range(0, len(cells), 2)]
        width *= 2
    return cells[0] if cells else CLOSURE


def apply_audit(audit: str, rows: list[tuple[str, str]], place: int) -> tuple[list[tuple], int]:
    """``(role, text, edit)`` of the repaired rows, from ``place`` on, and the place behind them."""
    out, k = [], 0
    for edit in audit:
        if edit == "D":
            k += 1
            continue
        if edit == "K":
            role, text = rows[k]
            place = STEPS[role[:1]][place]
        else:
            role = "assistant" if place == 2 else "user"
            text = rows[k][1] if edit == "R" else ""
            place = STEPS[role[0]][place]
        k += edit != "I"
        out.append((role, text, edit))
    return out, place


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults made from a checksum of conversation and turn; nulls are a space.

    ``crc32("conv_id:turn") % 20`` drops a row (0), empties its text (1), takes the marks ``.!?``
    out of it (2), doubles it (3) or makes it the user's (4).
    """
    filled = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" "))
                             for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    return filled.withColumn("_kind", kind).where("_kind != 0").select(
        "conv_id", "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(
            F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"),
        F.when(F.col("_kind") == 3, 2).otherwise(1).alias("copies"))


def _said() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"),
                          256))


SEGMENTS = ("conv_id long, segment long, whole boolean, rows array<struct<role: string, "
            "text: string, fault: string, times: long>>, cell array<struct<cost: long, "
            "audit: string>>, cost long, audit string, blank long, duplicate long, "
            "truncated long, illegal long, turns long, first_turn long, last_turn long, "
            "first_initial string, last_initial string")
_ROW = pa.struct([("role", pa.string()), ("text", pa.string()), ("fault", pa.string()),
                  ("times", pa.int64())])
_CELL = pa.struct([("cost", pa.int64()), ("audit", pa.string())])
_SEGMENT = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("whole", pa.bool_()),
    ("rows", pa.list_(_ROW)), ("cell", pa.list_(_CELL)), ("cost", pa.int64()),
    ("audit", pa.string()), *[(n, pa.int64()) for n in (
        "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")],
    ("first_initial", pa.string()), ("last_initial", pa.string())])
LEGAL = {"su", "ua", "au"}


class _Segment:
    """Neighbouring rows of one conversation, met in order."""

    def __init__(self, conv_id: int | None, opens: bool) -> None:
        self.conv_id, self.opens = conv_id, opens  # whether no row of it was met before
        self.rows: list[dict] = []
        self.cells: list[Cell] = []
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.chars = self.illegal = self.turns = 0
        self.initials: list[str] = []
        self.first_turn: int | None = None
        self.last: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, fault: str, times: int) -> None:
        initial = role[:1]
        if self.last == (turn, role, text):  # again the same row, collapsed elsewhere
            fault = "blank" if fault == "blank" else "duplicate"
        if turn is not None and (self.last is None or turn != self.last[0]):
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
        if self.initials:
            self.illegal += self.initials[-1] + initial not in LEGAL
        self.illegal += (times - 1) * (initial + initial not in LEGAL)
        self.initials = [*self.initials[:1], initial]
        self.last = (turn, role, text)
        # Of equal rows all but the first are duplicates; blank rows are blank, duplicates too.
        parts = [(fault, times)] if fault in ("blank", "duplicate") or times == 1 else \
            [(fault, 1), ("duplicate", times - 1)]
        for kind, n in parts:
            if kind in self.count:
                self.count[kind] += n
            said = "" if kind in ("blank", "duplicate") else text
            self.rows.append({"role": role, "text": said, "fault": kind, "times": n})
            self.chars += len(said) + n
            self.cells.append(row_cell(initial, kind, n))

    def row(self, number: int, closes: bool) -> dict:
        cell, whole = parse(self.cells), self.opens and closes
        cost, audit = min(cell[e] for e in ENDS if cell[e] is not None)
        kept = [None if c is None else {"cost": c[0], "audit": c[1]} for c in cell]
        return {"conv_id": self.conv_id, "segment": number, "whole": whole, "rows": self.rows,
                "cell": None if whole else kept, "cost": cost if whole else None,
                "audit": audit if whole else None, **self.count, "illegal": self.illegal,
                "turns": self.turns, "first_turn": self.first_turn, "last_turn": self.last[0],
                "first_initial": self.initials[0], "last_initial": self.initials[-1]}


def _parse_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of sorted rows; their numbers go up within and between partitions.

    A segment is whole if it holds all of its conversation for certain: there are rows of other
    conversations before and behind it. It is decided at once; the others keep their cells.
    """
    number, after = TaskContext.get().partitionId() << 32, False
    now, ready, chars = None, [], 0
    for batch in batches:
        for conv, turn, role, text, fault, times in zip(
                *(batch.column(n).to_pylist() for n in (
                    "conv_id", "turn", "role", "text", "fault", "times")), strict=True):
            other = now is not None and conv != now.conv_id
            full = now is not None and (len(now.rows) >= SEGMENT_ROWS or now.chars >= SEGMENT_CHARS)
            if other or full and now.last != (turn, role, text):
                ready.append(now.row(number, other))
                number, after, chars = number + 1, True, chars + now.chars
                now = _Segment(conv, other)
                if chars >= SEGMENT_CHARS or len(ready) >= 4096:
                    yield pa.RecordBatch.from_pylist(ready, schema=_SEGMENT)
                    ready, chars = [], 0
            if now is None:
                now = _Segment(conv, after)
            now.add(turn, role, text, fault, times)
    if now is not None:
        ready.append(now.row(number, False))
    yield pa.RecordBatch.from_pylist(ready, schema=_SEGMENT)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch as one with their number."""
    for batch in batches:
        keys = ["conv_id", "turn", "role", "text", "said"]
        few = pa.Table.from_batches([batch]).group_by(keys).aggregate([("times", "sum")])
        yield from few.rename_columns([*keys, "times"]).to_batches()


def parse_segments(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Conversations in segments of bounded size, each with its repair or with its parsed cell.

    Equal rows are one row with a number before anything is dealt, and the rows are dealt in
    ranges of (conversation, turn, ...), so a conversation of any length is spread over as many
    tasks as its rows fill. Rows said again later are found by a digest of role and text.
    """
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.coalesce(copies.cast("long"), F.lit(1)).alias("times")).withColumn("said", _said())
    # A null turn comes first.
    again = plain.groupBy("conv_id", "said").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("set"), "turn")).alias("first"),
        F.count(F.lit(1)).alias("n")).where("n > 1")
    again = stage(again.select(
        F.col("conv_id").alias("_conv"), F.col("said").alias("_said"),
        F.col("first.set").alias("_set"), F.col("first.turn").alias("_turn")), "repair-again")
    few = plain.select("conv_id", "turn", "role", "text", "said", "times").mapInArrow(
        _collapse, "conv_id long, turn long, role string, text string, said binary, times long")
    marked = few.join(again, F.expr("conv_id <=> _conv and said = _said"), "left")
    stripped = F.rtrim("text", F.lit(BLANK))
    fault = (F.when(stripped == "", "blank")
             .when(F.expr("_set is not null and not (turn <=> _turn)"), "duplicate")
             .when(~F.right(stripped, F.lit(1)).isin(".", "!", "?"), "truncated")
             .otherwise("none"))
    width = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (marked.select("conv_id", "turn", "role", "text", fault.alias("fault"), "times")
            .repartitionByRange(width, "conv_id", "turn", "role", F.left("text", F.lit(64)))
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_parse_segments, SEGMENTS))


CHOICES = ("conv_id long, segment long, entry int, audit string, cost long, illegal long, "
           "turns long")
_CHOICE = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("entry", pa.int32()),
                     ("audit", pa.string()), *[(n, pa.int64()) for n in (
                         "cost", "illegal", "turns")]])


def _choose_one(held: list[dict]) -> list[dict]:
    """For each segment of one conversation how its cheapest repair passes through it."""
    # Best (cost, audit) up to each place, and from which place of the segment before it.
    best: list[Cost | None] = [(0, "")] + [None] * (PLACES - 1)
    back: list[list[int]] = []
    for s in held:
        now: list[tuple | None] = [None] * PLACES
        for p in range(PLACES):
            for q in range(PLACES):
                c = s["cell"][p * PLACES + q]
                if best[p] is not None and c is not None:
                    step = (best[p][0] + c["cost"], best[p][1] + c["audit"], p)
                    now[q] = step if now[q] is None else min(now[q], step)
        best = [None if x is None else x[:2] for x in now]
        back.append([-1 if x is None else x[2] for x in now])
    place = min((e for e in ENDS if best[e] is not None), key=lambda e: best[e])
    out = []
    for k in range(len(held) - 1, -1, -1):
        s, entry = held[k], back[k][place]
        cell = s["cell"][entry * PLACES + place]
        illegal, turns = s["illegal"], s["turns"]
        if k:
            before = held[k - 1]
            illegal += before["last_initial"] + s["first_initial"] not in LEGAL
            turns -= s["first_turn"] is not None and before["last_turn"] == s["first_turn"]
        out.append({"conv_id": s["conv_id"], "segment": s["segment"], "entry": entry,
                    "audit": cell["audit"], "cost": cell["cost"], "illegal": illegal,
                    "turns": turns})
        place = entry
    return out


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for batch in batches:
        ready: list[dict] = []
        for s in batch.to_pylist():
            if held and s["conv_id"] != held[-1]["conv_id"]:
                ready += _choose_one(held)
                held = []
            held.append(s)
        yield pa.RecordBatch.from_pylist(ready, schema=_CHOICE)
    if held:
        yield pa.RecordBatch.from_pylist(_choose_one(held), schema=_CHOICE)


class Repair:
    """Parsed conversations: their counts, and their repaired rows."""

    def __init__(self, segments: DataFrame) -> None:
        self.whole = segments.where("whole").withColumn("entry", F.lit(0))
        parts = segments.where("not whole")
        ends = parts.select("conv_id", "segment", "cell", "illegal", "turns", "first_initial",
                            "last_initial", "first_turn", "last_turn")
        choices = stage(ends.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
                        .mapInArrow(_choose, CHOICES), "repair-choices")
        chosen = choices.select(F.col("segment").alias("_segment"), "entry", "cost", "audit",
                                "illegal", "turns")
        self.parts = parts.drop("cost", "audit", "illegal", "turns").join(
            chosen, F.expr("segment = _segment"))

    def rows(self) -> DataFrame:
        """``(conv_id, segment, position, role, text, edit)``: the repaired rows in their order.

        ``edit`` is K for a kept row, R for one with a new role, I for an inserted one.
        """
        columns = ["conv_id", "segment", "entry", "audit", "rows"]
        return self.whole.select(columns).unionByName(self.parts.select(columns)).mapInArrow(
            _repaired, REPAIRED)

    def report(self) -> DataFrame:
        """One row per conversation: gaps, faults, illegal pairs, cost and audit of the repair."""
        counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
        together = self.parts.groupBy("conv_id").agg(
            F.max("last_turn").alias("last_turn"), F.min("first_turn").alias("first_turn"),
            *[F.sum(c).alias(c) for c in ("turns", *counts)],
            F.array_join(F.array_sort(F.collect_list(F.struct("segment", "audit")))["audit"], "")
            .alias("audit"))
        gaps = F.coalesce(F.expr("last_turn - first_turn + 1 - turns"), F.lit(0)).alias("gaps")
        return self.whole.select("conv_id", gaps, *counts, "audit").unionByName(
            together.select("conv_id", gaps, *counts, "audit"))

    def text_digests(self) -> DataFrame:
        """``(conv_id, repaired_sha256)`` of the repaired rows, ``role:text`` on lines of their own.

        Conversations of several segments are digested in the order of their rows, which pass by
        one after the other and are not held. One without repaired rows may have no digest.
        """
        schema = "conv_id long, repaired_sha256 string"
        columns = ["conv_id", "segment", "entry", "audit", "rows"]
        long = self.parts.select(columns).mapInArrow(_repaired, REPAIRED).repartition(
            "conv_id").sortWithinPartitions("conv_id", "segment", "position")
        return self.whole.select(columns).mapInArrow(
            lambda batches: _digests(_repaired(batches)), schema).unionByName(
            long.mapInArrow(_digests, schema))


REPAIRED = ("conv_id long, segment long, position long, role string, text string, edit string")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("position", pa.int64()),
                        ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            out = []
            for s in batch.slice(at, 64).to_pylist():
                flat = [(r["role"], r["text"]) for r in s["rows"] for _ in range(r["times"])]
                kept, _ = apply_audit(s["audit"], flat, s["entry"])
                out += [{"conv_id": s["conv_id"], "segment": s["segment"], "position": k,
                         "role": role, "text": text, "edit": edit}
                        for k, (role, text, edit) in enumerate(kept)]
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose rows come one after the other."""
    names = ["conv_id", "repaired_sha256"]
    conv, digest = None, None
    for batch in batches:
        out: tuple[list, list] = ([], [])
        for c, role, text in zip(*(batch.column(n).to_pylist() for n in (
                "conv_id", "role", "text")), strict=True):
            if digest is not None and c != conv:
                out[0].append(conv)
                out[1].append(digest.hexdigest())
                digest = None
            if digest is None:
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string())], names=names)
    if digest is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], names=names)


def repair_conversations(rows: DataFrame, partitions: int | None = None) -> Repair:
    """Parse ``rows`` (conv_id, turn, role, text and perhaps copies) and choose the repair.

    Rows go by turn, null turns first, then by role and text. Rows
    that are blank, or whose role and text their conversation has said before, are deleted at a cost
    of 4; others may be kept, deleted (4) or made the user's or the assistant's (3); one that ends
    without ``.!?`` costs 3 more unless it is deleted; rows without text may be inserted (3). A null
    role or text is one space; rows without conversation are one conversation. Other columns
    are left out. An empty table gives no conversation.
    """
    return Repair(stage(parse_segments(rows, partitions), "repair-segments"))


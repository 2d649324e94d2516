"""Repair of conversations against all edits tried row by row in plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from odd_rows import SF
from parvis.llm import queries, repair

STEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
ROWS = "conv_id long, turn long, role string, text string"


def audit_of(rows):
    """The least (cost, audit) of ``(initial, fault)`` rows, by dynamic programming over rows."""
    def inserted(best):
        best = dict(best)
        for _ in range(4):
            for p, (cost, audit) in list(best.items()):
                for role in "ua":
                    q = STEP.get((role, p))
                    if q is not None:
                        best[q] = min(best.get(q, (10 ** 9, "")), (cost + 3, audit + "I"))
        return best

    best = inserted({0: (0, "")})
    for initial, fault in rows:
        now = {}
        for p, (cost, audit) in best.items():
            edits = [(p, 4, "D")]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                edits += [(STEP.get((r, p)), c + more, x) for r, c, x in (
                    (initial, 0, "K"), ("u", 3, "R"), ("a", 3, "R"))]
            for q, more, letter in edits:
                if q is not None:
                    now[q] = min(now.get(q, (10 ** 9, "")), (cost + more, audit + letter))
        best = inserted(now)
    return min(best[e] for e in (0, 3) if e in best)


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def expected(rows):
    """The contract's row of every conversation of ``rows`` after their damage."""
    convs = {r[0]: [] for r in rows}
    for c, *row in damaged(rows):
        convs[c].append(row)
    out = {}
    for c, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, kinds = set(), []
        for _, role, text in own:
            rest = text.rstrip(" \t\n\v\f\r")
            kinds.append((role[:1], "blank" if not rest else "duplicate" if (role, text) in seen
                          else "truncated" if rest[-1] not in ".!?" else "none"))
            seen.add((role, text))
        turns = {r[0] for r in own} - {None}
        cost, audit = audit_of(kinds)
        place, left, said = 0, iter(own), []
        for edit in audit:
            row = None if edit == "I" else next(left)
            if edit == "D":
                continue
            role = row[1] if edit == "K" else "assistant" if place == 2 else "user"
            place = STEP[role[:1], place]
            said.append(f"{role}:{'' if row is None else row[2]}")
        faults = [f for _, f in kinds]
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                  *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                  sum(a[0] + b[0] not in ("su", "ua", "au")
                      for a, b in itertools.pairwise(kinds)),
                  cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def answer(spark, rows, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame(rows, ROWS).selectExpr(
        "*", "1 AS segment", "2 AS fault", "3 AS times", "4 AS said", "5 AS cell").write.parquet(
        f"{path}/conversations.parquet")
    got = queries.QUERIES["op11_conversation_repair"](spark, path).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def test_cells_of_all_short_conversations():
    kinds = [(i, f) for i in "sua" for f in ("none", "truncated")] + [("t", "none"), ("u", "blank")]
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            cell = repair.parse([repair.row_cell(*r) for r in rows])
            assert min(cell[e] for e in repair.ENDS if cell[e] is not None) == audit_of(rows)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.QUERIES["op11_conversation_repair"](
        spark, SF).collect()}
    assert got == expected(rows)


@pytest.mark.parametrize("segment", [3, 512])
def test_random_conversations_in_segments_of_any_size(spark, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment)
    rng = random.Random(segment)
    texts = ["Yes.", "No!", "So", "", None, "Why?  \n", "é.", " ", "Yes."]
    roles = ["system", "user", "assistant", "tool", "unit", None, "", "User"]
    rows = [(rng.choice([None, 1, 2, 3, 4, 4, 4]), rng.choice([None, *range(30)]),
             rng.choice(roles[:3] if rng.random() < .7 else roles), rng.choice(texts))
            for _ in range(400)]
    assert answer(spark, rows, tmp_path) == expected(rows)


def test_one_conversation_over_all_partitions_with_a_crowd_of_equal_rows(spark, tmp_path):
    rows = [(7, k // 2, ("user", "assistant")[k % 2], f"Words {k % 90}.") for k in range(6000)]
    rows += [(7, 5000, "user", "Again.")] * 3000 + [(8, 1, "user", "Hi.")]
    assert answer(spark, rows, tmp_path) == expected(rows)


def test_repaired_rows_and_no_rows(spark):
    rows = spark.createDataFrame(
        [(1, 0, "assistant", "Yes."), (1, 1, "assistant", "No."), (1, 2, "user", "")], ROWS)
    got = [r[2:] for r in sorted(map(tuple, repair.repair_conversations(rows).rows().collect()))]
    cost, audit = audit_of([("a", "none"), ("a", "none"), ("u", "blank")])
    assert "".join(r[3] for r in got) == audit.replace("D", "")
    report = repair.repair_conversations(rows).report().first()
    assert (report["cost"], report["audit"]) == (cost, audit)
    assert repair.repair_conversations(rows.where("false")).report().count() == 0
    assert repair.repair_conversations(rows.where("false")).rows().count() == 0

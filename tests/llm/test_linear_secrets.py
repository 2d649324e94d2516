"""The secret scan's work grows with the text, and remembered failures change no span."""

from __future__ import annotations

import random
import re
import time

import pytest
from parvis.llm.secrets import RULES, Scanner

GAP = r"(?:\s|\\[nr])"
WHOLE = {
    "jwt": r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
    "pem": (
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
        r"(?:(?:" + GAP + r"++[A-Za-z][A-Za-z0-9-]*+:(?:(?!\\n)[^\n])*+)*+"
        r"(?:(?:[A-Za-z0-9+/=]|" + GAP + r")*+-----END [A-Z ]*PRIVATE KEY-----"
        r"|(?:" + GAP + r"++[A-Za-z0-9+/]{16,}+={0,2}+(?![^\s\\]))++"
        r"(?:" + GAP + r"++(?:[A-Za-z0-9+/]++={1,2}+"
        r"|(?<=[\nnr])[A-Za-z0-9+/]++(?=[\r\n\\]|\Z)))?+))?+"),
    "assign": (r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"""([A-Za-z0-9+/_.=-]+))"""),
    "github": r"gh[opsu]_[A-Za-z0-9]+",
}
KINDS = [r.kind for r in RULES]
PARTS = ["eyJ", "eyJa", ".", "abc", " ", "\n", "\\n", "-----BEGIN ", "RSA ", "PRIVATE KEY-----",
         "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----", "Proc-Type:", "QUJD" * 5, "==",
         "a", "-", "token=", "password", " :", "gho_", "ghp" + "a" * 40, "_", "\r\n", "é"]


def by_search(text: str, kind: str) -> list[tuple[int, int]]:
    """Leftmost spans that do not overlap, by one expression from place to place."""
    rule = RULES[KINDS.index(kind)]
    found = re.finditer(WHOLE[kind], text.encode("ascii", "replace").decode(), re.ASCII)
    return [m.span() for m in found if len(m[m.lastindex or 0]) >= rule.least]


@pytest.mark.parametrize("kind", WHOLE)
def test_same_spans_as_one_expression(kind):
    scanner, rng = Scanner(), random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choices(PARTS, k=rng.randint(1, 25)))
        spans = [(a, b) for a, r, b in scanner.spans(text) if KINDS[r] == kind]
        assert spans == by_search(text, kind), text


RUNS = {
    "jwt": "eyJ",
    "jwt with dots": "eyJa.eyJ",
    "begin lines": "-----BEGIN PRIVATE KEY-----\n",
    "headers in one line": "-----BEGIN PRIVATE KEY----- a:",
    "headers": "-----BEGIN PRIVATE KEY-----\nProc-Type: 4\n",
    "end and begin": "-----END PRIVATE KEY-----BEGIN PRIVATE KEY-----",
    "begin without key": "-----BEGIN A",
    "assign": "token",
}


@pytest.mark.parametrize("name", RUNS)
def test_time_of_a_megabyte(name):
    scanner = Scanner()
    scanner.spans("warm up")
    text = RUNS[name] * ((1 << 20) // len(RUNS[name]))
    began = time.process_time()
    scanner.spans(text)
    assert time.process_time() - began < 5


def test_value_that_holds_a_key_word():
    """The second separator's key word lies in the first value; its run proves again and again."""
    began = time.process_time()
    assert len(Scanner().spans("token=password :" + "x" * (1 << 20))) == 1
    assert time.process_time() - began < 5

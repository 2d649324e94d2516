"""One deterministic automaton over bytes for many patterns.

Patterns are turned into one nondeterministic automaton that may begin a match anywhere; subset
construction over classes of equal bytes makes it deterministic, and partition refinement
makes it minimal. The result is a flat transition array: ``next[state + class]``, with states
numbered in steps of the number of classes and accepting states last.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser

import re


class _Nfa:
    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def chars(self, code, arg, flags: int) -> frozenset[int]:
        if code is op.LITERAL:
            found = {arg}
        elif code is op.NOT_LITERAL:
            found = set(range(256)) - {arg}
        elif code is op.ANY:
            found = set(range(256)) - {10}
        elif code is op.IN:
            found, negate = set(), False
            for kind, value in arg:
                if kind is op.NEGATE:
                    negate = True
                elif kind is op.LITERAL:
                    found.add(value)
                elif kind is op.RANGE:
                    found.update(range(value[0], value[1] + 1))
                else:
                    raise ValueError(f"class {kind} is not supported")
            if negate:
                found = set(range(256)) - found
        else:
            raise ValueError(f"{code} is not supported")
        if flags & re.IGNORECASE:
            found |= {b ^ 32 for b in found if 65 <= b & 0xDF <= 90}
        return frozenset(found)

    def add(self, tree, start: int, flags: int) -> int:
        """The state where ``tree`` ends if it begins at ``start``."""
        for code, arg in tree:
            if code in (op.MAX_REPEAT, op.MIN_REPEAT):
                least, most, body = arg
                for _ in range(least):
                    start = self.add(body, start, flags)
                end = self.state()
                self.empty[start].append(end)
                if most is op.MAXREPEAT:
                    begin = self.state()
                    self.empty[start].append(begin)
                    last = self.add(body, begin, flags)
                    self.empty[last] += [begin, end]
                else:
                    for _ in range(most - least):
                        start = self.add(body, start, flags)
                        self.empty[start].append(end)
                start = end
            elif code is op.SUBPATTERN:
                start = self.add(arg[3], start, (flags | arg[1]) & ~arg[2])
            elif code is op.BRANCH:
                end = self.state()
                for branch in arg[1]:
                    begin = self.state()
                    self.empty[start].append(begin)
                    self.empty[self.add(branch, begin, flags)].append(end)
                start = end
            else:
                end = self.state()
                self.moves[start].append((self.chars(code, arg, flags), end))
                start = end
        return start

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


class Automaton:
    """``classes`` maps bytes for ``bytes.translate``; ``rules[state - accepting]`` what ends there."""

    def __init__(self, patterns: list[bytes]) -> None:
        nfa = _Nfa()
        root, ends = nfa.state(), {}
        for rule, pattern in enumerate(patterns):
            tree = _parser.parse(pattern)
            begin = nfa.state()
            nfa.empty[root].append(begin)
            ends[nfa.add(tree, begin, tree.state.flags)] = rule

        groups: dict[tuple, int] = {}
        sets = sorted({s for moves in nfa.moves for s, _ in moves}, key=sorted)
        kinds = [groups.setdefault(tuple(b in s for s in sets), len(groups)) for b in range(256)]
        sample = {k: b for b, k in enumerate(kinds)}
        width = len(groups)

        first = nfa.closure({root})
        number, todo, table = {first: 0}, [first], []
        while todo:
            now = todo.pop(0)
            row = []
            for kind in range(width):
                to = {t for s in now for on, t in nfa.moves[s] if sample[kind] in on}
                reached = nfa.closure(to | {root})
                if reached not in number:
                    number[reached] = len(number)
                    todo.append(reached)
                row.append(number[reached])
            table.append(row)
        hits = [frozenset(ends[s] for s in states if s in ends) for states in number]

        block = [sorted(set(hits), key=sorted).index(h) for h in hits]
        while True:  # states of a block lead to the same blocks, or the block is split
            seen: dict[tuple, int] = {}
            finer = [seen.setdefault((b, *(block[t] for t in row)), len(seen))
                     for b, row in zip(block, table, strict=True)]
            if len(seen) == len(set(block)):
                break
            block = finer

        order = sorted(dict.fromkeys(block), key=lambda b: bool(hits[block.index(b)]))
        place = {b: i for i, b in enumerate(order)}
        self.next: list[int] = []
        self.rules: dict[int, list[int]] = {}
        for b in order:
            state = block.index(b)
            if hits[state]:
                self.rules[place[b] * width] = sorted(hits[state])
            self.next += [place[block[t]] * width for t in table[state]]
        self.accepting = min(self.rules, default=len(self.next))
        self.start = place[block[0]] * width
        self.classes = bytes(kinds)

    def scan(self, data: bytes):
        """``(end, rules)`` wherever a match of some rule ends, in one pass over ``data``."""
        step, accepting, rules, state = self.next, self.accepting, self.rules, self.start
        for at, kind in enumerate(data.translate(self.classes), 1):
            state = step[state + kind]
            if state >= accepting:
                yield at, rules[state]

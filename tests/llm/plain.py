"""Plain Python versions of what the operators compute, for small tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict


def lower(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def letters(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingles(text: str | None, size: int) -> set[tuple[str, ...]]:
    w = words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def components(sets: dict[int, set], threshold: int) -> dict[int, int]:
    """The smallest id that links reach, by comparing all sets that share a shingle."""
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    common = Counter((a, b) for ids in holders.values() for k, a in enumerate(ids)
                     for b in ids[k + 1:])
    for (a, b), n in common.items():
        if 100 * n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: root(i) for i in sets}


def base_secrets(text: str | None) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base kinds."""
    text = text or ""
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                        r"""([A-Za-z0-9+/_.=-]+))""", re.ASCII)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
            if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def base_scores(texts: dict[int, str | None], modulus: int, remainder: int
                ) -> dict[int, tuple[bool, int, int, float]]:
    tokens = {i: [*words(t), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % modulus == remainder for i in texts}
    counts = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    whole = sum(counts.values()) + len(counts) + 1
    return {i: (held[i], len(t), sum(counts[w] > 0 for w in t),
                sum(math.log10((counts[w] + 1) / whole) for w in t)) for i, t in tokens.items()}


PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"),
           ("cc by", "cc-by"), ("mit license", "mit"))


def phrase_places(text: str | None) -> list[tuple[int, str]]:
    w, out = letters(text), []
    for phrase, label in PHRASES:
        p = phrase.split()
        out += [(k, label) for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
    return sorted(out)


def aligned(text: str | None, item: str | None, window: int = 20) -> int:
    """The most agreeing words of a window of ``item`` along any diagonal of ``text``."""
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    d, b, best = split(text), split(item), 0
    window = min(window, len(b))
    for g in range(-len(b), len(d)):
        agree = [0 <= q + g < len(d) and d[q + g] == w for q, w in enumerate(b)]
        best = max([best, *(sum(agree[s:s + window]) for s in range(len(b) - window + 1))])
    return best

"""Near-duplicates whose buckets see folded sets only."""

from __future__ import annotations

import random

import numpy as np
import pytest

import plain
from parvis.llm import minhash


@pytest.mark.parametrize("width", [1, 2, 3])
def test_folding_never_hides_an_overlap(width):
    rng = np.random.default_rng(width)
    for n in (1, 5, 300, 5000):
        one = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1))
        two = np.union1d(rng.choice(one, max(1, n // 2), replace=False),
                         rng.integers(0, 1 << 63, n // 2 + 1, dtype=np.uint64))
        a, b = (minhash.unfold(minhash.fold(s, width), width) for s in (one, two))
        assert len(a) == len(one) and len(np.unique(a)) == len(a)
        assert len(np.intersect1d(a, b)) >= len(np.intersect1d(one, two))


@pytest.mark.parametrize("width", [1, 3])
def test_edges_that_folding_invents_are_taken_back(spark, width):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(24):  # one byte a shingle shows many of these pairs as links
        words = list(base)
        for _ in range(i // 2):
            words[rng.randrange(400)] = f"x{rng.random()}"
        texts[i] = " ".join(words)
    texts[50], texts[51], texts[52] = texts[3], "", None
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"]
           for r in minhash.near_duplicates(df, 3, 96, fold_bytes=width).collect()}
    sets = {i: plain.shingles(t or "", 3) for i, t in texts.items()}
    assert got == plain.components(sets, 96)
    assert len(set(got.values())) > 3

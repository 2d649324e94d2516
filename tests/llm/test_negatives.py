"""Hard negatives against sorting all rows for each anchor."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from odd_rows import SF
from parvis.llm import negatives, queries

ROWS = "vec_id long, embedding array<double>, label int"


def expected(rows, anchor=lambda i: i % 100 == 0, low=80):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(
                x is None or not math.isfinite(x) for x in v):
            continue
        one = (str(label), v)
        kept[i] = min(kept.get(i, one), one)
    out = []
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in kept.items()}
    for a, (label, v) in whole.items():
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other)
                        for i, (other, w) in whole.items() if i != a)
        positives = [(-s, i) for s, i, other in scored if other == label][:5]
        for p, i in positives:
            near = [(-s, n) for s, n, other in scored
                    if other != label and low * p <= 100 * -s <= 100 * p][:5]
            out += [(a, i, k + 1, n, p, s) for k, (s, n) in enumerate(near)]
    return sorted(out)


def found(df, **more):
    return sorted(tuple(r) for r in negatives.hard_negatives(
        df, lambda i: i % 100 == 0, **more).collect())


def test_query_on_the_given_vectors(spark):
    rows = [(r["vec_id"], list(r["embedding"]), (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0
             else r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op13_hard_negatives"](spark, SF).collect())
    assert got == expected(rows) and got


@pytest.mark.parametrize("page", [2, 128])
def test_ties_repeats_nulls_and_one_common_vector(spark, monkeypatch, page):
    monkeypatch.setattr(negatives, "PAGE", page)
    monkeypatch.setattr(negatives, "BLOCK", 300)
    monkeypatch.setattr(negatives, "WAVE", 4)
    rng = random.Random(page)
    common = [0.5, 0.25, -0.125, 1.0]
    rows = [(k, common if k % 3 == 0 else [rng.randint(-3, 3) / 4 for _ in range(4)], k % 4)
            for k in range(1200)]
    rows += [rows[5], rows[5], (100, [1.0] * 4, 0), (None, common, 1), (2000, None, 1),
             (2001, [1.0, None, 1.0, 1.0], 1), (2002, [math.nan] * 4, 1), (2100, common, None),
             (2101, [math.inf] * 4, 2), (2102, [], 2)]
    df = spark.createDataFrame(rows, ROWS).selectExpr(
        "*", "1 AS page", "2 AS v", "3 AS score", "4 AS window")
    assert found(df.repartition(5)) == expected(rows)


def test_tiny_components_and_products_beyond_doubles(spark):
    rng = random.Random(3)
    rows = [(k, [rng.choice([-1e-20, 1e-20, 0.3, 9e5 + rng.random()]) for _ in range(3)], k % 2)
            for k in range(0, 2000, 10)]
    big = [(i, [x * 7 for x in v], label) for i, v, label in rows]
    for own in (rows, big):
        assert found(spark.createDataFrame(own, ROWS)) == expected(own)


def test_other_dimensions_and_no_rows(spark):
    rows = [(k, [float(k % 5), 1.0], k % 3) for k in range(300)]
    df = spark.createDataFrame([*rows, (300, [9.0], 1)], ROWS)
    assert found(df) == expected(rows)
    assert found(df.where("false")) == []
    assert found(df.where("vec_id = 100")) == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    values = np.floor(256 * np.concatenate([rng.normal(c, .05, size=(500, 6)) for c in range(8)]))
    ids = np.arange(len(values))
    order = list(negatives.str_order(values, ids, [0, 1, 2]))
    assert sorted(np.concatenate(order).tolist()) == ids.tolist()
    rows = np.concatenate(order)
    page = np.repeat(np.arange(len(order)), [len(r) for r in order])
    tree = negatives.Tree(ids[rows], np.array(["x"] * len(ids), object), values[rows], page)
    anchor = values[-1]
    low, high = tree.bounds(anchor[None])
    for k, (a, b) in enumerate(zip(tree.start, tree.stop, strict=True)):
        scores = tree.values[a:b] @ anchor
        assert low[0, k] <= scores.min() and scores.max() <= high[0, k]
    looked = []
    best = negatives.Anchor(-1, "x", anchor, True, [negatives.Best(5, -math.inf, math.inf)])
    plain, best.offer = best.offer, lambda *block: (looked.append(1), plain(*block))
    best.search(tree, low[0].tolist(), high[0].tolist())
    want = sorted(zip((-(values @ anchor)).tolist(), ids.tolist(), strict=True))[:5]
    assert best.windows[0].found == want and len(looked) < len(order) / 2

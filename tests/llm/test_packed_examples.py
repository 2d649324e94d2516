"""Examples packed over many batches."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from parvis.llm import packing

LIMITS = packing.Limits(tokens=1000, segments=4, loss=300)


def sequences(rows):
    out = {}
    for r in rows:
        if r["sequence_id"] is not None:
            out.setdefault(r["sequence_id"], []).append(r)
    return out


@pytest.mark.parametrize("batch", [7, 10_000])
def test_examples_of_many_batches_fill_sequences(spark, batch):
    rng = np.random.default_rng(1)
    sizes = {i: (int(t), int(min(t, x))) for i, (t, x) in enumerate(zip(
        rng.integers(0, 700, 900), rng.integers(0, 200, 900), strict=True))}
    df = spark.createDataFrame(
        [(i, t, x, "other") for i, (t, x) in sizes.items()],
        "example_id long, tokens long, loss_tokens long, sequence_id string").repartition(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = packing.pack_examples(df, LIMITS).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert Counter(r["example_id"] for r in rows) == Counter(list(sizes))
    assert {r["example_id"] for r in rows if r["sequence_id"] is None} == {
        i for i, (t, _) in sizes.items() if t == 0}
    packed = sequences(rows)
    for members in packed.values():
        members.sort(key=lambda r: r["offset"])
        lengths = [sizes[r["example_id"]] for r in members]
        assert [r["offset"] for r in members] == np.cumsum([0, *[t for t, _ in lengths]])[:-1].tolist()
        assert sum(t for t, _ in lengths) <= 1000 and sum(x for _, x in lengths) <= 300
        assert len(members) <= 4
    least = max(sum(t for t, _ in sizes.values()) / 1000, sum(x for _, x in sizes.values()) / 300)
    assert len(packed) < 1.1 * least  # whatever the batches


def test_odd_examples(spark):
    df = spark.createDataFrame(
        [(1, 400, None), (1, 400, None), (None, 400, 5), (None, None, None), (2, 0, 9)],
        "example_id long, tokens long, loss_tokens long").coalesce(1)
    rows = packing.pack_examples(df, LIMITS).collect()
    assert Counter(r["example_id"] for r in rows) == Counter([1, 1, None, None, 2])
    assert sorted(len(m) for m in sequences(rows).values()) == [1, 2]

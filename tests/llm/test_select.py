"""Runs of Elias-Fano values, document ids found by select, blocks of odd ids."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from parvis.llm import tokenfile
from parvis.llm.tokenfile import EliasFano


def stored(values) -> EliasFano:
    ef = EliasFano.of(np.array(values, np.int64))
    return EliasFano(ef.count, ef.low_bits, ef.low, ef.high, ef.samples.tobytes())


@pytest.mark.parametrize("seed", range(6))
def test_runs_and_bisection(seed):
    rng = np.random.default_rng(seed)
    values = np.sort(rng.integers(0, [5, 300, 10**4, 10**9, 1 << 61, 1][seed], 700))
    ef = stored(values)
    for a, b in [(0, 0), (0, 700), (63, 65), (64, 128), (127, 129), (699, 700), (700, 700),
                 *np.sort(rng.integers(0, 701, (40, 2)), axis=1)]:
        assert ef.between(int(a), int(b)).tolist() == values[a:b].tolist()
    for value in [0, int(values[-1]) + 1, *values[::50].tolist(), *(values[::70] + 1).tolist()]:
        assert ef.first_at_least(value) == np.searchsorted(values, value)
    assert stored([]).first_at_least(3) == 0


def test_blocks_of_odd_ids(monkeypatch):
    """Rows without an id, repeated and negative ids and wide spans, over several blocks."""
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 40)
    monkeypatch.setattr(tokenfile, "READ_TOGETHER", 3)
    monkeypatch.setattr(tokenfile.TaskContext, "get",
                        classmethod(lambda cls: SimpleNamespace(partitionId=lambda: 4)))
    ids = [*[None] * 25, *[-(1 << 63)] * 2, -7, *[0] * 30, *range(1, 90), *[90] * 20, (1 << 63) - 1]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([f"text {k}" for k in range(len(ids))])],
        names=["doc_id", "text"])
    blocks = list(tokenfile._blocks(None)(iter([batch, batch.slice(0, 0)])))
    assert len(blocks) > 9
    rows = [r for b in tokenfile._documents(iter(blocks)) for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == ids and {r["shard"] for r in rows} == {4}
    starts = np.cumsum([0, *[r["n_tokens"] for r in rows]])
    assert [r["start_in_shard"] for r in rows] == starts[:-1].tolist()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    for wish in ([-(1 << 63)], [-7, 0, 41], [90, 90 + 1], [(1 << 63) - 1], [-8, 1 << 40]):
        got = [r for b in tokenfile._chosen(wish)(iter(blocks)) for r in b.to_pylist()]
        order = lambda r: r["start_in_shard"]
        assert sorted(got, key=order) == [r for r in rows if r["doc_id"] in wish]

"""Replaced tables: whatever step fails, a reader finds the old table or the new one."""

from __future__ import annotations

from pathlib import Path

import pytest

from parvis.sources import layout, versions


def ids(spark, path):
    return sorted(r["id"] for r in layout.read_table(spark, path).collect())


@pytest.mark.parametrize("step", ["_write", "_prepare", "_publish", "_clean"])
@pytest.mark.parametrize("done", [False, True])
def test_a_writer_that_fails_at_any_step(spark, root, monkeypatch, step, done):
    path, plain = f"{root}/t", getattr(versions, step)
    layout.create_or_replace(spark.range(3), path)

    def fail(*args):
        assert ids(spark, path) in ([0, 1, 2], [0, 1])
        if done:
            plain(*args)
        raise RuntimeError(step)

    monkeypatch.setattr(versions, step, fail)
    with pytest.raises(RuntimeError):
        layout.create_or_replace(spark.range(2), path)
    committed = step == "_clean" or step == "_publish" and done
    assert ids(spark, path) == ([0, 1] if committed else [0, 1, 2])
    monkeypatch.undo()
    layout.create_or_replace(spark.range(5), path)
    assert ids(spark, path) == [0, 1, 2, 3, 4]
    left = [p.name for p in Path(path).iterdir() if p.name.startswith(versions.VERSION)]
    assert len(left) == 2


def test_a_reader_keeps_the_state_it_began_with(spark, root):
    path = f"{root}/t"
    layout.create_or_replace(spark.range(3), path)
    began = layout.read_table(spark, path)
    layout.create_or_replace(spark.range(7), path)
    assert began.count() == 3 and layout.read_table(spark, path).count() == 7


def test_a_plain_table_becomes_a_versioned_one(spark, root):
    path = f"{root}/t"
    spark.range(3).write.parquet(path)
    layout.create_or_replace(layout.read_table(spark, path).union(spark.range(1)), path)
    assert ids(spark, path) == [0, 0, 1, 2]
    assert not list(Path(path).glob("*.parquet"))


def test_of_two_writers_at_once_one_is_told(spark, root, monkeypatch):
    path, plain = f"{root}/t", versions._prepare
    layout.create_or_replace(spark.range(1), path)

    def other_first(*args):
        monkeypatch.setattr(versions, "_prepare", plain)
        layout.create_or_replace(spark.range(9), path)
        return plain(*args)

    monkeypatch.setattr(versions, "_prepare", other_first)
    with pytest.raises(OSError):
        layout.create_or_replace(spark.range(2), path)
    assert layout.read_table(spark, path).count() == 9

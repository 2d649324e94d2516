"""An id with two texts keeps the links of both."""

from __future__ import annotations

from parvis.llm import minhash


def test_a_copy_does_not_hide_another_text_of_its_id(spark):
    one = " ".join(f"a{k}" for k in range(80))
    other = [f"b{k}" for k in range(80)]
    near = " ".join([*other[:-1], "zz"])
    rows = [(3, one), (5, one), (5, " ".join(other)), (9, near)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r["doc_id"], r["component_id"]) for r in got.collect()} == {(3, 3), (5, 3), (9, 3)}

"""Fixtures of the tests in this folder."""

from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

ODD_TEXTS = [None, "", " ", "\n\t", "a", "é ü 中 😀", "x" * 5000, "one two " * 4000, "A\x00b",
             "  ", "'''", "\\[<"]


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and clashing names."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[7], rows[7], (99, ODD_TEXTS[7], None, None, None), (None, "one two", None, None, 7)]
    return spark.createDataFrame(rows, DOCUMENTS).selectExpr(
        "*", "1 AS node", "2 AS bucket", "3 AS h", "4 AS shard", "5 AS score", "6 AS key")


@pytest.fixture
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return {r["doc_id"]: r["text"] for r in df.collect()}

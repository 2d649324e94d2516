"""Chosen documents of a token file are read by select."""

from __future__ import annotations

from parvis.llm import tokenfile
from parvis.staging import new_scratch_path


def test_chosen_documents_are_read_by_select(spark, monkeypatch):
    rows = [(i, "word " * (i % 9)) for i in range(300)] + [(7, "again"), (None, "no id")]
    path = new_scratch_path(spark, "tokens")
    tokenfile.write_token_file(spark.createDataFrame(rows, "doc_id long, text string"), path)
    every = tokenfile.read_token_file(spark, path).where("doc_id in (0, 7, 150, 299)").collect()
    got = tokenfile.read_documents(spark, path, [0, 7, 150, 299, 12345]).collect()
    assert len(got) == 5 and sorted(map(tuple, got)) == sorted(map(tuple, every))
    assert tokenfile.read_documents(spark, path, []).count() == 0

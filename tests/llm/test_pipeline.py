"""The corpus pipeline stage by stage, and its registration."""

from __future__ import annotations

import __spark_entry__ as entry
import corpus_pipeline
import plain
from odd_rows import SF
from parvis.llm.queries import QUERIES


def test_queries_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) < set(names) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r["toxic"]}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    gone = set(before) - set(kept["toxicity"])
    assert len(gone - toxic) < 0.05 * len(before)
    sets = {i: plain.shingles(t, 5) for i, t in kept["toxicity"].items()}
    groups = plain.components(sets, 80)
    assert set(kept["near_duplicates"]) == {i for i in sets if groups[i] == i}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, text in kept["decontamination"].items():
        assert not any(item in text for item in items), i
    assert set(kept["secrets"]) == set(kept["decontamination"])
    assert not any(plain.base_secrets(t) for t in kept["secrets"].values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(kept["secrets"])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0

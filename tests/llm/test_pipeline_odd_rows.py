"""The pipeline's stages on rows without an id, repeated rows, odd texts and clashing names."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from odd_rows import SF, odd  # noqa: F401

STAGES = dict(corpus_pipeline.STAGES)
FROM = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = " ".join(f"w{i}" for i in range(40))
NEAR = WORDS.replace("w39", "other")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_rows_without_id_are_deduplicated(spark):
    clean = " ".join(f"v{i}" for i in range(40))
    rows = [(5, WORDS, "en", "a", 1), (None, NEAR, "en", "a", 1), (None, NEAR, "fr", "a", 1),
            (None, clean, "en", "a", 1), (None, clean, "en", "a", 1),
            (None, "", "en", "a", 0), (None, None, None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, FROM)
    kept = rows_of(STAGES["near_duplicates"](spark, docs, SF))
    assert kept == Counter([rows[0], rows[3], rows[5], rows[6]])


def test_group_without_any_id_keeps_one(spark):
    rows = [(None, t, lang, "a", 1) for t in (WORDS, NEAR) for lang in ("en", "fr")]
    kept = rows_of(STAGES["near_duplicates"](spark, spark.createDataFrame(rows, FROM), SF))
    assert sum(kept.values()) == 1 and set(kept) < set(rows)


def test_repeated_rows_of_an_id(spark):
    """Equal texts of an id leave one row, other texts of it stay."""
    clean = " ".join(f"v{i}" for i in range(40))
    rows = [(5, WORDS, "en", "a", 1)] * 50 + [(5, WORDS, "de", "a", 1), (5, clean, "en", "a", 1),
                                              (9, NEAR, "en", "a", 1), (7, "", "en", "a", 0)]
    kept = rows_of(STAGES["near_duplicates"](spark, spark.createDataFrame(rows, FROM), SF))
    assert kept == Counter([(5, WORDS, "de", "a", 1), (5, clean, "en", "a", 1), (7, "", "en", "a", 0)])


def test_rows_without_id_are_decontaminated(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").select("text").first()["text"]
    rows = [(None, f"before {item} after", "en", "a", 1), (3, item, "en", "a", 1),
            (None, "nothing of it", "en", "a", 1), (None, None, None, None, None), (4, "", "en", "a", 0)]
    kept = rows_of(STAGES["decontamination"](spark, spark.createDataFrame(rows, FROM), SF))
    assert kept == Counter(rows[2:])


def test_odd_rows_in_every_stage(spark, odd, tmp_path):  # noqa: F811
    """With columns named as those that the stages use themselves."""
    docs = odd.selectExpr("*", "'g' AS gone", "'r' AS row", "7 AS n")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        after.write.parquet(f"{tmp_path}/{name}")
        before, docs = rows_of(docs), spark.read.parquet(f"{tmp_path}/{name}")
        assert set(rows_of(docs)) <= set(before), name
    ids = Counter(r["doc_id"] for r in docs.collect())
    # The thrice repeated long text and its copy with id 99 are one row; "one two" has no id.
    assert ids == Counter([*range(len(ids) - 1), None])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == set(ids)

"""Arrow batches of the pipeline end at a number of bytes, whatever the length of the texts."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parvis.llm.tables import BATCH_BYTES

BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("own", [None, 1 << 26])
def test_long_texts_come_in_several_batches(spark, own):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["n"])

    before = spark.conf.get(BOUND, None)
    try:
        spark.conf.unset(BOUND) if own is None else spark.conf.set(BOUND, own)
        docs = spark.range(0, 300, 1, 1).select(
            F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 20_000).alias("text"))
        kept = corpus_pipeline.mask_secrets(spark, docs, "")
        longest, batches = docs.mapInArrow(sizes, "n long").agg(F.max("n"), F.count("*")).first()
        if own is None:
            assert longest < 2 * BATCH_BYTES and batches > 5
        else:
            assert batches == 1  # the session's own bound stays
        assert kept.select(F.sum("doc_id"), F.sum(F.length("text"))).first() == (44_850, 30_000_000)
    finally:
        spark.conf.unset(BOUND) if before is None else spark.conf.set(BOUND, before)

"""Toxicity of whole texts by the recurrent network of :mod:`parvis.llm.gru`."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parvis.llm.gru import Network, inputs_of, train
from parvis.llm.tables import id_text
from parvis.llm.words import LETTERS, word_slices

TRAIN_TOXIC, TRAIN_OTHER = 1500, 3000  # texts of each label that are learned from, at most


def held_out(id_column: Column, modulus: int = 5, remainder: int = 0) -> Column:
    """Rows that nothing is learned from, by the checksum of their id as text."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % modulus == remainder,
                      F.lit(False))


def train_network(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC,
                  other: int = TRAIN_OTHER, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic") -> Network:
    """Learn from a bounded sample of labelled texts that are not held out.

    Of each label the texts with the smallest hashes of their ids are taken. Null texts, labels
    and ids are left out; without any labelled text the network stays as it begins.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.col(label_col).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    order = F.xxhash64("doc_id"), F.col("doc_id")
    picked = None
    for label, most in ((1, toxic), (0, other)):
        part = marked.where(F.col("label") == label).orderBy(*order).limit(most)
        picked = part if picked is None else picked.union(part)
    chosen = {(r["doc_id"], r["label"]) for r in picked.collect()}
    if not chosen:
        return train([], np.empty(0, int))
    session = docs.sparkSession
    few = session.createDataFrame(sorted(chosen), "doc_id long, label int")
    rows = id_text(docs, id_col, text_col).where("text is not null").join(F.broadcast(few), "doc_id")
    rows = rows.orderBy("doc_id", "label", F.xxhash64("text")).limit(toxic + other).collect()
    return train([r["text"] for r in rows], np.array([r["label"] for r in rows], int))


def score_texts(docs: DataFrame, network: Network, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` for every row; texts without words, empty or null ones score 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(network, batch.column(1)), pa.float64())],
                names=["doc_id", "score"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def _scores(network: Network, texts: pa.Array) -> np.ndarray:
    parts = [network.scores(inputs_of(words), j - i) if len(words.hash) else np.zeros(j - i)
             for i, j, words in word_slices(texts, LETTERS)]
    return np.concatenate([*parts, np.empty(0)])


def without_toxic(docs: DataFrame, network: Network, limit: float = 0.5, text_col: str = "text"
                  ) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``limit``, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(network, batch.column(at)) < limit))

    return docs.mapInArrow(run, docs.schema)

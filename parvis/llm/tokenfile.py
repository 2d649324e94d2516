"""A file format for token ids: one concatenated array, document boundaries in Elias-Fano form.

The file is a Parquet table of blocks, written and read by Spark, so it may lie in any store.
A block holds consecutive documents: their ids as packed unsigned 16-bit numbers, and two
Elias-Fano sequences, the offsets of their ends and, as they ascend, the document ids less the
first one. Such a sequence has the low bits of each value packed, the high bits in unary, and the
place of every ``SAMPLE``-th one-bit, so that a value or a run of them is found without reading
the others. Shards follow the order of the document ids, blocks that of a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parvis.llm.subwords import encoder
from parvis.llm.tables import id_text

END_ID = 0
BLOCK_IDS = 1 << 20  # a block is closed beyond that; one longer document is a block of its own
SAMPLE = 64
READ_TOGETHER = 512
ID_SPAN = 1 << 62  # of the document ids of a block
BLOCKS = ("shard int, block int, ids_before long, n_ids long, n_docs int, n_without_id int, "
          "first_id long, last_id long, id_bits int, id_low binary, id_high binary, "
          "id_samples binary, low_bits int, low binary, high binary, samples binary, ids binary")
DOCUMENTS = "doc_id long, shard int, start_in_shard long, n_tokens long, ids binary"


class EliasFano:
    """A non-decreasing sequence of non-negative integers; ``select(i)`` gives the i-th."""

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, samples: bytes) -> None:
        self.count, self.low_bits = count, low_bits
        self.low, self.high, self.samples = low, high, np.frombuffer(samples, np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = (values[:, None] >> np.arange(bits)) & 1
        ones = (values >> bits) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, bits, np.packbits(low.astype(np.uint8), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(),
                   ones[::SAMPLE].astype(np.uint32).tobytes())

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.int64)
        place = at[:, None] * self.low_bits + np.arange(self.low_bits)
        packed = np.frombuffer(self.low, np.uint8)
        bit = (packed[place >> 3] >> (place & 7).astype(np.uint8)) & 1
        return (bit.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sample on."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        place, missing = int(self.samples[i // SAMPLE]), i % SAMPLE
        at, packed = place >> 3, np.frombuffer(self.high, np.uint8)
        byte = int(packed[at]) & (0xFF << (place & 7))
        while byte.bit_count() <= missing:
            missing -= byte.bit_count()
            at += 1
            byte = int(packed[at])
        for _ in range(missing):
            byte &= byte - 1
        one = (at << 3) + (byte & -byte).bit_length() - 1
        return (one - i << self.low_bits) + int(self._low(np.array([i]))[0])

    def between(self, start: int, stop: int) -> np.ndarray:
        """The values from ``start`` to ``stop``, reading from the sample before to the one after."""
        if start >= stop:
            return np.zeros(0, np.int64)
        place, after = int(self.samples[start // SAMPLE]), (stop - 1) // SAMPLE + 1
        last = (int(self.samples[after]) >> 3) + 1 if after < len(self.samples) else len(self.high)
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8)[place >> 3:last], bitorder="little")
        ones = np.flatnonzero(bits) + (place >> 3 << 3)
        skip = int(np.searchsorted(ones, place)) + start % SAMPLE
        at = np.arange(start, stop)
        return (ones[skip:skip + stop - start] - at << self.low_bits) + self._low(at)

    def values(self) -> np.ndarray:
        """All values at once."""
        return self.between(0, self.count)

    def first_at_least(self, value: int) -> int:
        """How many values are below ``value``, by bisection with ``select``."""
        low, high = 0, self.count
        while low < high:
            middle = (low + high) // 2
            if self.select(middle) < value:
                low = middle + 1
            else:
                high = middle
        return low


def _blocks(tokenizer: str | None):
    schema = pa.schema([(c.split()[0], {"int": pa.int32(), "long": pa.int64()}.get(
        c.split()[1], pa.binary())) for c in BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column_ids, shard = encoder(tokenizer).column_ids, TaskContext.get().partitionId()
        block, before, size, nulls, doc_ids, arrays = 0, 0, 0, 0, [], []

        def done() -> pa.RecordBatch:
            nonlocal block, before, size, nulls
            first, last = (doc_ids[0], doc_ids[-1]) if doc_ids else (None, None)
            of = EliasFano.of(np.array([i - first for i in doc_ids], np.int64))
            ends = EliasFano.of(np.cumsum([len(a) for a in arrays]))
            row = (shard, block, before, size, len(arrays), nulls, first, last, of.low_bits, of.low,
                   of.high, of.samples.tobytes(), ends.low_bits, ends.low, ends.high,
                   ends.samples.tobytes(), np.concatenate(arrays).astype("<u2").tobytes())
            block, before, size, nulls = block + 1, before + size, 0, 0
            doc_ids.clear()
            arrays.clear()
            return pa.RecordBatch.from_pydict(
                {n: [v] for n, v in zip(schema.names, row, strict=True)}, schema)

        for batch in batches:
            own = batch.column(0).to_pylist()
            for i, j, every, offsets in column_ids(batch.column(1), END_ID):
                for k in range(i, j):
                    if doc_ids and own[k] - doc_ids[0] >= ID_SPAN:
                        yield done()
                    if own[k] is None:
                        nulls += 1
                    else:
                        doc_ids.append(own[k])
                    arrays.append(every[offsets[k - i]:offsets[k - i + 1]])
                    size += len(arrays[-1])
                    if size >= BLOCK_IDS:
                        yield done()
        if arrays:
            yield done()
    return run


def write_token_file(docs: DataFrame, path: str, tokenizer: str | None = None,
                     id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all texts, each closed by the end id, in ascending order of document id.

    Rows without an id come first; rows with equal ids are all written, ordered by a hash of their
    text. A null text is empty: it has the end id only. An empty table gives an empty file.
    """
    rows = id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    (rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie")
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")
     .select("doc_id", "text").mapInArrow(_blocks(tokenizer), BLOCKS)
     .write.parquet(path))


class _Block:
    """A row of the file: which document is where, read from its two sequences."""

    def __init__(self, row: dict) -> None:
        self.row, self.nulls = row, row["n_without_id"]
        self.doc_ids = EliasFano(row["n_docs"] - self.nulls, row["id_bits"], row["id_low"],
                                 row["id_high"], row["id_samples"])
        self.ends = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"])
        self.ids = np.frombuffer(row["ids"], "<u2")

    def places(self, doc_id: int) -> tuple[int, int]:
        """From where to where the rows of ``doc_id`` lie in the block."""
        if self.row["first_id"] is None or not self.row["first_id"] <= doc_id <= self.row["last_id"]:
            return 0, 0
        value = doc_id - self.row["first_id"]
        return tuple(self.nulls + self.doc_ids.first_at_least(v) for v in (value, value + 1))

    def documents(self, start: int, stop: int) -> pa.RecordBatch:
        before = self.ends.select(start - 1) if start else 0
        ends = self.ends.between(start, stop)
        starts = np.concatenate([[before], ends[:-1]])
        own: list[int | None] = [None] * max(0, min(stop, self.nulls) - start)
        own += [self.row["first_id"] + i for i in self.doc_ids.between(
            max(start - self.nulls, 0), max(stop - self.nulls, 0)).tolist()]
        wide = self.ids[before:int(ends[-1])].astype("<u4")
        return pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int64()), pa.array(np.full(stop - start, self.row["shard"], np.int32)),
             pa.array(self.row["ids_before"] + starts), pa.array(ends - starts),
             pa.array([wide[s:e].tobytes() for s, e in zip(
                 (starts - before).tolist(), (ends - before).tolist(), strict=True)], pa.binary())],
            names=[c.split()[0] for c in DOCUMENTS.split(", ")])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = _Block(row)
            for a in range(0, row["n_docs"], READ_TOGETHER):
                yield block.documents(a, min(a + READ_TOGETHER, row["n_docs"]))


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, shard, start_in_shard, n_tokens, ids)``: ids as little-endian 32-bit numbers.

    Documents are read in runs; select on the samples finds where a run begins.
    """
    return spark.read.schema(BLOCKS).parquet(path).mapInArrow(_documents, DOCUMENTS)


def _chosen(doc_ids: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                for doc_id in doc_ids:
                    start, stop = block.places(doc_id)
                    for a in range(start, stop, READ_TOGETHER):
                        yield block.documents(a, min(a + READ_TOGETHER, stop))
    return run


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of :func:`read_token_file` for a few ids, found by select in the blocks around them.

    A repeated wish gives its rows once, an id that no row has gives none.
    """
    wanted = sorted(set(doc_ids))
    blocks = spark.read.schema(BLOCKS).parquet(path)
    if not wanted:
        return blocks.where("false").mapInArrow(_documents, DOCUMENTS)
    inside = F.exists(F.array(*[F.lit(i).cast("long") for i in wanted]),
                      lambda i: (i >= F.col("first_id")) & (i <= F.col("last_id")))
    near = (F.col("last_id") >= wanted[0]) & (F.col("first_id") <= wanted[-1])
    return blocks.where(near & inside).mapInArrow(_chosen(wanted), DOCUMENTS)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(shard, shard_start)``: ids in all shards before; a row per written partition."""
    totals = spark.read.schema(BLOCKS).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))


def document_starts(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`read_token_file` with ``start``, the ids of all documents before."""
    return rows.join(shard_starts(spark, path), "shard").withColumn(
        "start", F.col("shard_start") + F.col("start_in_shard"))

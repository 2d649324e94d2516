"""Packing under simultaneous limits on tokens, segments and loss-bearing tokens.

Vector bin packing, one open sequence at a time: of the pieces that fit all limits, the one
with the largest dot product of its size and the room left is placed next, both measured in
shares of the limits. Pieces of equal size are one entry with a count, so a choice looks at the
distinct sizes, not at the pieces. If pieces may be cut, a sequence that nothing fits any more
is filled up with the beginning of another piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parvis.llm.subwords import encoder
from parvis.llm.tables import id_text

END_ID = 0


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


def pack_vectors(tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool
                 ) -> list[list[tuple[int, int, int, int]]]:
    """Sequences of ``(item, start, length, loss)``; items with equal sizes go in given order.

    With ``cut``, items may be split; a cut takes loss-bearing tokens in proportion. Without it,
    an item above a limit raises, for it can't be placed whole.
    """
    most = np.array([limits.tokens, limits.segments, limits.loss], float)
    waiting: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for item in range(len(tokens) - 1, -1, -1):
        size = int(tokens[item]), int(loss[item])
        if size[0] > limits.tokens or size[1] > limits.loss:
            raise ValueError(f"item {item} of {size} exceeds the limits")
        if size[0]:
            waiting.setdefault(size, []).append((item, 0))
    sizes = np.array(sorted(waiting), float).reshape(-1, 2)
    vectors = np.column_stack([sizes[:, 0], np.ones(len(sizes)), sizes[:, 1]])
    shares = vectors / most
    counts = np.array([len(waiting[int(t), int(x)]) for t, x in sizes], int)
    where = {(int(t), int(x)): k for k, (t, x) in enumerate(sizes)}
    left, out = int(counts.sum()), []

    def take(k: int) -> tuple[int, int]:
        counts[k] -= 1
        return waiting[int(sizes[k, 0]), int(sizes[k, 1])].pop()

    while left:
        room, now = most.copy(), []
        while left:
            fits = (counts > 0) & (vectors <= room).all(axis=1)
            if fits.any():
                k = int(np.where(fits, shares @ (room / most), -1).argmax())
                item, start = take(k)
                left -= 1
                now.append((item, start, int(sizes[k, 0]), int(sizes[k, 1])))
                room -= vectors[k]
                continue
            if not cut or room[0] < 1 or room[1] < 1:
                break
            # The smallest piece larger than the room, cut where the first limit is met.
            k = int(np.argmax(counts > 0))
            while counts[k] == 0 or sizes[k, 0] <= room[0] and sizes[k, 1] <= room[2]:
                k += 1
            t, x = int(sizes[k, 0]), int(sizes[k, 1])
            part = int(min(room[0], t - 1, room[2] * t // x if x else t))
            if part < 1:
                break
            part_loss = x * part // t
            rest = t - part, x - part_loss
            item, start = take(k)
            now.append((item, start, part, part_loss))
            room -= (part, 1, part_loss)
            if rest not in where:
                where[rest] = len(counts)
                sizes = np.vstack([sizes, rest])
                vectors = np.vstack([vectors, (rest[0], 1, rest[1])])
                shares, counts = vectors / most, np.append(counts, 0)
            waiting.setdefault(rest, []).append((item, start + part))
            counts[where[rest]] += 1
        out.append(now)
    return out


WINDOW = 32_768  # pieces packed together in one task
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long")
BATCH_TOKENS = 1 << 20


class _Writer:
    """Rows of pieces, handed on in batches of bounded size."""

    def __init__(self, first_sequence: int) -> None:
        self.next_sequence, self.rows, self.tokens = first_sequence, [], 0

    def sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), doc_tokens,
                              self.next_sequence, offset))
            offset += len(ids)
        self.tokens += offset
        self.next_sequence += 1

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
        names = [c.split()[0] for c in PIECES.split(", ")]
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * 7
        self.rows, self.tokens = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def pack_documents(docs: DataFrame, limits: Limits = Limits(), tokenizer: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts as token ids with an end id, cut into pieces and packed into sequences.

    One row per piece: where it starts in its document, its ids (little-endian unsigned 32-bit),
    the document's ids in all, its sequence and its place there. A document gives whole
    sequences first, and its rest is packed with the rests of ``WINDOW`` other documents of the
    same partition, in the order of their ids. Every id carries loss. Null and empty texts have the
    end id only. Sequence numbers follow from the partition, so a task that runs again gives
    them again, given the same input rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column_ids = encoder(tokenizer).column_ids
        whole = min(limits.tokens, limits.loss)
        writer = _Writer(TaskContext.get().partitionId() << 36)
        rests: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            rests.sort(key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[2].tobytes())))
            sizes = np.array([len(r[2]) for r in rests], int)
            for sequence in pack_vectors(sizes, sizes, limits, cut=True):
                pieces = []
                for item, start, length, _ in sequence:
                    doc_id, at, ids, total = rests[item]
                    pieces.append((doc_id, at + start, ids[start:start + length], total))
                writer.sequence(pieces)
                if writer.tokens >= BATCH_TOKENS:
                    yield writer.batch()
            rests.clear()

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, j, every, offsets in column_ids(batch.column(1), END_ID):
                for k in range(i, j):
                    doc_id, ids = doc_ids[k], every[offsets[k - i]:offsets[k - i + 1]]
                    cut = len(ids) // whole * whole
                    for start in range(0, cut, whole):
                        writer.sequence([(doc_id, start, ids[start:start + whole], len(ids))])
                    if cut < len(ids):
                        rests.append((doc_id, cut, ids[cut:].copy(), len(ids)))
                    if writer.tokens >= BATCH_TOKENS:
                        yield writer.batch()
                if len(rests) >= WINDOW:
                    yield from flush()
        yield from flush()
        yield writer.batch()

    return id_text(docs, id_col, text_col).mapInArrow(run, PIECES)


EXAMPLES = "example_id long, sequence_id long, offset long"


def pack_examples(examples: DataFrame, limits: Limits = Limits(), id_col: str = "example_id",
                  tokens_col: str = "tokens", loss_col: str = "loss_tokens") -> DataFrame:
    """Instruction examples, kept whole, packed under all three limits.

    One row per example. ``WINDOW`` examples of a partition are packed together, by id and size,
    however the rows come in batches. Null counts are 0, and an example without tokens is no piece:
    its sequence and offset are null. Repeated ids are examples of their own, rows without an id come
    first. An example above a limit raises an error. Other columns are not looked at.
    """
    rows = examples.select(
        F.col(id_col).cast("long").alias("example_id"),
        *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(n)
          for c, n in ((tokens_col, "tokens"), (loss_col, "loss"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following = TaskContext.get().partitionId() << 36
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal following
            waiting.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
            out = [(doc_id, None, None) for doc_id, tokens, _ in waiting if not tokens]
            sizes = [np.array([r[k] for r in waiting], int) for k in (1, 2)]
            for sequence in pack_vectors(*sizes, limits, cut=False):
                offset = 0
                for item, _, length, _ in sequence:
                    out.append((waiting[item][0], following, offset))
                    offset += length
                following += 1
            waiting.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                names=["example_id", "sequence_id", "offset"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                waiting.append(row)
                if len(waiting) >= WINDOW:
                    yield flush()
        if waiting:
            yield flush()

    return rows.mapInArrow(run, EXAMPLES)

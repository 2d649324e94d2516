"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are taken relative to a centre and rotated by a fixed random orthogonal matrix; one sign
bit per coordinate is kept, with two scalars: the vector's length, and the inner product of its
direction with its own code, which corrects the estimate. The query stays exact. The estimated
inner product is off by about ``1 / sqrt(dimension)`` of the part the code does not explain, so
each estimate comes with bounds on the distance; only vectors whose lower bound reaches the
k-th smallest upper bound of their block are measured exactly.

Every vector is coded and held against every query, in blocks: a wave of at most ``WAVE`` queries
goes to all tasks, and each block of ``BLOCK`` vectors hands on its best k for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parvis.staging import new_scratch_path

WAVE, BLOCK, QUERY_BLOCK = 4096, 4096, 64
EPSILON = 3.0  # bounds hold for an estimate with probability above 0.995
CENTRE_ROWS = 4096


def rotation(dimension: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimension, dimension)))
    return q * np.sign(np.diag(r))


class Codes:
    """Packed sign bits, lengths and correction scalars of the rows of ``vectors``."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> None:
        turned = (vectors - centre) @ turn
        self.length = np.sqrt((turned ** 2).sum(axis=1))
        unit = turned / np.maximum(self.length, 1e-300)[:, None]
        self.bits = np.packbits(unit > 0, axis=1)
        self.own = np.abs(unit).sum(axis=1) / np.sqrt(vectors.shape[1])
        self.dimension = vectors.shape[1]

    def signs(self) -> np.ndarray:
        bits = np.unpackbits(self.bits, axis=1, count=self.dimension)
        return (2.0 * bits - 1) / np.sqrt(self.dimension)

    def bounds(self, turned_queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of squared distances, a row per query."""
        size = np.sqrt((turned_queries ** 2).sum(axis=1))[:, None]
        inner = turned_queries @ self.signs().T / np.maximum(self.own, 1e-12)
        left = np.sqrt(np.maximum(1 - self.own ** 2, 0)) / np.maximum(self.own, 1e-12)
        error = EPSILON * size * left / np.sqrt(max(self.dimension - 1, 1))
        middle = size ** 2 + self.length ** 2
        return (middle - 2 * self.length * (inner + error),
                middle - 2 * self.length * (inner - error))


def _usable(id_col: str, vector_col: str, df: DataFrame) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v")).where(
        F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
        & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def nearest(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest other rows of each row with ``is_query``.

    ``score`` is the Euclidean distance of the original vectors; ties go to the smaller id. Rows
    without an id, and vectors that are null, zero, or hold null or non-finite numbers take no
    part; vectors of another dimension than the most frequent one neither. Rows with the same id
    are one candidate at their smallest distance, and no candidate of their own queries. The
    centre is the mean of at most ``CENTRE_ROWS`` vectors; any centre gives right bounds.
    """
    usable = _usable(id_col, vector_col, vectors)
    sizes = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dimension = sizes["d"]
    usable = usable.where(F.size("v") == dimension)
    few = usable.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(CENTRE_ROWS).select("v")
    centre = np.array([r["v"] for r in few.collect()]).mean(axis=0)
    queries = usable.where(is_query(F.col("vec_id"))).distinct()

    path, wave, behind = new_scratch_path(spark, "nearest"), 0, None
    while True:
        # Queries go in the order of id and vector, so that a wave begins where the last one
        # ended; the vectors of one id may lie in several.
        rest = queries if behind is None else queries.where(
            F.struct("vec_id", "v") > F.struct(F.lit(behind["vec_id"]).cast("long"), F.array(
                *[F.lit(x) for x in behind["v"]])))
        now = rest.orderBy("vec_id", "v").limit(WAVE).collect()
        if not now:
            break
        behind = now[-1]
        ids = np.array([r["vec_id"] for r in now])
        found = usable.mapInArrow(
            _block_search(ids, np.array([r["v"] for r in now]), centre, k),
            "query_id long, vec_id long, score double")
        found.write.parquet(f"{path}/wave={wave}")
        wave += 1
    if not wave:
        return spark.createDataFrame([], schema)
    found = spark.read.schema("query_id long, vec_id long, score double").parquet(
        *[f"{path}/wave={w}" for w in range(wave)])
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _block_search(ids: np.ndarray, queries: np.ndarray, centre: np.ndarray, k: int):
    turn = rotation(queries.shape[1])
    turned = (queries - centre) @ turn

    def search(block_ids: np.ndarray, vectors: np.ndarray):
        block_ids, first = np.unique(np.column_stack([block_ids, np.arange(len(block_ids))]),
                                     axis=0).T
        vectors = vectors[first]
        codes, out = Codes(vectors, centre, turn), []
        # Rows of one id lie side by side; the limit is taken over ids, at their smallest bounds.
        starts = np.flatnonzero(np.append(True, block_ids[1:] != block_ids[:-1]))
        for a in range(0, len(ids), QUERY_BLOCK):
            low, high = codes.bounds(turned[a:a + QUERY_BLOCK])
            same = block_ids[None, :] == ids[a:a + QUERY_BLOCK, None]
            high[same], low[same] = np.inf, np.inf
            most = min(k, len(starts))
            each = np.minimum.reduceat(high, starts, axis=1)
            limit = np.partition(each, most - 1, axis=1)[:, most - 1]
            for q, near in enumerate((low <= limit[:, None]) & ~same):
                at = np.flatnonzero(near)
                exact = np.sqrt(((vectors[at] - queries[a + q]) ** 2).sum(axis=1))
                order = np.lexsort((block_ids[at], exact))
                # Rows with one id count once, so more than k may be needed.
                taken, seen = [], set()
                for i in order.tolist():
                    if block_ids[at[i]] not in seen:
                        seen.add(block_ids[at[i]])
                        taken.append(i)
                        if len(taken) == k:
                            break
                out.append((np.full(len(taken), ids[a + q]), block_ids[at[taken]], exact[taken]))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
            names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                held.append((part.column(0).to_numpy(), _matrix(part.column(1))))
                rows += part.num_rows
                if rows >= BLOCK:
                    yield search(*(np.concatenate(c) for c in zip(*held, strict=True)))
                    held, rows = [], 0
        if rows:
            yield search(*(np.concatenate(c) for c in zip(*held, strict=True)))
    return run

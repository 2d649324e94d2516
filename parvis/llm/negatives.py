"""Hard negatives with an R-tree packed by sort-tile-recursive.

Components are taken as integers, so every score, an inner product, is exact. The rows are dealt in
ranges of one coordinate and written in the order of the tree's pages: blocks of consecutive rows
are cut into tiles by one coordinate after the other, and a tile's last cut gives its pages.
A page has a minimum bounding box, and each level above boxes around those below. With an anchor,
each coordinate of a box gives an interval of products; their sums bound the score of all rows in
the box from both sides. A queue takes the box with the highest bound first. Boxes outside
the wanted scores, or strictly below the k-th best so far, are left out with all they hold; boxes
that just reach the k-th best are left out if even their smallest id comes later.

Anchors go to all tasks in waves of bounded size: once for their positives, and once, when
those are known, for the negatives in the windows below them. Every task hands on its best few.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parvis.staging import new_scratch_path, stage

WAVE, BLOCK, PAGE, FANOUT, TOGETHER = 2048, 16_384, 128, 16, 64
TILED = 3  # coordinates that cut a block into tiles
FIRST_LOOK = 4096  # about so many rows give each anchor a first bound
EXACT = 2 ** 53

Found = tuple[float, int]  # minus the score, and the id: the best come first


def str_order(values: np.ndarray, ids: np.ndarray, coordinates: list[int]
              ) -> Iterator[np.ndarray]:
    """The rows of each page: sorted and cut by the first coordinate, then the next, ..."""
    def tile(rows: np.ndarray, left: list[int]) -> Iterator[np.ndarray]:
        pages = math.ceil(len(rows) / PAGE)
        if not left or pages <= 1:
            rows = rows[np.argsort(ids[rows], kind="stable")] if not left else rows
            for a in range(0, len(rows), PAGE):
                yield rows[a:a + PAGE]
            return
        rows = rows[np.lexsort((ids[rows], values[rows, left[0]].astype(float)))]
        slabs = math.ceil(pages ** (1 / len(left))) if len(left) > 1 else pages
        each = math.ceil(pages / slabs) * PAGE
        for a in range(0, len(rows), each):
            yield from tile(rows[a:a + each], left[1:])

    yield from tile(np.arange(len(ids)), coordinates)


class Tree:
    """The boxes over a block of rows that lie page by page."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray,
                 pages: np.ndarray) -> None:
        self.ids, self.labels, self.values = ids, labels, values
        self.start = np.flatnonzero(np.append(True, pages[1:] != pages[:-1]))
        self.stop = np.append(self.start[1:], len(ids))
        low = np.minimum.reduceat(values, self.start, axis=0)
        high = np.maximum.reduceat(values, self.start, axis=0)
        least = np.minimum.reduceat(ids, self.start)
        levels = [(low, high, least)]
        while len(levels[-1][0]) > 1:
            low, high, least = levels[-1]
            at = np.arange(0, len(low), FANOUT)
            levels.append((np.minimum.reduceat(low, at, axis=0),
                           np.maximum.reduceat(high, at, axis=0), np.minimum.reduceat(least, at)))
        self.levels = len(levels)
        self.first = np.append(0, np.cumsum([len(v[0]) for v in levels]))
        self.low, self.high = (np.concatenate([v[k] for v in levels]) for k in (0, 1))
        self.least = np.concatenate([v[2] for v in levels]).tolist()

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the highest score that each box allows each anchor."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return (up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T)

    def best_first(self, low: np.ndarray, high: np.ndarray, floor: Callable[[], float],
                   wanted: Callable[[float, float, int], bool],
                   look: Callable[[int, int], None]) -> None:
        """Show the pages one anchor wants, highest bound first, until none can reach ``floor``."""
        root = int(self.first[-2])
        queue = [(-high[root], self.least[root], self.levels - 1, 0)]
        while queue:
            bound, _, level, k = heapq.heappop(queue)
            if -bound < floor():
                return
            node = int(self.first[level]) + k
            if not wanted(low[node], high[node], self.least[node]):
                continue
            if not level:
                look(int(self.start[k]), int(self.stop[k]))
                continue
            base, size = int(self.first[level - 1]), int(self.first[level] - self.first[level - 1])
            for child in range(k * FANOUT, min((k + 1) * FANOUT, size)):
                node = base + child
                if wanted(low[node], high[node], self.least[node]):
                    heapq.heappush(queue, (-high[node], self.least[node], level - 1, child))


class Best:
    """The best ``k`` rows with scores from ``low`` to ``high``, ties to the smaller id."""

    def __init__(self, k: int, low: float, high: float) -> None:
        self.k, self.low, self.high, self.found = k, low, high, []

    def floor(self) -> float:
        """No score below this is wanted any more."""
        return -self.found[-1][0] if len(self.found) == self.k else self.low

    def wants(self, low: float, high: float, least_id: int) -> bool:
        if low > self.high or high < self.low:
            return False
        if len(self.found) < self.k:
            return True
        return (-min(high, self.high), least_id) < self.found[-1]

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for i in np.flatnonzero((scores >= self.floor()) & (scores <= self.high)).tolist():
            row = (-scores[i], int(ids[i]))
            if len(self.found) < self.k or row < self.found[-1]:
                insort(self.found, row)
                del self.found[self.k:]


class Anchor:
    """One anchor with the windows it searches, among rows of its own label or of all others."""

    def __init__(self, vec_id: int, label: str, vector: np.ndarray, same: bool,
                 windows: list[Best]) -> None:
        self.id, self.label, self.vector = vec_id, label, vector
        self.same, self.windows = same, windows

    def floor(self) -> float:
        return min(w.floor() for w in self.windows)

    def wants(self, low: float, high: float, least_id: int) -> bool:
        return any(w.wants(low, high, least_id) for w in self.windows)

    def offer(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> None:
        scores = values @ self.vector
        own = (labels == self.label) == self.same
        own &= (ids != self.id) & (scores >= self.floor())
        if own.any():
            for w in self.windows:
                w.offer(scores[own], ids[own])

    def search(self, tree: Tree, low: np.ndarray, high: np.ndarray) -> None:
        tree.best_first(low, high, self.floor, self.wants, lambda a, b: self.offer(
            tree.ids[a:b], tree.labels[a:b], tree.values[a:b]))


PARTIAL = "anchor_id long, window long, vec_id long, score long"
_INDEX = "vec_id long, label string, v array<double>, page long"


def _matrix(column: pa.Array, exact: bool) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    if exact:
        return values
    return np.array([[int(x) for x in row] for row in values.tolist()], object)


def _blocks(batches: Iterator[pa.RecordBatch], exact: bool) -> Iterator[tuple]:
    """Ids, labels, values and last column of up to about ``BLOCK`` rows."""
    held, rows = [], 0

    def whole() -> tuple:
        return tuple(np.concatenate(c) for c in zip(*held, strict=True))

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            held.append((part.column(0).to_numpy(zero_copy_only=False),
                         np.array(part.column(1).to_pylist(), object),
                         _matrix(part.column(2), exact),
                         part.column(3).to_numpy(zero_copy_only=False)))
            rows += part.num_rows
            if rows >= BLOCK:
                yield whole()
                held, rows = [], 0
    if rows:
        yield whole()


def _pack(coordinates: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = TaskContext.get().partitionId() << 32
        for ids, labels, values, _ in _blocks(batches, True):
            order, number = [], []
            for rows in str_order(values, ids, coordinates):
                order.append(rows)
                number.append(np.full(len(rows), page))
                page += 1
            rows = np.concatenate(order)
            flat = values[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows]), pa.array(labels[rows], pa.string()),
                 pa.ListArray.from_arrays(
                     np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32), flat.ravel()),
                 pa.array(np.concatenate(number))], names=["vec_id", "label", "v", "page"])
    return run


def _search(anchors: list[Anchor], exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, exact):
            tree = Tree(*block)
            for a in range(0, len(anchors), TOGETHER):
                some = anchors[a:a + TOGETHER]
                low, high = tree.bounds(np.array([x.vector for x in some]))
                for x, one, two in zip(some, low.tolist(), high.tolist(), strict=True):
                    x.search(tree, one, two)
        out = [(x.id, n, vec_id, -int(score)) for x in anchors
               for n, w in enumerate(x.windows) for score, vec_id in w.found]
        columns = zip(*out, strict=True) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns],
            names=["anchor_id", "window", "vec_id", "score"])
    return run


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int
                ) -> DataFrame:
    """``(vec_id, label, v)`` of the rows that take part, one for each id, with whole numbers."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        vector.alias("v")).where(
        "vec_id is not null and label is not null and size(v) > 0").where(finite)
    # From 2^52 on a double has no fraction; below, its floor fits in a long.
    whole = F.transform("v", lambda x: F.when(
        F.abs(x * scale) < 2.0 ** 52, F.floor(x * scale).cast("double")).otherwise(x * scale))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    return one.select("vec_id", "row.label", F.col("row.v").alias("v")).withColumn("v", whole)


def hard_negatives(vectors: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5,
                   k: int = 5, percent: int = 80, scale: int = 256, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    A score is the inner product of two vectors with components ``floor(scale * x)``. The
    positives of an anchor are the first other rows of its label; for each, the first ``k`` rows of
    another label whose score is at least ``percent`` hundredths of the positive's, and not above it.
    Higher scores come first, then smaller ids. Rows without id or label, and vectors that are null,
    empty, hold null or non-finite numbers, or have another dimension than the most frequent one,
    take no part. Rows of one id are one row, the least by label and vector. An anchor without
    positives, or a positive without negatives, gives no row. Scores beyond 64 bits raise an error.
    """
    spark = vectors.sparkSession
    out = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
           "negative_score long")
    usable = stage(usable_rows(vectors, id_col, vector_col, label_col, scale), "negatives-rows")
    facts = usable.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.array_max(F.transform("v", F.abs))).alias("most")).orderBy(F.desc("n"), "d").first()
    if facts is None:
        return spark.createDataFrame([], out)
    usable = usable.where(F.size("v") == facts["d"])
    exact = facts["most"] ** 2 * facts["d"] * 100 < EXACT

    # A first look at few rows: which coordinates spread most, and a score each anchor can reach.
    few = usable.where(F.pmod(F.xxhash64("vec_id"), F.lit(math.ceil(facts["n"] / FIRST_LOOK)))
                       == 0).limit(2 * FIRST_LOOK).collect()
    seen = None
    widest = list(range(min(TILED + 1, facts["d"])))
    if few:
        values = np.array([r["v"] for r in few])
        widest = np.argsort(-values.var(axis=0), kind="stable")[:TILED + 1].tolist()
        if not exact:
            values = np.array([[int(x) for x in row] for row in values.tolist()], object)
        seen = (np.array([r["vec_id"] for r in few]),
                np.array([r["label"] for r in few], object), values)

    blocks = max(1, math.ceil(facts["n"] / BLOCK))
    keys = [F.element_at("v", widest[0] + 1), F.col("vec_id")]
    index = stage(usable.repartitionByRange(blocks, *keys).sortWithinPartitions(*keys).select(
        "vec_id", "label", "v", F.lit(0).cast("long").alias("page")).mapInArrow(
        _pack(widest[1:] or widest), _INDEX), "negatives-index")

    path, wave, behind = new_scratch_path(spark, "negatives"), 0, None
    chosen = index.where(is_anchor(F.col("vec_id")))
    while True:
        rest = chosen if behind is None else chosen.where(F.col("vec_id") > behind)
        now = rest.orderBy("vec_id").limit(WAVE).collect()
        if not now:
            break
        behind = now[-1]["vec_id"]
        vector = {r["vec_id"]: np.array([int(x) for x in r["v"]], float if exact else object)
                  for r in now}
        label = {r["vec_id"]: r["label"] for r in now}

        def found(windows: dict[int, list[Best]], same: bool, most: int) -> DataFrame:
            """The best rows of each window, from all tasks."""
            anchors = [Anchor(i, label[i], vector[i], same, w) for i, w in windows.items() if w]
            for a in anchors:
                if seen is not None:
                    a.offer(*seen)
                for w in a.windows:  # the first look is a bound only; its rows are met again
                    w.low, w.found = w.floor(), []
            order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
            return index.mapInArrow(_search(anchors, exact), PARTIAL).withColumn(
                "rank", F.row_number().over(order)).where(F.col("rank") <= most)

        near = found({i: [Best(positives, -math.inf, math.inf)] for i in vector}, True,
                     positives).collect()
        reached: dict[int, list[int]] = {i: [] for i in vector}
        for r in near:
            # Positives of one score share a window; the least score of the window is rounded up.
            if r["score"] not in reached[r["anchor_id"]] and \
                    -(-percent * r["score"] // 100) <= r["score"]:
                reached[r["anchor_id"]].append(r["score"])
        windows = {i: [Best(k, -(-percent * s // 100), s) for s in scores]
                   for i, scores in reached.items()}
        pairs = [(r["anchor_id"], r["vec_id"], r["score"], reached[r["anchor_id"]].index(r["score"]))
                 for r in near if r["score"] in reached[r["anchor_id"]]]
        below = found(windows, False, k).select(
            "anchor_id", "window", "rank", F.col("vec_id").alias("negative_id"),
            F.col("score").alias("negative_score"))
        spark.createDataFrame(
            pairs, "anchor_id long, positive_id long, positive_score long, window long").join(
            below, ["anchor_id", "window"]).select(*[c.split()[0] for c in out.split(", ")]
                                                   ).write.parquet(f"{path}/wave={wave}")
        wave += 1
    if not wave:
        return spark.createDataFrame([], out)
    return spark.read.schema(out).parquet(*[f"{path}/wave={w}" for w in range(wave)])

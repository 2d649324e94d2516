"""Files that hold one JSON array of objects, large ones read in many tasks a file.

Such a file is cut at its ``}`` by Spark's text reader, in splits. Where a split begins, one can't see
whether a string is open there, nor how deep it lies. So a first pass finds of each split how it
changes both; running sums give the state in which each begins; and a second pass puts
the pieces together to elements. What lies across the end of a split, at most one element for each, is
put together from its parts. The elements are staged one a line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parvis.staging import new_scratch_path, stage

ESCAPED = re.compile(r"\\.", re.DOTALL)
BEGINS = re.compile(r"\s*\[\s*\{")
SPLIT = "path string, block long, odd boolean, outside long, inside long, begins boolean"
PARTS = "path string, block long, kind string, element string"


def read_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of JSON arrays, one array a file; fields that are no columns are left out.

    Files that are no closed array of objects are left to Spark's own reader, one task a file. (For
    each number that becomes a text it goes back to the file, so it reads many times a file's size.) In
    arrays, an element that can't be read has no values, where Spark's reader gives up its file.
    """
    whole = spark.read.schema(schema).option("multiLine", True).json(path)
    pieces = spark.read.option("lineSep", "}").text(path).withColumns(
        {"path": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start")})
    states, others = _states(
        pieces.select("value", "path", "block").mapInArrow(_changes(), SPLIT).collect())
    elements = _elements(spark, pieces.where(~F.col("path").isin(others)) if others else pieces,
                         states, whole)
    if not others:
        return elements
    return elements.unionByName(whole.where(F.col("_metadata.file_path").isin(others)))


def _scanner():
    """Functions on pieces, made anew in each call so that they travel to the tasks by value."""
    def turns(piece: str) -> tuple[bool, int, int]:
        """Whether a piece opens or closes a string, and how much deeper its end lies, if it begins
        outside of strings and if inside; the ``}`` at its end counts where it is no part of a string."""
        parts = ESCAPED.sub("", piece).split('"')
        odd = len(parts) % 2 == 0
        out, within = ("".join(parts[k::2]) for k in (0, 1))
        deeper = [p.count("{") + p.count("[") - p.count("}") - p.count("]") for p in (out, within)]
        return odd, deeper[0] - (not odd), deeper[1] - odd

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], str]]:
        columns = (batch.column(k).to_pylist() for k in range(3))
        for piece, path, block in zip(*columns, strict=True):
            yield (path, block), piece

    return turns, runs


def _changes():
    """Of each split how its end differs from its begin, as that of its pieces."""
    turns, runs = _scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits: dict[tuple, list] = {}
        for batch in batches:
            for key, piece in runs(batch):
                odd, outside, inside = turns(piece)
                now = splits.setdefault(key, [])
                if not now:
                    now += odd, outside, inside, BEGINS.match(piece) is not None
                    continue
                now[1] += inside if now[0] else outside
                now[2] += outside if now[0] else inside
                now[0] ^= odd
        rows = [(*key, *now) for key, now in splits.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=[c.split()[0] for c in SPLIT.split(", ")])
    return run


def _states(splits: list) -> tuple[dict[tuple[str, int], tuple[bool, int]], list[str]]:
    """In which state the splits behind a file's first begin: (in a string, depth). And the files that
    are no closed array of objects."""
    files: dict[str, list] = {}
    for r in sorted(splits):
        files.setdefault(r["path"], []).append(r)
    states, others = {}, []
    for path, rows in files.items():
        odd, depth, own = False, 0, {}
        for r in rows:
            own[path, r["block"]] = odd, depth
            depth += r["inside"] if odd else r["outside"]
            odd ^= r["odd"]
        # What follows the last element has no brace at its end, but was counted with one.
        if rows[0]["begins"] and not odd and depth == -1:
            own.pop((path, rows[0]["block"]))
            states.update(own)
        else:
            others.append(path)
    return states, others


def _elements(spark: SparkSession, pieces: DataFrame, states: dict, whole: DataFrame) -> DataFrame:
    """The elements as rows like those of ``whole``, partition columns among them."""
    folders = [c for c in pieces.columns if c not in ("value", "path", "block")]
    kept = [F.col(f"`{c}`") for c in folders]
    kind = pieces.select(*kept).schema
    rows = pieces.select("value", "path", "block", *kept).mapInArrow(
        _join_pieces(states, parts=False), T.StructType([T.StructField("element", T.StringType()),
                                                         *kind.fields]))
    # Depth 1 lies between two elements, depth 0 before the array.
    cut = sorted({path for (path, _), (odd, depth) in states.items() if odd or depth > 1})
    if cut:
        parts = stage(pieces.where(F.col("path").isin(cut)).select(
            "value", "path", "block", *kept).mapInArrow(
            _join_pieces(states, parts=True), T.StructType([
                *T.StructType.fromDDL(PARTS).fields, *kind.fields])), "json-parts")
        # An element begins with an open end and goes on to the next split that closes it.
        number = F.sum(F.when(F.col("kind") == "begin", 1).otherwise(0)).over(
            Window.partitionBy("path").orderBy("block", F.col("kind") == "begin"))
        joined = parts.withColumn("n", number).groupBy("path", "n", *kept).agg(
            F.array_sort(F.collect_list(F.struct("block", "element"))).alias("parts"))
        rows = rows.unionByName(joined.select(
            F.array_join("parts.element", "").alias("element"), *kept))
    # Spark's reader keeps numbers as they are spelled, but only in files: so elements become lines.
    lines = new_scratch_path(spark, "json-lines")
    rows.select(F.translate(F.expr("substr(element, locate('{', element))"), "\r\n", "  ").alias("value"),
                *kept).write.partitionBy(*folders).text(lines)
    return spark.read.schema(whole.schema).json(lines)


def _join_pieces(states: dict, parts: bool):
    """The elements of pieces in file order; or the parts of elements that lie across a split's end."""
    turns, runs = _scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, head, odd, depth, folder = None, [], False, False, 0, []
        broken: list[tuple] = []

        def leave() -> None:
            """The end of a split: what is still open goes on in the next one."""
            if held and (odd or depth > 1):
                broken.append((*now, "middle" if head else "begin", "".join(held), *folder))

        for batch in batches:
            done, at = [], []
            for i, (key, piece) in enumerate(runs(batch)):
                if key != now:
                    leave()
                    now, held = key, []
                    odd, depth = states.get(key, (False, 0))
                    head = odd or depth > 1
                    folder = [batch.column(k)[i].as_py() for k in range(3, batch.num_columns)]
                turn, outside, inside = turns(piece)
                depth += inside if odd else outside
                odd ^= turn
                held.append(piece + "}")
                if not odd and depth <= 1:
                    if head:
                        broken.append((*now, "end", "".join(held), *folder))
                    elif depth == 1:
                        done.append("".join(held))
                        at.append(i)
                    held, head = [], False
            if not parts:
                folders = [batch.column(k).take(pa.array(at, pa.int64()))
                           for k in range(3, batch.num_columns)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(done, pa.string()), *folders],
                    names=["element", *batch.schema.names[3:]])
                broken.clear()
        leave()
        if parts and now is not None:
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(),
                     *[batch.schema.field(k).type for k in range(3, batch.num_columns)]]
            columns = zip(*broken, strict=True) if broken else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["path", "block", "kind", "element", *batch.schema.names[3:]])
    return run

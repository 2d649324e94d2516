"""CSV whose quoted values may hold line breaks, read in many tasks a file.

Where a byte range of such a file begins, one can't see whether a value is open there. But in a
well-formed file it is open exactly if the number of quotes before it is odd. So a first pass
counts the quotes of each split of the files; running sums say in which state each split
begins; and a second pass puts the lines of each split together to records. What lies across the
end of a split, at most one record for each, is put together from its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parvis.staging import stage

COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")
FORMAT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "encoding": "UTF-8"}
BROKEN_TEXTS = "path string, block long, kind string, record string"


def read_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A headed CSV as text columns, named by its header.

    Quotes inside quoted values are doubled, and such values may hold separators and line breaks.
    Files without line breaks in values are read by Spark's own reader, in splits; those with
    some in splits by the parity of their quotes. Read by one task each are compressed files, which
    have no splits, files whose quotes do not pair or stand inside unquoted values, files of
    several kinds of line ends, and files in partition folders. Short rows are kept with nulls at their end.
    """
    own = {"header": True, "sep": sep, **FORMAT}
    whole = spark.read.options(multiLine=True, **own).csv(path)
    lines = spark.read.option("lineSep", "\n").text(path).withColumns(
        {"path": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start")})
    files = whole.inputFiles()
    if not files or all(f.endswith(COMPRESSED) for f in files) or lines.columns != [
            "value", "path", "block"]:
        return whole
    splits = stage(_quote_counts(lines, sep), "csv-splits")
    total = splits.agg(F.sum("odd_lines"), F.sum("stray")).first()
    if not total[0]:
        return whole if total[1] else spark.read.options(**own).csv(path)
    # Where lines end in CRLF, so does a break within a value, and is read as one LF.
    ends = splits.where("block = 0").agg(F.min("crlf"), F.max("crlf")).first()
    uneven = splits.groupBy("path").agg((F.sum("quotes") % 2).alias("rest")).where("rest = 1")
    if total[1] or ends[0] != ends[1] or uneven.limit(1).count():
        return whole
    return _records(spark, lines, splits, whole.columns, sep, ends[0])


def _quote_counts(lines: DataFrame, sep: str) -> DataFrame:
    """Of each split its quotes, its lines with an odd number of them, and stray quotes.

    A quote is stray if neither a separator nor a line's end nor another quote is next to it.
    ``crlf`` says how the first line ends.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    other = f'[^{re.escape(sep)}"\r\n]'
    counted = lines.withColumns({"n": quotes, "at": F.monotonically_increasing_id()})
    return counted.groupBy("path", "block").agg(
        F.min_by(F.col("value").endswith("\r"), "at").alias("crlf"),
        F.sum("n").alias("quotes"), F.count_if(F.col("n") % 2 == 1).alias("odd_lines"),
        F.count_if((F.col("n") > 0) & F.col("value").rlike(f'(?<={other})"(?={other})'))
        .alias("stray"))


def _records(spark: SparkSession, lines: DataFrame, splits: DataFrame, names: list[str],
             sep: str, crlf: bool) -> DataFrame:
    before = F.sum("quotes").over(Window.partitionBy("path").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1))
    states = splits.withColumn("opens", F.coalesce(before, F.lit(0)) % 2 == 1).withColumn(
        "closes", F.expr("(quotes % 2 = 1) != opens"))
    # Splits that begin or end within a value: one for each value that lies across an end.
    edges = states.where("opens or closes").select("path", "block", "opens").collect()
    opens = frozenset((r["path"], r["block"]) for r in edges if r["opens"])
    whole = lines.mapInArrow(_join_lines(opens, parts=False), "record string")
    if edges:
        files = sorted({r["path"] for r in edges})
        parts = stage(lines.where(F.col("path").isin(files)).mapInArrow(
            _join_lines(opens, parts=True), BROKEN_TEXTS), "csv-parts")
        # A record begins with an open end and goes on to the next split that closes it.
        record = F.sum(F.when(F.col("kind") == "begin", 1).otherwise(0)).over(
            Window.partitionBy("path").orderBy("block", F.col("kind") == "begin"))
        joined = parts.withColumn("n", record).groupBy("path", "n").agg(
            F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"))
        whole = whole.unionByName(joined.select(
            F.array_join("parts.record", "\n").alias("record")))
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
    clean = F.regexp_replace("record", r"\r\z", "")
    if crlf:
        clean = F.replace(clean, F.lit("\r\n"), F.lit("\n"))
    return whole.select(clean.alias("record")).where("record != ''").select(
        F.from_csv("record", schema, {"sep": sep, "multiLine": "true", **FORMAT}).alias("row")
    ).select("row.*")


def _join_lines(opens: frozenset, parts: bool):
    """The records of lines in file order; or the parts of records that lie across a split's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, odd, held, head, first = None, False, [], False, False
        out: list[tuple] = []

        def leave() -> None:
            """The end of a split: what is still open goes on in the next one."""
            if held and now is not None:
                out.append((*now, "middle" if head else "begin", "\n".join(held)))

        for batch in batches:
            done: list[pa.Array] = []
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            at = 0
            while at < len(keys):
                stop = at + 1
                if keys[-1] == keys[at]:
                    stop = len(keys)
                while stop < len(keys) and keys[stop] == keys[at]:
                    stop += 1
                part = batch.column(0).slice(at, stop - at)
                if keys[at] != now:
                    leave()
                    now, held = keys[at], []
                    odd = head = now in opens
                    first = now[1] == 0
                turns = pc.bit_wise_and(pc.count_substring(part, '"'), 1)
                if not odd and not held and not first and not pc.any(pc.cast(turns, "bool")).as_py():
                    done.append(part)
                else:
                    records = []
                    for line, turn in zip(part.to_pylist(), turns.to_pylist(), strict=True):
                        held.append(line)
                        odd ^= turn == 1
                        if not odd:
                            if head:
                                out.append((*now, "end", "\n".join(held)))
                            elif not first:
                                records.append("\n".join(held))
                            held, head, first = [], False, False
                    done.append(pa.array(records, pa.string()))
                at = stop
            if not parts:
                yield from (pa.RecordBatch.from_arrays([a.cast(pa.string())], names=["record"])
                            for a in done)
                out.clear()
        leave()
        if parts:
            columns = zip(*out, strict=True) if out else [[]] * 4
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["path", "block", "kind", "record"])
    return run

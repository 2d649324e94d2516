"""Tables replaced as a whole, without a moment in which there is no table.

Each state of a table is a folder of its own beside the others, and a small numbered file under
``_commits`` names it. A reader takes the file with the highest number. A new state is written
first and then committed by the single step that puts its file there, complete, under the
next number: before that step all readers find the old state, after it the new one. No data is
moved, so nothing is copied in stores that rename by copying.

A table may also consist of parts, one for each value of a column. Then a commit names a folder for
each part, and replacing some parts names the others' folders again: their files stay untouched.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parvis.staging import hadoop_path

COMMITS, VERSION, PART = "_commits", "version-", "part"


def _numbers(spark: SparkSession, path: str) -> list[str]:
    fs, pattern = hadoop_path(spark, f"{path.rstrip('/')}/{COMMITS}/[0-9]*")
    return sorted(s.getPath().getName() for s in fs.globStatus(pattern) or [])


def _named(spark: SparkSession, path: str, number: str) -> list[str]:
    fs, file = hadoop_path(spark, f"{path.rstrip('/')}/{COMMITS}/{number}")
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode().splitlines()
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> list[str]:
    """The folders of the table's last committed state; none if it was never committed."""
    numbers, path = _numbers(spark, path), path.rstrip("/")
    return [f"{path}/{name}" for name in _named(spark, path, numbers[-1])] if numbers else []


def _write(df: DataFrame, path: str) -> str:
    name = f"{VERSION}{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    return name


def _prepare(spark: SparkSession, path: str, name: str) -> str:
    """The commit's file, under a name that no reader looks for."""
    waiting = f"{path}/{COMMITS}/.{uuid.uuid4().hex}"
    fs, file = hadoop_path(spark, waiting)
    stream = fs.create(file)
    stream.write(bytearray(name.encode()))
    stream.close()
    return waiting


def _publish(spark: SparkSession, path: str, waiting: str, number: int) -> None:
    fs, file = hadoop_path(spark, waiting)
    target = hadoop_path(spark, f"{path}/{COMMITS}/{number:020d}")[1]
    if fs.exists(target) or not fs.rename(file, target):
        fs.delete(file, False)
        raise OSError(f"another writer has replaced {path}")


def _clean(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the last ``keep`` states, their commits first, and what failed writers left."""
    numbers = _numbers(spark, path)
    fs, folder = hadoop_path(spark, path)
    for number in numbers[:-keep]:
        fs.delete(hadoop_path(spark, f"{path}/{COMMITS}/{number}")[1], False)
    kept = {name for n in numbers[-keep:] for name in _named(spark, path, n)}
    whole = {COMMITS, *[name.partition("/")[0] for name in kept]}
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name not in whole:
            fs.delete(status.getPath(), True)
        elif name != COMMITS and name not in kept:
            for part in fs.listStatus(status.getPath()):
                if f"{name}/{part.getPath().getName()}" not in kept:
                    fs.delete(part.getPath(), True)


def replace(df: DataFrame, path: str, keep: int = 2) -> None:
    """Make ``df`` the table at ``path``; a job that fails leaves the old table as it was.

    The last ``keep`` states stay, for readers that have begun with them. One writer at a time: of
    two that commit at once, one raises an error.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    numbers = _numbers(spark, path)
    _commit(spark, path, numbers, [_write(df, path)], keep)


def _commit(spark: SparkSession, path: str, numbers: list[str], names: list[str], keep: int
            ) -> None:
    waiting = _prepare(spark, path, "\n".join(names))
    _publish(spark, path, waiting, int(numbers[-1]) + 1 if numbers else 1)
    _clean(spark, path, keep)


def _write_parts(df: DataFrame, path: str, column: str) -> list[str]:
    """The folders of the parts of ``df``, written in one job."""
    spark, name = df.sparkSession, f"{VERSION}{uuid.uuid4().hex}"
    df.withColumn(PART, F.col(column)).write.partitionBy(PART).parquet(f"{path}/{name}")
    fs, pattern = hadoop_path(spark, f"{path}/{name}/{PART}=*")
    return [f"{name}/{s.getPath().getName()}" for s in fs.globStatus(pattern) or []]


def replace_parts(df: DataFrame, path: str, column: str, values: Iterable[int] | None = None,
                  keep: int = 2) -> None:
    """Make the rows of ``df`` with these values of a whole-number ``column`` the table's parts.

    The parts of other values stay as they are, to the file; a value without rows in ``df`` has no
    part afterwards. Without ``values`` all parts are replaced, as by :func:`replace`. Raises if
    single parts are to be replaced in a table that was not written by parts.
    """
    if PART in df.columns:
        raise ValueError(f"a table written by parts has no column {PART!r} of its own")
    spark, path = df.sparkSession, path.rstrip("/")
    numbers = _numbers(spark, path)
    old = []
    if values is not None:
        values = list(values)
        df = df.filter(F.col(column).isin(values))
        old = _named(spark, path, numbers[-1]) if numbers else []
        if any(f"/{PART}=" not in name for name in old if not name.startswith(f"{VERSION}empty")):
            raise ValueError(f"{path} is not written by parts")
    gone = {f"{PART}={v}" for v in values or ()}
    names = [n for n in old if "/" in n and n.rpartition("/")[2] not in gone]
    names += _write_parts(df, path, column)
    if not names:
        names = [f"{VERSION}empty-{uuid.uuid4().hex}"]
        df.limit(0).write.parquet(f"{path}/{names[0]}")
    _commit(spark, path, numbers, names, keep)

"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator on texts needs, under fixed names."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"))


def partitions_for(rows: int, each: int, least: int = 1) -> int:
    return max(least, math.ceil(rows / each))


BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches of the session end at ``BATCH_BYTES``, unless it has a bound of its own.

    Spark's own bounds are 10 000 rows and 64 MB. A batch lies in the JVM outside its heap and in the
    worker, and what comes of it in both again, for each task of an executor.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is None:
        spark.conf.set(bound, BATCH_BYTES)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the session's Python workers import this package, wherever they run; once a session."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    handle, path = tempfile.mkstemp(prefix=f"{package.name}-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)

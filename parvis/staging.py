"""Intermediate results as written tables.

A staged table cuts the lineage, survives the loss of executors, and has an exact size, so
the planner broadcasts it when it is below ``spark.sql.autoBroadcastJoinThreshold`` and
shuffles it otherwise. No operator of this package forces a broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from parvis.session import scratch_dir


_scopes: list[list[str]] = []


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder; never reused, so nothing is overwritten."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` of the store that holds ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Staged tables made inside are removed at the end; write what reads them before that."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            fs, where = hadoop_path(spark, path)
            fs.delete(where, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return it read back from the written files."""
    spark = df.sparkSession
    path = new_scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

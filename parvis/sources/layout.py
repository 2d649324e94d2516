"""Where tables live, which snapshot is read, and how results are written.

Every landed or derived table is a directory ``root/layer/source`` partitioned by the single
column ``ingestion_date``. The date is deliberately not split into year, month and day: those
names belong to the facts, and a partition column of the same name would replace them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parvis.sources import versions
from parvis.staging import hadoop_path

INGESTION = "ingestion_date"


def table_path(root: str, layer: str, source: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{source}"


def stamp(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn(INGESTION, F.lit(day))


def write_partitioned(df: DataFrame, path: str, *partitions: str) -> None:
    """Snappy Parquet; only the partitions present in ``df`` are replaced."""
    columns = [c for c in df.columns if c not in partitions]
    (df.select(*columns, *partitions).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
       .partitionBy(*partitions).parquet(path))


def write_snapshot(df: DataFrame, path: str, day: str, *more: str) -> None:
    """One day's rows, replacing that day; without rows the day is written as an empty file.

    ``more`` are partition columns below the day.
    """
    write_partitioned(stamp(df, day), path, INGESTION, *more)
    spark = df.sparkSession
    if (day,) not in partitions(spark, path, INGESTION):
        below = "/".join([f"{INGESTION}={day}", *[f"{c}={NO_VALUE}" for c in more]])
        df.drop(*more).limit(0).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{path}/{below}")


def create_or_replace(df: DataFrame, path: str) -> None:
    """Full replacement of a table, by one commit; see :mod:`parvis.sources.versions`."""
    versions.replace(df, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A written table in its last state; the ingestion date is text, as it was written."""
    df = spark.read.parquet(*versions.current(spark, path) or [path])
    return df.withColumn(INGESTION, F.col(INGESTION).cast("string")) \
        if INGESTION in df.columns else df


def partitions(spark: SparkSession, path: str, *columns: str) -> list[tuple[str, ...]]:
    """The values of the partition columns of a table, from its folders' names alone."""
    fs, pattern = hadoop_path(spark, "/".join([path.rstrip("/"), *[f"{c}=*" for c in columns]]))
    found = []
    for status in fs.globStatus(pattern) or []:
        parts = status.getPath().toString().split("/")[-len(columns):]
        found.append(tuple(unquote(p.partition("=")[2]) for p in parts))
    return sorted(found)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def read_latest(spark: SparkSession, path: str, *within: str, stamp: str = INGESTION) -> DataFrame:
    """The rows of the last snapshot, or of the last one for each value of ``within``.

    ``within`` are partition columns below ``stamp``. The last days are read from the folders'
    names, so the filter is constant and no other snapshot's file is opened.
    """
    df = read_table(spark, path)
    last: dict[tuple[str, ...], str] = {}
    for day, *values in partitions(spark, path, stamp, *within):
        last[tuple(values)] = max(day, last.get(tuple(values), day))
    wanted = F.lit(False)
    for values, day in last.items():
        hit = F.col(stamp) == F.lit(day)
        for c, v in zip(within, values, strict=True):
            hit &= F.col(c).isNull() if v == NO_VALUE else F.col(c) == F.lit(v).cast(
                df.schema[c].dataType)
        wanted |= hit
    return df.filter(wanted)


LAYERS = ("raw", "silver", "gold")


def tables(spark: SparkSession, root: str, layers: tuple[str, ...] = LAYERS
           ) -> Iterator[tuple[str, str, DataFrame]]:
    """``(layer, source, table)`` of every table under ``root``."""
    for layer in layers:
        fs, pattern = hadoop_path(spark, f"{root.rstrip('/')}/{layer}/*")
        for status in fs.globStatus(pattern) or []:
            name = status.getPath().getName()
            yield layer, name, read_table(spark, table_path(root, layer, name))


def inventory(spark: SparkSession, root: str, layers: tuple[str, ...] = LAYERS) -> DataFrame:
    """(layer, source, n_files, n_rows) of every table under ``root``."""
    found = [partition_inventory(df, name).select(F.lit(layer).alias("layer"), "*")
             for layer, name, df in tables(spark, root, layers)]
    if not found:
        return spark.createDataFrame([], "layer string, source string, n_files long, n_rows long")
    return reduce(lambda a, b: a.unionByName(b), found)


def partition_inventory(df: DataFrame, source: str) -> DataFrame:
    """(source, n_files, n_rows) of a file-backed table: counts per file, then per source."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"))
    return per_file.agg(F.count(F.lit(1)).alias("n_files"), F.sum("rows").alias("n_rows")).select(
        F.lit(source).alias("source"), "n_files", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))

"""Filtered, sorted and paged slices."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from parvis.constants import PAGE_SIZE


def keep_if(df: DataFrame, *conditions: Column | None) -> DataFrame:
    """Rows meeting all given conditions; None stands for a filter not asked for."""
    asked = [c for c in conditions if c is not None]
    return df.filter(reduce(lambda a, b: a & b, asked)) if asked else df


def equal(name: str, value) -> Column | None:
    """Equality filter; an empty or missing value does not filter."""
    return F.col(name) == value if value else None


def at_least(name: str, value) -> Column | None:
    return F.col(name) >= value if value is not None else None


def at_most(name: str, value) -> Column | None:
    return F.col(name) <= value if value is not None else None


def page_size(size: int | None) -> int:
    """The size asked for, or the default; a page never has fewer rows without notice."""
    if size is None:
        return PAGE_SIZE
    if size < 1:
        raise ValueError("a page has at least one row")
    return size


def page_slice(df: DataFrame, order: list[Column], page: int = 1,
               size: int | None = None) -> DataFrame:
    """Page ``page`` (from 1) of the sorted rows; for deep pages use :func:`page_after`."""
    if page < 1:
        raise ValueError("pages are numbered from 1")
    size = page_size(size)
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def page_after(df: DataFrame, keys: list[str], last: list, size: int | None = None) -> DataFrame:
    """The page that follows the row with key ``last``, in ascending key order.

    It costs the same for any depth, as the filter skips what an offset would sort and drop.
    """
    beyond = F.lit(False)
    tied = F.lit(True)
    for name, value in zip(keys, last, strict=True):
        beyond = beyond | (tied & (F.col(name) > F.lit(value)))
        tied = tied & (F.col(name) == F.lit(value))
    return df.filter(beyond).orderBy(*keys).limit(page_size(size))


def write_pages(df: DataFrame, keys: list[str], path: str, slices: int = 200) -> None:
    """Write ``df`` to the new folder ``path`` in slices of its order, with their sizes.

    The order is ascending by ``keys``, then by the other columns, so a frequent key is cut too.
    Slices come from Spark's range partitioning, which samples the rows.
    """
    order = list(dict.fromkeys([*keys, *df.columns]))
    placed = df.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    placed.withColumn("_slice", F.spark_partition_id()).write.partitionBy("_slice").parquet(
        f"{path}/rows")
    spark = df.sparkSession
    (_slices(spark, path, df.schema).groupBy("_slice").agg(F.count(F.lit(1)).alias("size"))
     .coalesce(1).write.json(f"{path}/sizes"))
    spark.createDataFrame([(order, df.schema.json())], ABOUT).coalesce(1).write.json(
        f"{path}/about")


ABOUT = "columns array<string>, fields string"


def _slices(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    with_slice = StructType([*schema.fields, StructField("_slice", IntegerType())])
    return spark.read.schema(with_slice).parquet(f"{path}/rows")


def read_page(spark: SparkSession, path: str, page: int = 1, size: int | None = None) -> DataFrame:
    """Page ``page`` (from 1) of a table by :func:`write_pages`.

    Only the slices that hold its rows are read and sorted, however deep it lies.
    """
    if page < 1:
        raise ValueError("pages are numbered from 1")
    size = page_size(size)
    low = (page - 1) * size
    sizes = spark.read.schema("_slice int, size long").json(f"{path}/sizes")
    upto = F.sum("size").over(Window.orderBy("_slice"))
    holding = sizes.withColumn("upto", upto).filter(
        (F.col("upto") > low) & (F.col("upto") - F.col("size") < low + size))
    held = holding.orderBy("_slice").collect()  # one row for each slice of the page
    about = spark.read.schema(ABOUT).json(f"{path}/about").first()
    schema = StructType.fromJson(json.loads(about["fields"]))
    rows = _slices(spark, path, schema).filter(F.col("_slice").isin([r["_slice"] for r in held]))
    skip = low - (held[0]["upto"] - held[0]["size"]) if held else 0
    return rows.drop("_slice").orderBy(*about["columns"]).offset(skip).limit(size)


def page_meta(df: DataFrame, page: int = 1, size: int | None = None) -> DataFrame:
    """One row: page, page_size, total, pages, next_page, prev_page."""
    size = page_size(size)
    this = F.lit(page).cast("long")
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        this.alias("page"), F.lit(size).cast("long").alias("page_size"), "total",
        F.ceil(F.col("total") / F.lit(float(size))).cast("long").alias("pages"),
    ).select(
        "*", F.when(this < F.col("pages"), this + 1).alias("next_page"),
        (F.when(this > 1, this - 1) if page > 1 else F.lit(None).cast("long")).alias("prev_page"))

"""Window results on groups of any size.

A Spark window sorts a whole partition key in one task. Where one group may hold a third of
the table, the rows are cut into ordered parts and the window runs per part. What a part has
to know of the earlier ones is one extra row, added before the window and removed after it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parvis.operators.ordering import ordered_bucket, same
from parvis.operators.quantiles import grouped_quantiles
from parvis.staging import stage


def _matches(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [same(F.col(k), F.col(f"_k_{k}")) for k in keys])


def _prefixed(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_k_{k}") for k in keys]


def median_over(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The exact group median on every row."""
    return with_group(df, group_medians(df, keys, value, name), keys)


def group_medians(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """One written row per group; with its size known, a few are broadcast to the rows."""
    return stage(grouped_quantiles(df, keys, value, {name: 0.5}), "group-medians")


def with_group(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the other columns of its row in ``groups``; null keys match."""
    added = [c for c in groups.columns if c not in keys]
    return df.join(groups.select(*_prefixed(keys), *added), _matches(keys), "left").drop(
        *[f"_k_{k}" for k in keys])


def lag_delta(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str],
              name: str) -> DataFrame:
    """``value`` less the previous row's value within ``keys``, in the order of ``order``.

    Rows that tie follow their other columns, so the order is total up to exact copies; the first
    of these steps from the row before, the others from a copy of themselves. Where ``order``
    holds ``value``, rows that tie have the same value, and only keys and order are sorted:
    see :func:`lag_steps`. Otherwise the distinct rows are sorted with all their columns.
    """
    if value in order:
        return with_steps(df, lag_steps(df, keys, value, order, name), keys, value, order, name)
    total = list(dict.fromkeys([*keys, *order, *df.columns]))
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    stepped = _steps(distinct, keys, value, total, "_step")
    return stepped.withColumn("_nth", F.explode(F.sequence(F.lit(1), "_copies"))).select(
        *df.columns,
        F.when(F.col("_nth") == 1, F.col("_step")).otherwise(F.col(value) - F.col(value))
        .alias(name))


def _steps(distinct: DataFrame, keys: Sequence[str], value: str, total: Sequence[str],
           name: str) -> DataFrame:
    """``distinct`` with the step of each row from the one before it in ``keys``.

    Rows are range-partitioned by keys and order, so a partition is even whatever the keys,
    and written with its number; the last row of each goes before the first of the next.
    """
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(distinct.repartitionByRange(parts, *total).withColumn(
        "_part", F.spark_partition_id()), "ordered-rows")
    held = list(dict.fromkeys([*keys, value]))
    tails = placed.groupBy("_part").agg(F.max_by(
        F.struct(*held), F.struct(*total)).alias("_tail"))
    before = tails.select(
        F.lead("_part").over(Window.orderBy("_part")).alias("_part"),
        *[F.col(f"_tail.{c}").alias(c) for c in held], F.lit(False).alias("_real"),
    ).filter("_part IS NOT NULL")
    inside = Window.partitionBy("_part").orderBy("_real", *total)
    previous = reduce(lambda a, b: a & b, [
        same(F.col(k), F.lag(k).over(inside)) for k in keys], F.row_number().over(inside) > 1)
    return (
        placed.withColumn("_real", F.lit(True)).unionByName(before, allowMissingColumns=True)
        .withColumn(name, F.when(previous, F.col(value) - F.lag(value).over(inside)))
        .filter("_real").drop("_real", "_part"))


def lag_steps(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str],
              name: str) -> DataFrame:
    """One row for each distinct ``keys`` and ``order``: its step ``name`` and ``_ties``, its rows.

    ``order`` holds ``value``. No other column of ``df`` is read.
    """
    total = list(dict.fromkeys([*keys, *order]))
    counted = df.groupBy(*total).agg(F.count(F.lit(1)).alias("_ties"))
    return _steps(counted, keys, value, total, name)


BLOCK = 1 << 16  # copies of a row made from one array


def with_steps(df: DataFrame, steps: DataFrame, keys: Sequence[str], value: str,
               order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name`` and any further column of ``steps`` (from :func:`lag_steps`).

    The rows are joined once. Of rows that tie, the one with the least other columns has the
    step; if it has copies, they are made anew from their number, one of them with the step.
    """
    total = list(dict.fromkeys([*keys, *order]))
    rest = [c for c in df.columns if c not in total]
    more = [c for c in steps.columns if c not in {*total, *rest, name, "_ties"}]
    steps = stage(steps, "steps")
    ties = stage(steps.filter("_ties > 1").select(*_prefixed(total)), "ties")
    own = F.struct(F.lit(0).alias("_"), *rest)
    nothing = F.col(value) - F.col(value)
    columns = [*[F.col(f"_k_{c}" if c in total else f"_r_{c}").alias(c) for c in df.columns],
               *more]
    right = steps.select(*_prefixed(total), *more, name, "_ties")
    if ties.isEmpty():
        return df.join(right, _matches(total)).select(*df.columns, *more, name)
    tied = df.join(ties, _matches(total)).groupBy(*df.columns).agg(
        F.count(F.lit(1)).alias("_copies"))
    least = stage(tied.groupBy(*total).agg(F.min(F.struct(own.alias("_first"), "_copies"))
                                           .alias("_least")), "least-ties")
    firsts = least.join(right, _matches(total)).select(
        *_prefixed(total), F.col("_least._first").alias("_first"),
        F.col("_least._copies").alias("_copies"), *more, name)
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / BLOCK)))
    flat = firsts.select("*", *[F.col(f"_first.{c}").alias(f"_r_{c}") for c in rest]).drop("_first")
    again = flat.withColumn("_block", blocks).withColumn("_nth", F.explode(F.sequence(
        F.col("_block") * BLOCK + 1, F.least("_copies", (F.col("_block") + 1) * BLOCK))))
    value_again = F.col(f"_k_{value}")
    made = again.select(*columns, F.when(F.col("_nth") == 1, F.col(name)).otherwise(
        value_again - value_again).alias(name))
    marked = right.join(
        firsts.select(*[F.col(f"_k_{c}").alias(f"_f_{c}") for c in total], "_first"),
        reduce(lambda a, b: a & b, [same(F.col(f"_k_{c}"), F.col(f"_f_{c}")) for c in total]),
        "left")
    others = df.join(marked, _matches(total)).filter(
        F.col("_first").isNull() | ~same(F.col("_first"), own))
    return others.select(
        *df.columns, *more,
        F.when(F.col("_ties") == 1, F.col(name)).otherwise(nothing).alias(name)).unionByName(made)


def dense_rank_desc(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Dense rank of ``value`` within ``keys``, largest first; a null value has no rank.

    Ranks are worked out on the distinct values, so repeats are combined before any shuffle.
    Each ordered bucket ranks its own values and adds the number of values in higher buckets.
    Joining the ranks back, a frequent value is left to the adaptive skew-join split.
    """
    part = [*keys, "_bucket"]
    distinct = df.filter(F.col(value).isNotNull()).select(
        *keys, value, ordered_bucket(F.col(value), 1).alias("_bucket")).distinct()
    above = Window.partitionBy(*keys).orderBy(F.col("_bucket").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    higher = distinct.groupBy(*part).agg(F.count(F.lit(1)).alias("_size")).select(
        *part, F.coalesce(F.sum("_size").over(above), F.lit(0)).alias("_higher"))

    bucket = Window.partitionBy(*part)
    ranks = (
        distinct.unionByName(higher, allowMissingColumns=True)
        .withColumn(name, F.dense_rank().over(bucket.orderBy(F.col(value).desc_nulls_last()))
                    + F.max("_higher").over(bucket))
        .filter(F.col(value).isNotNull())
        .select(*_prefixed([*keys, value]), name)
    )
    on = _matches(keys) & (F.col(value) == F.col(f"_k_{value}"))
    return df.join(ranks, on, "left").drop(*[f"_k_{k}" for k in [*keys, value]])

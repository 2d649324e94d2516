"""Exact interpolated quantiles per group, without holding a group in one task.

``percentile`` and ``median`` keep every distinct value of a group in the memory of one task,
which fails once a group holds a large share of the table. Here each group is narrowed down
instead: a histogram over ordered buckets (combined before its shuffle) tells which buckets
hold the wanted ranks; only the rows of those buckets are looked at again. A bucket that is
still too full is narrowed by the next, 4096 times finer histogram. The result is exact at
every size, and a scan is only repeated for the one column at hand.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parvis.operators.ordering import LEVELS, ordered_bucket, same
from parvis.staging import stage


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    sums: Mapping[str, str] | None = None,
    count: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One row per group: ``keys``, the quantiles, and on request row count and sums.

    ``quantiles`` maps output names to probabilities, ``sums`` output names to columns, which
    ride along in the first histogram. Null values count as rows but not in the quantiles.
    The narrowing levels run as jobs of their own; the returned frame is the last, lazy step.
    Narrowing ends where no bucket holds more than its share of all rows among ``partitions``
    tasks, by default those of a shuffle. NaN counts as the largest value.
    """
    keys = list(keys)
    sums = dict(sums or {})
    columns = list(dict.fromkeys([*keys, value, *sums.values()]))
    rows = df.select(*columns)

    totals = {"_rows": F.count(F.lit(1)), "_n": F.count(value),
              **{f"_sum_{out}": F.sum(c) for out, c in sums.items()}}
    histogram = rows.groupBy(*keys, ordered_bucket(F.col(value), 0).alias("_bucket")).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"),
        *[agg.alias(name) for name, agg in totals.items()])
    by_group = Window.partitionBy(*keys)
    running = by_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    located = (
        histogram.withColumn("_count", F.col("_n"))
        .withColumn("_after", F.sum("_n").over(running))
        .select(
            *keys, "_bucket", "_low", "_high", "_count",
            (F.col("_after") - F.col("_count")).alias("_before"),
            *[F.sum(name).over(by_group).alias(name) for name in totals])
    )
    ranks = _ranks(quantiles.values())
    hits = stage(
        located.filter((F.col("_n") == 0) | _holds(ranks, "_before", "_count")), "quantile-hits")
    narrowed = hits.filter(F.col("_n") > 0).select(
        *keys, "_bucket", "_low", "_high", "_before", "_count", "_n")
    level = 0
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while level + 1 < len(LEVELS) and _crowded(hits, narrowed, keys, partitions):
        narrowed = stage(_narrow(rows, narrowed, keys, value, level, ranks), "quantile-hits")
        level += 1
    # Rows with the totals and rows with the values found fold into one row per group.
    found = _resolve(rows, narrowed, keys, value, level, ranks)
    known = hits.select(*keys, *totals).unionByName(found, allowMissingColumns=True)
    group = known.groupBy(*keys).agg(*[F.max(c).alias(c) for c in known.columns if c not in keys])
    return group.select(
        *keys, *[_interpolated(i, q).alias(name) for i, (name, q) in enumerate(quantiles.items())],
        *([F.col("_rows").alias(count)] if count else []),
        *[F.col(f"_sum_{out}").alias(out) for out in sums])


def _ranks(probabilities) -> list[tuple[Column, Column]]:
    """Zero-based lower and upper rank of each probability, from the group size ``_n``."""
    positions = [(F.col("_n") - 1) * F.lit(float(q)) for q in probabilities]
    return [(F.floor(p), F.ceil(p)) for p in positions]


def _holds(ranks: list[tuple[Column, Column]], before: str, count: str) -> Column:
    """Whether the ranks ``before`` to ``before + count - 1`` include a wanted one."""
    start, end = F.col(before), F.col(before) + F.col(count)
    return reduce(lambda a, b: a | b, [
        (rank >= start) & (rank < end) for pair in ranks for rank in pair])


def _crowded(hits: DataFrame, narrowed: DataFrame, keys: list[str], partitions: int) -> bool:
    """Whether a bucket of different values is above one task's share of all rows."""
    every = hits.groupBy(*keys).agg(F.max("_n").alias("_n")).agg(F.sum("_n")).scalar()
    full = narrowed.filter((F.col("_low") < F.col("_high"))
                           & (F.col("_count") * partitions > every))
    return not full.isEmpty()


def _on(keys: Sequence[str], *more: Column) -> Column:
    return reduce(lambda a, b: a & b, [*[same(F.col(k), F.col(f"_k_{k}")) for k in keys], *more])


def _inside(rows: DataFrame, hits: DataFrame, keys: list[str], value: str,
            level: int) -> DataFrame:
    """The rows whose bucket at ``level`` is among the hits, with that hit's columns."""
    wanted = hits.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], "_bucket",
        F.col("_before").alias("_base"), "_n")
    at = ordered_bucket(F.col(value), level)
    return rows.select(*keys, value, at.alias("_at")).join(
        wanted, _on(keys, F.col("_at") == F.col("_bucket"))
    ).select(*keys, value, "_bucket", "_base", "_n")


def _narrow(rows: DataFrame, hits: DataFrame, keys: list[str], value: str, level: int,
            ranks: list[tuple[Column, Column]]) -> DataFrame:
    finer = _inside(rows, hits, keys, value, level).groupBy(
        *keys, "_bucket", "_base", "_n",
        ordered_bucket(F.col(value), level + 1).alias("_finer"),
    ).agg(F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(value).alias("_count"))
    running = Window.partitionBy(*keys, "_bucket").orderBy("_finer").rowsBetween(
        Window.unboundedPreceding, 0)
    return (
        finer.withColumn("_before", F.col("_base") + F.sum("_count").over(running)
                         - F.col("_count"))
        .filter(_holds(ranks, "_before", "_count"))
        .select(*keys, F.col("_finer").alias("_bucket"), "_low", "_high", "_before", "_count",
                "_n")
    )


def _resolve(rows: DataFrame, hits: DataFrame, keys: list[str], value: str, level: int,
             ranks: list[tuple[Column, Column]]) -> DataFrame:
    """For each distinct value inside the hits, the wanted ranks it holds."""
    repeats = _inside(rows, hits, keys, value, level).groupBy(
        *keys, "_bucket", "_base", "_n", value).agg(F.count(F.lit(1)).alias("_count"))
    running = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(
        Window.unboundedPreceding, 0)
    placed = repeats.withColumn(
        "_before", F.col("_base") + F.sum("_count").over(running) - F.col("_count"))
    at = F.col("_before")
    holds = lambda rank: (rank >= at) & (rank < at + F.col("_count"))
    return placed.select(*keys, *[
        F.when(holds(rank), F.col(value).cast("double")).alias(f"_{side}{i}")
        for i, pair in enumerate(ranks) for side, rank in zip("lh", pair, strict=True)])


def _interpolated(i: int, q: float) -> Column:
    """Linear interpolation between the values at the lower and the upper rank."""
    position = (F.col("_n") - 1) * F.lit(float(q))
    low, high = F.col(f"_l{i}"), F.col(f"_h{i}")
    fraction = position - F.floor(position)
    return low * (F.lit(1.0) - fraction) + high * fraction

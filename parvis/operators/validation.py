"""Ordered validation rules: filtering and a one-pass rejection report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Rules = Mapping[str, Column]


def present(name: str) -> Column:
    return F.col(name).isNotNull()


def above(name: str, threshold: float) -> Column:
    """Present, a number, and strictly greater than ``threshold``; Spark orders NaN above all."""
    return F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double")) & (
        F.col(name) > threshold)


def within(name: str, bounds: tuple[float, float]) -> Column:
    """Closed range."""
    return F.col(name).between(*bounds)


def in_box(lon: str, lat: str, lon_range: tuple[float, float],
           lat_range: tuple[float, float]) -> Column:
    return within(lon, lon_range) & within(lat, lat_range)


def one_of(name: str, values: Sequence[str]) -> Column:
    return F.col(name).isin(list(values))


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that pass every rule; an undecided (null) rule rejects."""
    return df.filter(reduce(lambda a, b: a & b, rules.values()))


def _counts(rules: Rules) -> list[Column]:
    """How many rows there are, and how many each rule is the first to reject."""
    passed = [F.coalesce(p, F.lit(False)) for p in rules.values()]
    first_failure = F.coalesce(
        *[F.when(~ok, F.lit(i)) for i, ok in enumerate(passed)], F.lit(len(passed)))
    return [F.count(F.lit(1)).alias("total"),
            *[F.count_if(first_failure == i).alias(f"r{i}") for i in range(len(passed))]]


def _report(counts: DataFrame, rules: Rules) -> DataFrame:
    lines = []
    kept = F.col("total")
    for i, name in enumerate(rules):
        kept = kept - F.col(f"r{i}")
        lines.append(F.struct(
            F.lit(i + 1).cast("long").alias("position"), F.lit(name).alias("rule"),
            F.col(f"r{i}").alias("rejected"), kept.alias("kept")))
    return counts.select(F.inline(F.array(*lines)))


def validation_report(df: DataFrame, rules: Rules) -> DataFrame:
    """(position, rule, rejected, kept) per rule, a row counting at its first failing rule.

    One aggregate over the data: every rule becomes a conditional count, and the kept column
    is the total less the counts so far. Only the finished one-row result is unpivoted.
    """
    return _report(df.agg(*_counts(rules)), rules)


def keep_valid_observed(df: DataFrame, rules: Rules, seen: Observation) -> DataFrame:
    """:func:`keep_valid`, and ``seen`` counts what each rule rejects as the kept rows are read.

    The first action on the result fills ``seen``, so the rows are scanned once for both. Write or
    stage the result; a limit would end the scan, and the counts, early.
    """
    return keep_valid(df.observe(seen, *_counts(rules)), rules)


def observed_report(spark: SparkSession, seen: Observation, rules: Rules) -> DataFrame:
    """The report of :func:`validation_report` from a filled observation; waits for the action."""
    names = ["total", *[f"r{i}" for i in range(len(rules))]]
    found = seen.get
    counts = spark.createDataFrame([[found[n] for n in names]],
                                   ", ".join(f"{n} long" for n in names))
    return _report(counts, rules)

"""Row-wise folds, column choice by name, wide to long, replication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parvis.constants import NAME_ALIASES


def row_sum(names: Sequence[str]) -> Column:
    """Sum across columns, null counting as zero."""
    total = F.lit(0.0)
    for name in names:
        total = total + F.coalesce(F.col(f"`{name}`"), F.lit(0.0))
    return total


def row_mean(names: Sequence[str]) -> Column:
    """That sum over the number of columns, so a null pulls the mean down."""
    return row_sum(names) / F.lit(float(len(names)))


def column_containing(columns: Sequence[str], *tokens: str) -> str | None:
    """First column whose name contains one of the tokens, ignoring case."""
    return next((c for c in columns if any(t in c.lower() for t in tokens)), None)


def column_named(columns: Sequence[str], *names: str) -> str | None:
    """First column whose name is one of ``names``, ignoring case."""
    return next((c for c in columns if c.lower() in names), None)


def name_column(columns: Sequence[str]) -> str | None:
    return column_named(columns, *NAME_ALIASES)


def columns_with_prefix(df: DataFrame, prefixes: Sequence[str], always: Sequence[str]) -> DataFrame:
    """Columns whose name starts with a prefix, and the ``always`` ones, in table order."""
    kept = [c for c in df.columns if c.startswith(tuple(prefixes)) or c in always]
    return df.select(*[F.col(f"`{c}`") for c in kept])


def with_default(df: DataFrame, name: str, value: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(value))


def fan_out(df: DataFrame, name: str, values: Sequence[str]) -> DataFrame:
    """Each row once per value, generated in place without a join."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def zscore(df: DataFrame, name: str) -> Column:
    """Distance from the column's mean in sample deviations, null when it does not vary.

    The two statistics come from a scalar subquery, which combines before it gathers; a
    window over everything would pull all rows into one task.
    """
    mean = df.select(F.avg(name)).scalar()
    deviation = df.select(F.stddev_samp(name)).scalar()
    return (F.col(name) - mean) / F.nullif(deviation, F.lit(0.0))

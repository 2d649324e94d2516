"""Order-preserving buckets, the basis of quantiles and ranks on groups of any size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slices per doubling of |value|; each level divides a slice of the one before by 4096.
# The first is coarse, so that a histogram stays small next to groups of a few hundred rows.
LEVELS = (2.0**4, 2.0**16, 2.0**28, 2.0**40)
SMALLEST = 1100.0  # above the negated binary logarithm of any double
LAST = 2**63 - 1


def ordered_bucket(value: Column, level: int) -> Column:
    """A whole number that never decreases as ``value`` grows.

    It depends on the value alone, so recomputed tasks always agree, and its width is
    relative at every magnitude, so no range has to be known. NaN is above all numbers.
    """
    number = value.cast("double")
    size = (F.log2(F.abs(number)) + F.lit(SMALLEST)) * F.lit(LEVELS[level])
    return (F.when(F.isnan(number), F.lit(LAST)).when(number == 0, F.lit(0).cast("long"))
            .otherwise(F.floor(F.signum(number) * size)))


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)

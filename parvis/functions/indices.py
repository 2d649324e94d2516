"""The guarded ratios behind the composite indicators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE_DWELLING_M2 = 50.0


def unit_price(value: Column, surface: Column) -> Column:
    return value / F.nullif(surface, F.lit(0.0))


def affordability(income: Column, price: Column) -> Column:
    """Income over the price of a reference dwelling; null without a price."""
    return income / F.nullif(price * REFERENCE_DWELLING_M2, F.lit(0.0))


def per_capita(amount: Column, factor: float, base: Column) -> Column:
    """``amount`` per ``factor`` units of ``base``; null for an empty base."""
    return amount * F.lit(factor) / F.nullif(base.cast("double"), F.lit(0.0))


def tension(sales: Column, dwellings: Column) -> Column:
    return per_capita(sales, 1000.0, dwellings)


def social_effort(units: Column, population: Column) -> Column:
    return per_capita(F.coalesce(units, F.lit(0)), 10000.0, population)


def poi_density(counts: list[Column], population: Column) -> Column:
    """Points per 1000 inhabitants; zero, not null, for an empty area."""
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return F.when(population == 0, F.lit(0.0)).otherwise(per_capita(total, 1000.0, population))


def attractiveness(z_afford: Column, z_density: Column, z_social: Column,
                   z_tension: Column) -> Column:
    """Weighted sum of z-scores, a missing one counting as zero."""
    weights = [(z_afford, 0.30), (z_density, 0.40), (z_social, 0.15), (-z_tension, 0.15)]
    score = F.lit(0.0)
    for z, weight in weights:
        score = score + F.coalesce(z, F.lit(0.0)) * weight
    return score

"""Monthly facts and timeline kept up to date by year.

Both are stored by year. When sales of some years have landed, only the facts of these years are
worked out anew, from these years' sales, and only the years of the timeline that the new facts
reach. All other years keep their files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parvis.plans.gold import AREA, monthly_area_stats, timeline_area
from parvis.sources.layout import INGESTION, NO_VALUE, partitions, read_table
from parvis.sources.versions import replace_parts

YEAR = "year"
BEHIND = 2  # months of an area whose mean or step a month enters after its own


def landed_years(spark: SparkSession, raw_path: str, after: str, upto: str) -> list[int]:
    """The sale years that landed later than the day ``after``, from the folders' names alone."""
    found = partitions(spark, raw_path, INGESTION, "annee")
    return sorted({int(year) for day, year in found if after < day <= upto and year != NO_VALUE})


def refresh_facts(sales: DataFrame, path: str, years: Iterable[int] | None = None) -> None:
    """Replace the facts of ``years``, or all, by those of ``sales``; others' files stay.

    ``sales`` has to hold all sales of these years; years without sales have no facts afterwards.
    """
    if years is not None:
        years = list(years)
        sales = sales.filter(F.col(YEAR).isin(years))
    replace_parts(monthly_area_stats(sales), path, YEAR, years)


def reached_years(monthly: DataFrame, years: Iterable[int]) -> list[int]:
    """The years with a month that lies in ``years`` or at most two of its area's months behind.

    It is behind too where those months have gone. Few numbers are collected: years of sales.
    """
    series = Window.partitionBy(AREA).orderBy(YEAR, "month")
    first = F.lag(YEAR, BEHIND).over(series)
    reached = F.exists(F.array(*[F.lit(y) for y in years]), lambda y: (
        (y <= F.col(YEAR)) & (first.isNull() | (first <= y))))
    rows = monthly.select(YEAR, reached.alias("reached")).filter("reached").select(YEAR).distinct()
    return sorted(r[YEAR] for r in rows.collect())


def refresh_timeline(spark: SparkSession, facts_path: str, path: str,
                     years: Iterable[int] | None = None) -> list[int]:
    """Replace what new facts of ``years`` change in the timeline; the years that were replaced."""
    facts = read_table(spark, facts_path)
    if years is None:
        replace_parts(timeline_area(facts), path, YEAR)
        return []
    years = list(years)
    changed = sorted({*years, *reached_years(facts, years)}) if years else []
    if changed:
        replace_parts(timeline_area(facts), path, YEAR, changed)
    return changed

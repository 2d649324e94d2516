"""Fingerprints and invariants of finished tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parvis.constants import AREA_CODES, AREA_PREFIX, CATEGORIES, INDICATORS
from parvis.sources import layout

AREA = "code_arrondissement"
HEX_DIGITS = 15


def row_digest(df: DataFrame) -> Column:
    """A 60-bit number from the MD5 of a row's text form.

    Each text goes after its length, and a null is a mark of its own, so different rows have
    different forms.
    """
    text = [F.col(f"`{c}`").cast("string") for c in df.columns]
    texts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit("="), t), F.lit("-"))
             for t in text]
    digest = F.md5(F.concat(*texts).cast("binary"))
    return F.conv(F.left(digest, F.lit(HEX_DIGITS)), 16, 10).cast("long")


def table_fingerprint(df: DataFrame, name: str) -> DataFrame:
    """(table_name, row_count, digest) over all rows, whatever their order.

    The digest is a decimal sum, so equal rows do not cancel out and nothing is sorted.
    """
    rows = df.select(row_digest(df).alias("digest"))
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest"),
    ).select(F.lit(name).alias("table_name"), "row_count",
             F.coalesce("digest", F.lit("0")).alias("digest"))


def merge_fingerprints(parts: DataFrame) -> DataFrame:
    """The fingerprint of a whole table from those of its parts, as of single days.

    Counts and digests are sums, so a new day adds its own and no old row is read again.
    """
    return parts.groupBy("table_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest"))


def table_manifest(df: DataFrame, layer: str, source: str) -> DataFrame:
    """(layer, source, n_files, n_rows, digest) of a file-backed table, from one scan.

    Files are counted by their rows, so an empty file is not counted.
    """
    per_file = df.select(
        F.col("_metadata.file_path").alias("file"),
        row_digest(df).cast("decimal(38,0)").alias("digest")).groupBy("file").agg(
            F.count(F.lit(1)).alias("n"), F.sum("digest").alias("digest"))
    return per_file.agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("digest").cast("string"), F.lit("0")).alias("digest")).select(
            F.lit(layer).alias("layer"), F.lit(source).alias("source"), "n_files", "n_rows", "digest")


def run_manifest(spark: SparkSession, root: str, layers: tuple[str, ...] = layout.LAYERS
                 ) -> DataFrame:
    """:func:`table_manifest` of every table under ``root``: what a run has left behind."""
    found = [table_manifest(df, layer, source)
             for layer, source, df in layout.tables(spark, root, layers)]
    if not found:
        return spark.createDataFrame(
            [], "layer string, source string, n_files long, n_rows long, digest string")
    return reduce(lambda a, b: a.unionByName(b), found)


def _listed(one_row: DataFrame, names: list[str]) -> DataFrame:
    return one_row.unpivot([], names, "check", "failures")


def _missing(codes: list[str]) -> Column:
    """How many of ``codes`` no row has."""
    found = F.collect_set(F.when(F.col(AREA).isin(codes), F.col(AREA)))
    return (F.lit(len(codes)) - F.size(found)).cast("long")


def kpi_checks(kpi: DataFrame, codes: list[str] = AREA_CODES,
               price_range: tuple[float, float] = (5_000.0, 25_000.0)) -> DataFrame:
    """Count, absent areas, code pattern, missing indicators, centring and price range."""
    missing = F.col(INDICATORS[0]).isNull()
    for name in INDICATORS[1:]:
        missing = missing | F.col(name).isNull()
    code = F.col(AREA)
    price = F.col("prix_m2")
    mean = F.avg("idx_attractivite")
    checks = {
        "area_count": F.when(F.count(F.lit(1)) == len(codes), 0).otherwise(1).cast("long"),
        "areas_missing": _missing(codes),
        "code_pattern": F.count_if(~code.startswith(AREA_PREFIX) | (F.length(code) != 5)),
        "indicators_present": F.count_if(missing),
        "attractiveness_centred":
            F.when(F.abs(mean) < 0.05, 0).otherwise(1).cast("long"),
        "price_range": F.count_if((price < price_range[0]) | (price > price_range[1])),
    }
    return _listed(kpi.agg(*[c.alias(n) for n, c in checks.items()]), list(checks))


def timeline_checks(timeline: DataFrame, months: int = 72, codes: list[str] = AREA_CODES
                    ) -> DataFrame:
    """Areas without a series, and those whose series has not exactly the expected months."""
    per_area = timeline.groupBy(AREA).agg(F.count(F.lit(1)).alias("n"))
    return _listed(per_area.agg(
        _missing(codes).alias("timeline_areas_missing"),
        F.count_if(F.col("n") != months).alias("timeline_months")),
        ["timeline_areas_missing", "timeline_months"])


def poi_checks(counts: DataFrame) -> DataFrame:
    """Known categories that are absent, and categories that should not be there."""
    known = F.col("category").isin(CATEGORIES)
    present = counts.select("category").distinct()
    checks = {
        "categories_missing": F.lit(len(CATEGORIES)).cast("long") - F.count_if(known),
        "categories_unknown": F.count_if(~known),
    }
    return _listed(present.agg(*[c.alias(n) for n, c in checks.items()]), list(checks))


def quality_checks(kpi: DataFrame, timeline: DataFrame, counts: DataFrame,
                   codes: list[str] = AREA_CODES, months: int = 72,
                   price_range: tuple[float, float] = (5_000.0, 25_000.0)) -> DataFrame:
    """(check, failures) over the three tables; a healthy build has zeros only."""
    return kpi_checks(kpi, codes, price_range).unionByName(
        timeline_checks(timeline, months, codes)).unionByName(poi_checks(counts))

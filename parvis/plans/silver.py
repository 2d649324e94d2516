"""Cleaned tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parvis.constants import (
    DWELLING_TYPES, LAT_RANGE, LON_RANGE, MIN_SURFACE, POLLUTANTS, VALUE_RANGE,
)
from parvis.functions import geometry as G
from parvis.functions.casts import lenient, to_double, to_long
from parvis.functions.codes import (
    DIM_PRECEDENCE, JOIN_PRECEDENCE, area_label, extract_area_number, resolve_area_code,
)
from parvis.functions.coordinates import extract_lon_lat
from parvis.functions.indices import unit_price
from parvis.operators import rows as R
from parvis.operators import validation as V
from parvis.operators.spatial import spatial_join
from parvis.operators.windows import (
    dense_rank_desc, group_medians, lag_steps, with_group, with_steps,
)
from parvis.sources import schemas
from parvis.sources.layout import stamp
from parvis.staging import stage

log = logging.getLogger(__name__)

TRANSACTION_TYPES = {"date_mutation": "date", **schemas.TRANSACTION_NUMBERS}
# A total order: rows that tie on all of it have the same price.
SALE_ORDER = ("date_mutation", "id_mutation", "numero_disposition", "prix_m2")


class SchemaMismatch(ValueError):
    """A landed table lacks a column the cleaning step needs."""


def transaction_rules() -> dict[str, Column]:
    return {
        "non_null_date": V.present("date_mutation"),
        "non_null_valeur": V.above("valeur_fonciere", 0),
        "non_null_surface": V.above("surface_reelle_bati", MIN_SURFACE),
        "valeur_realistic": V.within("valeur_fonciere", VALUE_RANGE),
        "geo_within_paris": V.in_box("longitude", "latitude", LON_RANGE, LAT_RANGE),
        "type_local_logement": V.one_of("type_local", DWELLING_TYPES),
    }


def typed_transactions(raw: DataFrame) -> DataFrame:
    return raw.withColumns({c: lenient(raw, c, t) for c, t in TRANSACTION_TYPES.items()})


def year_month_parts(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns({"year": F.year(date).cast("long"), "month": F.month(date).cast("long")})


def located_transactions(raw: DataFrame, areas: DataFrame, seen: Observation | None = None
                         ) -> DataFrame:
    """Valid sales with unit price, area code, year and month: one pass without a shuffle.

    With ``seen``, the first action also counts what each rule rejects, in the same pass.
    """
    typed, rules = typed_transactions(raw), transaction_rules()
    kept = V.keep_valid(typed, rules) if seen is None else V.keep_valid_observed(typed, rules, seen)
    valid = kept.withColumn(
        "prix_m2", unit_price(F.col("valeur_fonciere"), F.col("surface_reelle_bati")))
    placed = spatial_join(valid, areas, "longitude", "latitude")
    return year_month_parts(placed.filter(F.col("code_arrondissement").isNotNull()),
                            "date_mutation")


def silver_transactions(raw: DataFrame, areas: DataFrame, seen: Observation | None = None
                        ) -> DataFrame:
    """Valid, located sales with the area median, the month's price rank and the price step.

    The located sales are written once. Medians, steps and ranks are worked out from the columns
    they need alone, ranks from the rows of the steps, so all columns are joined once.
    """
    sales = stage(located_transactions(raw, areas, seen), "located-sales")
    medians = group_medians(sales, ["code_arrondissement"], "prix_m2", "prix_m2_median_arr")
    order = [c for c in SALE_ORDER if c in sales.columns]
    keys = ["code_arrondissement", "year"]
    steps = lag_steps(sales, keys, "prix_m2", order, "delta_prix_m2_vs_prev")
    ranks = dense_rank_desc(steps.withColumn("month", F.month("date_mutation").cast("long")),
                            ["year", "month"], "prix_m2", "rank_prix_m2_dans_mois").drop("month")
    ranked = with_steps(sales, ranks, keys, "prix_m2", order, "delta_prix_m2_vs_prev")
    return with_group(ranked, medians, ["code_arrondissement"])


def social_units(raw: DataFrame, passthrough: bool = False) -> DataFrame:
    """Financed social dwellings per area and year, whatever the columns are called.

    Without recognisable columns it raises :class:`SchemaMismatch`, or on request hands the
    raw rows on.
    """
    if "no_records" in raw.columns:
        return schemas.empty(raw.sparkSession, schemas.SOCIAL_UNITS)
    area = R.column_containing(raw.columns, "arrond")
    units = R.column_containing(raw.columns, "nombre", "logements")
    year = R.column_named(raw.columns, "annee", "year")
    if not (area and units and year):
        message = f"no area, unit or year column among {raw.columns}"
        if not passthrough:
            raise SchemaMismatch(message)
        log.error("social housing: %s; rows passed on as they are", message)
        return raw
    return (
        raw.select(
            extract_area_number(F.col(f"`{area}`")).alias("code_arrondissement"),
            to_long(F.col(f"`{year}`")).alias("year"),
            to_long(F.col(f"`{units}`")).alias("units"))
        .filter(F.col("code_arrondissement").isNotNull() & (F.col("units") > 0))
        .groupBy("code_arrondissement", "year")
        .agg(F.sum("units").alias("nb_logements_finances"))
    )


def silver_income(landed: DataFrame) -> DataFrame:
    """The income columns the indicators use, and the area code."""
    return R.columns_with_prefix(landed, ["MED", "PIMP"], ["code_arrondissement"])


def area_polygons(polygons: DataFrame, precedence: Sequence[str] = JOIN_PRECEDENCE) -> DataFrame:
    """(ord, code, parts) for the spatial join; an area without a code is left out."""
    return _with_code(polygons, precedence).filter(F.col("code").isNotNull()).select(
        "ord", "code", "parts")


def _with_code(polygons: DataFrame, precedence: Sequence[str]) -> DataFrame:
    fields = polygons.select(
        "*", *[F.col("properties").getItem(name).alias(name) for name in
               ("code_arrondissement", "c_ar", "c_arinsee", "l_ar")])
    return fields.withColumn("code", resolve_area_code(precedence, fields.columns))


def silver_areas(polygons: DataFrame) -> DataFrame:
    """Code, centroid, surface and label of each area."""
    m = F.col("moments")
    return _with_code(polygons, DIM_PRECEDENCE).withColumn(
        "moments", G.parts_moments("parts")
    ).select(
        F.col("code").alias("code_arrondissement"),
        G.centroid_lon(m).alias("centroid_lon"), G.centroid_lat(m).alias("centroid_lat"),
        G.area_km2(m).alias("area_km2"), area_label(F.col("l_ar"), F.col("code")).alias("label"),
    )


def silver_air(raw: DataFrame) -> DataFrame:
    """Measures with their sum and mean over the pollutant columns found."""
    found = [c for c in raw.columns if c.lower() in POLLUTANTS]
    if not found:
        log.error("air quality: no pollutant column among %s", raw.columns)
        return raw
    numbers = raw.withColumns({c: to_double(F.col(f"`{c}`")) for c in found})
    return numbers.withColumn("aqi_sum", R.row_sum(found)).withColumn(
        "aqi_mean_paris", R.row_mean(found))


def poi_points(raw: DataFrame) -> DataFrame:
    """Raw points of one source with lon and lat in the city box.

    The box is tested while the pair is made. A filter on the two columns would be pushed
    below their computation and read every text several times over.
    """
    lon, lat = extract_lon_lat(raw.schema)
    pair = F.filter(
        F.array(F.struct(lon.alias("_lon"), lat.alias("_lat"))),
        lambda p: p["_lon"].between(*LON_RANGE) & p["_lat"].between(*LAT_RANGE))
    kept = raw.select("*", F.inline(pair))
    name = R.name_column(raw.columns)
    tagged = R.with_default(R.with_default(kept, "category", "unknown"), "subcategory", "unknown")
    return tagged.select(
        "category", "subcategory",
        (F.col(f"`{name}`").cast("string") if name else F.lit(None).cast("string")).alias("name"),
        F.col("_lon").alias("lon"), F.col("_lat").alias("lat"))


def union_poi(spark: SparkSession, sources: Sequence[DataFrame]) -> DataFrame:
    """All sources in one schema, before they are placed in areas."""
    points = schemas.empty(spark, schemas.POI).select("category", "subcategory", "name", "lon", "lat")
    for source in sources:
        points = points.unionByName(poi_points(source))
    return points


def silver_poi(spark: SparkSession, sources: Sequence[DataFrame], areas: DataFrame,
               day: str) -> DataFrame:
    """Every source's points in the common schema; one spatial join serves them all."""
    placed = spatial_join(union_poi(spark, sources), areas)
    return stamp(placed.filter(F.col("code_arrondissement").isNotNull()), day).select(
        *schemas.POI.fieldNames())

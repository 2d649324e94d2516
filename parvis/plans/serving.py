"""Slices of the gold tables as an API or a map would ask for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parvis.constants import COMPARED, FEATURE_BOX, INDICATORS, SORT_KEYS
from parvis.functions.codes import SERVING_PRECEDENCE, resolve_area_code
from parvis.functions.geometry import box_parts
from parvis.operators import paging as P
from parvis.sources.schemas import inline
from parvis.staging import stage

AREA = "code_arrondissement"
TIMELINE_ORDER = [AREA, "year", "month"]


def filter_kpi(kpi: DataFrame, code: str | None = None, min_attractiveness: float | None = None,
               max_price: float | None = None) -> DataFrame:
    return P.keep_if(kpi, P.equal(AREA, code), P.at_least("idx_attractivite", min_attractiveness),
                     P.at_most("prix_m2", max_price))


def filter_timeline(timeline: DataFrame, code: str | None = None, year_from: int | None = None,
                    year_to: int | None = None) -> DataFrame:
    return P.keep_if(timeline, P.equal(AREA, code), P.at_least("year", year_from),
                     P.at_most("year", year_to))


def filter_poi(poi: DataFrame, category: str | None = None, subcategory: str | None = None
               ) -> DataFrame:
    """All points of a category; a map that wants a page of them uses :func:`~P.page_after`."""
    return P.keep_if(poi, P.equal("category", category), P.equal("subcategory", subcategory))


def kpi_order(key: str = AREA, descending: bool = False) -> list[Column]:
    """Sort columns for an allowed key: nulls last either way, ties by area code."""
    if key not in SORT_KEYS:
        raise ValueError(f"cannot sort by {key!r}")
    c = F.col(key)
    return [c.desc_nulls_last() if descending else c.asc_nulls_last(), F.col(AREA).asc()]


def order_result(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def kpi_page(kpi: DataFrame, page: int = 1, size: int | None = None, key: str = AREA,
             descending: bool = False, **filters) -> tuple[DataFrame, DataFrame]:
    """(rows of the page, one row of page figures)."""
    kept = filter_kpi(kpi, **filters)
    return (P.page_slice(kept, kpi_order(key, descending), page, size),
            P.page_meta(kept, page, size))


def timeline_page(timeline: DataFrame, page: int = 1, size: int | None = None,
                  **filters) -> tuple[DataFrame, DataFrame]:
    kept = filter_timeline(timeline, **filters)
    return (P.page_slice(kept, [F.col(k) for k in TIMELINE_ORDER], page, size),
            P.page_meta(kept, page, size))


def indicators_page(kpi: DataFrame, page: int = 1, size: int | None = None,
                    indicator: str | None = None) -> tuple[DataFrame, DataFrame]:
    rows = unpivot_indicators(kpi, indicator)
    return (P.page_slice(rows, [F.col("indicator"), F.col(AREA)], page, size),
            P.page_meta(rows, page, size))


def top_areas(kpi: DataFrame, key: str = "prix_m2", size: int = 5) -> DataFrame:
    return P.page_slice(kpi, kpi_order(key, descending=True), 1, size)


def unpivot_indicators(kpi: DataFrame, indicator: str | None = None) -> DataFrame:
    """(code, label, indicator, value), from one scan for all indicators."""
    if indicator is not None and indicator not in INDICATORS:
        raise ValueError(f"unknown indicator {indicator!r}")
    return kpi.unpivot([AREA, "label"], [indicator] if indicator else INDICATORS,
                       "indicator", "value")


def json_safe(df: DataFrame) -> DataFrame:
    """Numbers, text and booleans as they are, decimals as doubles, the rest as text."""
    plain = (T.StringType, T.BooleanType, T.IntegralType, T.FractionalType)

    def safe(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (*plain, T.StructType, T.ArrayType, T.MapType)):
            return c
        return c.cast("string").alias(f.name)

    return df.select(*[safe(f) for f in df.schema.fields])


def _feature(geometry: Column, properties: Column) -> Column:
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"), geometry.alias("geometry"),
        properties.alias("properties")), {"ignoreNullFields": "false"})


def to_geojson_points(poi: DataFrame) -> DataFrame:
    """One GeoJSON Feature per point, as one line of text."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    return poi.select(_feature(
        geometry, F.struct(AREA, "category", "subcategory", "name")).alias("feature"))


def enrich_features(polygons: DataFrame, kpi: DataFrame) -> DataFrame:
    """Polygons with the indicators of their area; an unmatched one keeps its own properties."""
    fields = polygons.select(
        "*", *[F.col("properties").getItem(n).alias(n) for n in SERVING_PRECEDENCE])
    coded = fields.withColumn("code", resolve_area_code(SERVING_PRECEDENCE, fields.columns)).drop(
        *SERVING_PRECEDENCE)
    figures = json_safe(kpi)
    return coded.join(
        figures.select(F.col(AREA).alias("_code"), F.struct(
            *[c for c in figures.columns if c != AREA]).alias("figures")),
        F.col("code") == F.col("_code"), "left").drop("_code")


def to_geojson_areas(enriched: DataFrame) -> DataFrame:
    """One GeoJSON Feature per area: its own properties, overlaid by code and indicators."""
    coordinates = F.when(F.col("kind") == "MultiPolygon", F.to_json("parts")).otherwise(
        F.to_json(F.get("parts", F.lit(0))))
    own = F.map_filter(
        "properties", lambda k, _: ~k.isin([AREA, *enriched.schema["figures"].dataType.names]))
    merged = [F.to_json(own), F.to_json(F.struct(F.col("code").alias(AREA)),
                                        {"ignoreNullFields": "false"}),
              F.to_json("figures", {"ignoreNullFields": "false"})]
    bodies = F.concat_ws(",", *[
        F.nullif(F.substring(m, F.lit(2), F.length(m) - 2), F.lit("")) for m in merged])
    return enriched.select("ord", F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"'), F.col("kind"),
        F.lit('","coordinates":'), coordinates, F.lit('},"properties":{'), bodies,
        F.lit("}}")).alias("feature"))


def write_feature_collection(features: DataFrame, path: str, *order: str) -> None:
    """Write ``feature`` lines as one GeoJSON document: the files of ``path``, by name, in a row.

    Lines are sorted and written by all partitions, so no task holds the collection. Null features
    are left out; without features the collection is empty. Rows that tie in ``order`` go by text.
    """
    spark = features.sparkSession
    lines = stage(features.filter(F.col("feature").isNotNull()).orderBy(*order, "feature").select(
        F.monotonically_increasing_id().alias("place"), "feature"), "features")
    first = lines.select(F.min("place")).scalar()
    comma = F.when(F.col("place") > first, F.lit(",")).otherwise(F.lit(""))
    ends = inline(spark, "place long, value string", [
        (-1, '{"type":"FeatureCollection","features":['), (2**63 - 1, "]}")])
    lines.select("place", F.concat(comma, "feature").alias("value")).unionByName(ends).orderBy(
        "place").select("value").write.text(path)


def box_features(kpi: DataFrame) -> DataFrame:
    """Boxes around the area centroids, where no polygons were landed."""
    lon, lat = F.col("centroid_lon"), F.col("centroid_lat")
    return kpi.filter(lon.isNotNull() & lat.isNotNull()).select(
        F.create_map(F.lit(AREA), F.col(AREA)).alias("properties"), F.lit("Polygon").alias("kind"),
        box_parts("centroid_lon", "centroid_lat", *FEATURE_BOX).alias("parts"), F.lit(0).alias("ord"))


def distinct_months(timeline: DataFrame) -> DataFrame:
    return timeline.select("year_month").distinct().orderBy("year_month")


def area_series(timeline: DataFrame, code: str) -> DataFrame:
    return timeline.filter(F.col(AREA) == code).orderBy("year_month")


def choropleth_scale(areas: DataFrame, indicator: str) -> DataFrame:
    """Each area's place between the smallest and largest value; a null sits at the smallest.

    The colour stops are the minimum, the middle and the maximum.
    """
    valued = areas.filter(F.col(indicator).isNotNull() & ~F.isnan(indicator))
    low = valued.select(F.min(indicator)).scalar()
    high = valued.select(F.max(indicator)).scalar()
    at = F.coalesce(F.col(indicator), F.col("scale_min"))
    spread = F.nullif(F.col("scale_max") - F.col("scale_min"), F.lit(0.0))
    return areas.withColumn("scale_min", low).withColumn("scale_max", high).select(
        AREA, F.col(indicator).alias("value"), "scale_min",
        ((F.col("scale_min") + F.col("scale_max")) / 2).alias("scale_mid"), "scale_max",
        F.when(F.col("scale_min").isNotNull(),
               F.coalesce((at - F.col("scale_min")) / spread, F.lit(0.0))).alias("position"))


def month_overlay(kpi: DataFrame, timeline: DataFrame, year_month: str) -> DataFrame:
    """Areas with the chosen month's median as their price, where the month has one."""
    month = timeline.filter(F.col("year_month") == year_month).select(
        AREA, F.col("prix_m2_median").alias("_month"))
    return kpi.join(month, AREA, "left").withColumn(
        "prix_m2", F.coalesce("_month", "prix_m2")).drop("_month")


def compare_areas(kpi: DataFrame, first: str, second: str) -> DataFrame:
    """(metric, first, second): absolute values side by side, null as zero."""
    long = kpi.filter(F.col(AREA).isin(first, second)).unpivot(
        [AREA], COMPARED, "metric", "value")
    value = F.abs(F.coalesce("value", F.lit(0.0)))
    return long.groupBy("metric").agg(
        F.max(F.when(F.col(AREA) == first, value)).alias("first"),
        F.max(F.when(F.col(AREA) == second, value)).alias("second"))

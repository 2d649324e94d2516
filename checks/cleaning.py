"""Casts, rules, filters, column choice, codes and labels."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks.registry import query, rounded, rounded_sql
from checks.standin import (
    KPI_OUT, KPI_ROUNDED, POI_LAT, POI_LON, area_sales, income_raw, kpi, poi, poi_sources, sales_raw, table, timeline, units_raw,
)
from parvis.constants import DWELLING_TYPES, LAT_RANGE, LON_RANGE, VALUE_RANGE
from parvis.functions import casts, codes
from parvis.functions.coordinates import extract_lon_lat
from parvis.functions.geometry import box_parts
from parvis.functions.indices import unit_price
from parvis.operators import rows as R
from parvis.operators import validation as V
from parvis.plans import gold, serving, silver
from parvis.staging import stage

TIMELINE_ROUNDED = ("prix_m2_median", "volume_eur", "prix_m2_median_3m", "delta_prix_m2_mom")
TIMELINE_OUT = "code_arrondissement, year, month, year_month, nb_transactions, " \
    + rounded_sql(6, *TIMELINE_ROUNDED)

_TEXT = """CASE l_orderkey % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN '12e' WHEN 3 THEN '7d'
    WHEN 4 THEN '3.5' ELSE CAST(l_partkey AS {text}) END"""


@query("lenient_cast", """
    SELECT l_orderkey, CASE l_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
            WHEN 3 THEN NULL WHEN 4 THEN 3.5e0 ELSE CAST(l_partkey AS DOUBLE) END AS as_double,
        CASE WHEN l_orderkey % 7 > 4 THEN l_partkey END AS as_long FROM lineitem""")
def lenient_cast(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr("l_orderkey", _TEXT.format(text="STRING") + " AS t")
    return raw.select("l_orderkey", casts.lenient(raw, "t", "double").alias("as_double"),
                      casts.lenient(raw, "t", "long").alias("as_long"))


@query("parse_date_lenient", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN
        CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INT) END
        AS parsed FROM orders""")
def parse_date_lenient(spark, sf):
    text = "CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') " \
           "WHEN 1 THEN date_format(o_orderdate, 'dd/MM/yyyy') ELSE '2024-02-30' END AS t"
    raw = table(spark, sf, "orders").selectExpr("o_orderkey", text)
    return raw.select("o_orderkey", F.unix_date(casts.lenient(raw, "t", "date")).alias("parsed"))


_SALE_OUT = "id_mutation, numero_disposition, date_mutation, valeur_fonciere, " \
            "surface_reelle_bati, longitude, latitude, type_local"


def _sales_out(df):
    return df.select(*[c.strip() for c in _SALE_OUT.split(",")]).withColumn(
        "date_mutation", F.col("date_mutation").cast("string"))


@query("validate_rules", f"SELECT {_SALE_OUT} FROM valid_sales")
def validate_rules(spark, sf):
    typed = silver.typed_transactions(sales_raw(spark, sf))
    return _sales_out(V.keep_valid(typed, silver.transaction_rules()))


_REPORT = """
    SELECT position, rule, count(*) FILTER (WHERE failed = position) AS rejected,
        count(*) FILTER (WHERE failed > position) AS kept
    FROM (SELECT CASE WHEN date_mutation IS NULL THEN 1
            WHEN coalesce(valeur_fonciere <= 0, true) THEN 2
            WHEN coalesce(surface_reelle_bati <= 9, true) THEN 3
            WHEN NOT valeur_fonciere BETWEEN 50000 AND 50000000 THEN 4
            WHEN NOT (longitude BETWEEN 2.20 AND 2.50 AND latitude BETWEEN 48.80 AND 48.92) THEN 5
            WHEN type_local NOT IN ('Appartement', 'Maison') THEN 6 ELSE 7 END AS failed
        FROM sales_raw),
        (VALUES (1::BIGINT, 'non_null_date'), (2, 'non_null_valeur'), (3, 'non_null_surface'),
            (4, 'valeur_realistic'), (5, 'geo_within_paris'), (6, 'type_local_logement'))
        AS r(position, rule)
    GROUP BY 1, 2"""


@query("validation_report", _REPORT)
def validation_report(spark, sf):
    typed = silver.typed_transactions(sales_raw(spark, sf))
    return V.validation_report(typed, silver.transaction_rules())


@query("observed_validation", f"""
    SELECT *, (SELECT count(*) FROM valid_sales) AS written FROM ({_REPORT})""")
def observed_validation(spark, sf):
    """The report counted in the pass that writes the kept sales, and how many were written."""
    rules, seen = silver.transaction_rules(), Observation()
    typed = silver.typed_transactions(sales_raw(spark, sf))
    kept = stage(V.keep_valid_observed(typed, rules, seen), "valid-sales")
    return V.observed_report(spark, seen, rules).withColumn(
        "written", kept.select(F.count("*")).scalar())


@query("rule_nonnull_positive", f"SELECT {_SALE_OUT} FROM sales_raw WHERE surface_reelle_bati > 9")
def rule_nonnull_positive(spark, sf):
    return _sales_out(sales_raw(spark, sf).filter(V.above("surface_reelle_bati", 9)))


@query("rule_between",
       f"SELECT {_SALE_OUT} FROM sales_raw WHERE valeur_fonciere BETWEEN 50000 AND 50000000")
def rule_between(spark, sf):
    return _sales_out(sales_raw(spark, sf).filter(V.within("valeur_fonciere", VALUE_RANGE)))


@query("rule_bbox", """
    SELECT event_id, lon, lat FROM (SELECT event_id, 2.1e0 + (event_id * 7919 % 60000) / 1e5 AS lon,
        48.7e0 + (event_id * 6101 % 40000) / 1e5 AS lat FROM events)
    WHERE lon BETWEEN 2.20e0 AND 2.50e0 AND lat BETWEEN 48.80e0 AND 48.92e0""")
def rule_bbox(spark, sf):
    points = table(spark, sf, "events").selectExpr(
        "event_id", "2.1e0 + (event_id * 7919 % 60000) / 1e5 AS lon",
        "48.7e0 + (event_id * 6101 % 40000) / 1e5 AS lat")
    return points.filter(V.in_box("lon", "lat", LON_RANGE, LAT_RANGE))


@query("rule_isin",
       f"SELECT {_SALE_OUT} FROM sales_raw WHERE type_local IN ('Appartement', 'Maison')")
def rule_isin(spark, sf):
    return _sales_out(sales_raw(spark, sf).filter(V.one_of("type_local", DWELLING_TYPES)))


@query("derive_unit_price", """
    SELECT id_mutation, numero_disposition, valeur_fonciere / surface_reelle_bati AS prix_m2
    FROM sales_raw""")
def derive_unit_price(spark, sf):
    return sales_raw(spark, sf).select(
        "id_mutation", "numero_disposition",
        unit_price(F.col("valeur_fonciere"), F.col("surface_reelle_bati")).alias("prix_m2"))


@query("derive_year_month_parts", """
    SELECT id_mutation, numero_disposition, year(CAST(date_mutation AS DATE)) AS year,
        month(CAST(date_mutation AS DATE)) AS month FROM sales_raw""")
def derive_year_month_parts(spark, sf):
    typed = silver.typed_transactions(sales_raw(spark, sf))
    return silver.year_month_parts(typed, "date_mutation").select(
        "id_mutation", "numero_disposition", "year", "month")


@query("project_by_prefix", "SELECT code_arrondissement, MED21, PIMP21 FROM income")
def project_by_prefix(spark, sf):
    return R.columns_with_prefix(income_raw(spark, sf), ["MED", "PIMP"], ["code_arrondissement"])


@query("resolve_columns", "SELECT area_text AS area, units_text AS units, year FROM units_raw")
def resolve_columns(spark, sf):
    raw = units_raw(spark, sf)
    return raw.select(
        F.col(R.column_containing(raw.columns, "arrond")).alias("area"),
        F.col(R.column_containing(raw.columns, "nombre", "logements")).alias("units"),
        F.col(R.column_named(raw.columns, "annee", "year")).cast("long").alias("year"))


@query("resolve_name_column", "SELECT name, count(*) AS n FROM poi_raw GROUP BY 1")
def resolve_name_column(spark, sf):
    named = [raw.select(F.col(R.name_column(raw.columns)).alias("name"))
             for raw in poi_sources(spark, sf)]
    return named[0].union(named[1]).groupBy("name").agg(F.count("*").alias("n"))


_SHAPES = {
    "point": "named_struct('lon', {x}, 'lat', {y}) AS geo_point_2d",
    "shape": "named_struct('geometry', if(event_id % 5 = 0, null, named_struct("
             "'coordinates', array({x}, {y})))) AS geo_shape",
    "line": "named_struct('geometry', named_struct('coordinates', array(array({x}, {y}), "
            "array(0D, 0D)))) AS geo_shape",
    "none": "{x} AS abscissa"}


@query("extract_lon_lat", "SELECT name, lon, lat FROM poi_raw" + "".join(
    f""" UNION ALL SELECT '{kind}', CASE WHEN {given} THEN {POI_LON} END,
        CASE WHEN {given} THEN {POI_LAT} END FROM events"""
    for kind, given in {"point": "true", "shape": "event_id % 5 <> 0", "line": "true",
                        "none": "false"}.items()))
def extract_lon_lat_(spark, sf):
    """Flat columns, a text, a struct, a point's and a line's shape, and no coordinates."""
    raws = [(raw, F.col(R.name_column(raw.columns))) for raw in poi_sources(spark, sf)]
    raws += [(table(spark, sf, "events").selectExpr(
        "event_id", shape.format(x=f"({POI_LON})", y=f"({POI_LAT})")), F.lit(kind))
        for kind, shape in _SHAPES.items()]
    out = None
    for raw, name in raws:
        lon, lat = extract_lon_lat(raw.schema)
        part = raw.select(name.alias("name"), lon.alias("lon"), lat.alias("lat"))
        out = part if out is None else out.union(part)
    return out


@query("default_columns", """
    SELECT event_id, event_type, 'unknown' AS category FROM events""")
def default_columns(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return R.with_default(R.with_default(events, "category", "unknown"), "event_type", "unknown")


@query("poi_canonical", "SELECT * FROM poi_points")
def poi_canonical(spark, sf):
    one, two = (silver.poi_points(raw) for raw in poi_sources(spark, sf))
    return one.unionByName(two)


@query("union_poi", "SELECT * FROM poi_points")
def union_poi(spark, sf):
    return silver.union_poi(spark, poi_sources(spark, sf))


@query("range_filter_unit_price", """
    SELECT id_mutation, numero_disposition, prix_m2 FROM area_sales
    WHERE prix_m2 BETWEEN 1000 AND 40000""")
def range_filter_unit_price(spark, sf):
    return gold.plausible_prices(area_sales(spark, sf)).select(
        "id_mutation", "numero_disposition", "prix_m2")


@query("nonnull_coords", """
    SELECT code_arrondissement, category, subcategory, name, lon, lat FROM poi
    WHERE lon < 2.4 AND lat < 48.9""")
def nonnull_coords(spark, sf):
    """Points to the east have lost their longitude, those to the north their latitude."""
    return gold.poi_table(poi(spark, sf).withColumns({
        "lon": F.expr("if(lon < 2.4D, lon, null)"), "lat": F.expr("if(lat < 48.9D, lat, null)")}))


@query("filter_kpi", f"""
    SELECT {KPI_OUT} FROM kpi WHERE idx_attractivite >= -0.1e0 AND prix_m2 <= 2600""")
def filter_kpi(spark, sf):
    kept = serving.filter_kpi(kpi(spark, sf), min_attractiveness=-0.1, max_price=2600)
    return rounded(kept, 6, *KPI_ROUNDED)


@query("filter_timeline", f"""
    SELECT {TIMELINE_OUT} FROM timeline WHERE code_arrondissement = '75108'
        AND year >= 1997 AND year <= 1999""")
def filter_timeline(spark, sf):
    kept = serving.filter_timeline(timeline(spark, sf), "75108", 1997, 1999)
    return rounded(kept, 6, *TIMELINE_ROUNDED)


@query("filter_poi", """
    SELECT code_arrondissement, category, subcategory, name, lon, lat FROM poi
    WHERE category = 'transport' AND subcategory = 'k1'""")
def filter_poi(spark, sf):
    return serving.filter_poi(gold.poi_table(poi(spark, sf)), "transport", "k1")


# Codes and labels ----------------------------------------------------------------------

_RAW_CODE = "CASE c_custkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN '' ELSE CAST(c_custkey % 130 AS {text}) END"


@query("normalize_area_code", """
    SELECT c_custkey, CASE WHEN c_custkey % 5 > 1 THEN '751' || CASE WHEN c_custkey % 130 < 10
        THEN '0' ELSE '' END || CAST(c_custkey % 130 AS VARCHAR) END AS code FROM customer""")
def normalize_area_code(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey", _RAW_CODE.format(text="STRING") + " AS n"
    ).select("c_custkey", codes.normalize_area_code(F.col("n")).alias("code"))


@query("resolve_area_code", """
    SELECT c_custkey,
        coalesce(nullif(a, ''), i, n) AS join_code, coalesce(nullif(a, ''), n) AS dim_code,
        coalesce(nullif(a, ''), n, i) AS serving_code
    FROM (SELECT c_custkey,
            CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE '75199' END AS a,
            CASE WHEN c_custkey % 4 = 0 THEN '75' || CAST(100 + c_custkey % 20 AS VARCHAR) END AS i,
            CASE WHEN c_custkey % 5 = 0 THEN '751' || lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0')
                END AS n FROM customer)""")
def resolve_area_code(spark, sf):
    raw = table(spark, sf, "customer").selectExpr(
        "c_custkey", "CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE '75199' END "
        "AS code_arrondissement",
        "if(c_custkey % 4 = 0, concat('75', 100 + c_custkey % 20), null) AS c_arinsee",
        "if(c_custkey % 5 = 0, c_custkey % 20, null) AS c_ar")
    pick = lambda order: codes.resolve_area_code(order, raw.columns)
    return raw.select("c_custkey", pick(codes.JOIN_PRECEDENCE).alias("join_code"),
                      pick(codes.DIM_PRECEDENCE).alias("dim_code"),
                      pick(codes.SERVING_PRECEDENCE).alias("serving_code"))


@query("extract_area_number", """
    SELECT area_text, '751' || lpad(nullif(regexp_extract(area_text, '(\\d+)', 1), ''), 2, '0')
        AS code, count(*) AS n FROM units_raw GROUP BY 1, 2""")
def extract_area_number(spark, sf):
    text = F.col("Arrondissement_Nom")
    return units_raw(spark, sf).groupBy(
        text.alias("area_text"), codes.extract_area_number(text).alias("code")
    ).agg(F.count("*").alias("n"))


@query("area_label", """
    SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name
        ELSE CAST(c_custkey % 20 + 1 AS VARCHAR) || 'e' END AS label FROM customer""")
def area_label(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey", "if(c_custkey % 2 = 0, c_name, '') AS l_ar",
        "concat('751', lpad(CAST(c_custkey % 20 + 1 AS STRING), 2, '0')) AS code"
    ).select("c_custkey", codes.area_label(F.col("l_ar"), F.col("code")).alias("label"))


@query("year_month_key", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders""")
def year_month_key(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", codes.year_month_key(F.year("o_orderdate"), F.month("o_orderdate"))
        .alias("year_month"))


@query("bbox_polygon", """
    SELECT event_id, CAST(5 AS BIGINT) AS n_points, lon - 0.014e0 AS west, lon + 0.014e0 AS east,
        lat - 0.009e0 AS south, lat + 0.009e0 AS north
    FROM (SELECT event_id, 2.2e0 + event_id % 100 / 1e3 AS lon, 48.8e0 + event_id % 90 / 1e3 AS lat
        FROM events)""")
def bbox_polygon(spark, sf):
    centres = table(spark, sf, "events").selectExpr(
        "event_id", "2.2e0 + event_id % 100 / 1e3 AS lon", "48.8e0 + event_id % 90 / 1e3 AS lat")
    return centres.select("event_id", box_parts("lon", "lat", 0.014, 0.009).alias("p")).selectExpr(
        "event_id", "CAST(size(p[0][0]) AS BIGINT) AS n_points", "p[0][0][0][0] AS west",
        "p[0][0][1][0] AS east", "p[0][0][0][1] AS south", "p[0][0][2][1] AS north")

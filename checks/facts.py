"""Joins, geometry, aggregates, windows, indicators and the layer tables."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import functions as F

from checks import standin as S
from checks.registry import query, rnd, rnd_sql, rounded, rounded_sql
from checks.standin import KPI_OUT, KPI_ROUNDED, first_box, table
from checks.cleaning import TIMELINE_OUT, TIMELINE_ROUNDED
from parvis.constants import CATEGORIES
from parvis.functions import geometry as G
from parvis.functions import indices as I
from parvis.operators import rows as R
from parvis.operators.spatial import spatial_join as join_areas
from parvis.operators.windows import dense_rank_desc, lag_delta, median_over
from parvis.plans import gold, refresh, silver, sketches
from parvis.sources import versions
from parvis.sources.layout import read_table
from parvis.staging import new_scratch_path, stage

# Joins ---------------------------------------------------------------------------------

_LOCATED = f"""SELECT id_mutation, numero_disposition, longitude, latitude,
    {first_box('s.longitude', 's.latitude')} AS code_arrondissement FROM sales_raw s"""


def _located(spark, sf):
    points = S.sales_raw(spark, sf).select(
        "id_mutation", "numero_disposition", "longitude", "latitude")
    return join_areas(points, S.areas(spark, sf), "longitude", "latitude")


@query("spatial_join", _LOCATED)
def spatial_join(spark, sf):
    return _located(spark, sf)


@query("spatial_inner", f"SELECT * FROM ({_LOCATED}) WHERE code_arrondissement IS NOT NULL")
def spatial_inner(spark, sf):
    return _located(spark, sf).filter(F.col("code_arrondissement").isNotNull())


@query("spatial_piles", """
    SELECT o_orderkey, (SELECT '7' || CAST(min(s_suppkey) AS VARCHAR) FROM supplier
        WHERE abs(x) * 4096 < 1 + s_suppkey % 997 AND abs(y) * 4096 < 1 + s_suppkey % 997) AS code
    FROM (SELECT o_orderkey, (o_orderkey * 37 % 1201 - 600) / 4096.0 AS x,
        (o_orderkey * 101 % 1301 - 650) / 4096.0 AS y FROM orders)""")
def spatial_piles(spark, sf):
    """Squares around one place, one for each supplier: the cells there are cut again."""
    areas = table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey as int) as ord", "concat('7', s_suppkey) as code",
        "(1 + s_suppkey % 997) / 4096D as h").selectExpr(
        "ord", "code", "array(array(array(array(2.25D - h, 48.75D - h), array(2.25D + h, 48.75D - h), "
        "array(2.25D + h, 48.75D + h), array(2.25D - h, 48.75D + h), "
        "array(2.25D - h, 48.75D - h)))) as parts")
    points = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "2.25D + (o_orderkey * 37 % 1201 - 600) / 4096D as lon",
        "48.75D + (o_orderkey * 101 % 1301 - 650) / 4096D as lat")
    return join_areas(points, areas, code="code").drop("lon", "lat")


def _base(spark, sf):
    return gold.area_base(S.dim(spark, sf), gold.population_table(spark),
                          gold.dwellings_table(spark), S.income(spark, sf),
                          gold.poi_category_pivot(S.counts(spark, sf)))


_BASE_OUT = "code_arrondissement, label, population, parc_logements, " + ", ".join(
    [f"{rnd_sql('revenu_median', 6)} AS revenu_median", *[f"nb_{c}" for c in CATEGORIES]])


@query("left_join_dims", f"SELECT {_BASE_OUT} FROM area_sheet")
def left_join_dims(spark, sf):
    return rounded(_base(spark, sf), 6, "revenu_median").drop("centroid_lon", "centroid_lat")


@query("coalesce_defaults", """
    SELECT n_nationkey, coalesce(n_suppliers, 0) AS n_suppliers FROM nation LEFT JOIN (
        SELECT s_nationkey, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 8000
        GROUP BY 1) ON n_nationkey = s_nationkey""")
def coalesce_defaults(spark, sf):
    """Of all suppliers those with a large balance count; nations without any have a gap."""
    per_nation = table(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.sum(F.when(F.col("s_acctbal") > 8000, F.lit(1))).alias("n_suppliers"))
    joined = table(spark, sf, "nation").join(
        per_nation, F.expr("n_nationkey = s_nationkey"), "left")
    return joined.select("n_nationkey", gold.zero_for_missing("n_suppliers"))


@query("scalar_latest_year", f"""
    SELECT code_arrondissement, {rnd_sql('prix_m2', 6)} AS prix_m2, transactions_an FROM latest""")
def scalar_latest_year(spark, sf):
    return rounded(gold.latest_year_sales(S.monthly(spark, sf)), 6, "prix_m2")


@query("scalar_sum_all", "SELECT * FROM all_units")
def scalar_sum_all(spark, sf):
    return gold.all_year_units(S.units(spark, sf))


@query("scalar_global_avg", f"""
    SELECT date_heure, {rnd_sql('(SELECT avg(aqi_mean_paris) FROM air)', 6)} AS aqi_paris
    FROM air""")
def scalar_global_avg(spark, sf):
    air = S.air(spark, sf)
    return rounded(air.select("date_heure").withColumn("aqi_paris", gold.city_air(air)), 6,
                   "aqi_paris")


# Aggregates ----------------------------------------------------------------------------

_STATS = ("prix_m2_median", "prix_m2_moyen", "prix_m2_p25", "prix_m2_p75", "volume_eur")


@query("monthly_area_stats", "SELECT code_arrondissement, year, month, nb_transactions, "
       + rounded_sql(6, *_STATS) + " FROM monthly")
def monthly_area_stats(spark, sf):
    return rounded(S.monthly(spark, sf), 6, *_STATS)


@query("refreshed_timeline", f"""
    SELECT {TIMELINE_OUT}, year NOT IN (1993, 1996) AND year NOT IN (
        SELECT m.year FROM month_rows m LEFT JOIN month_rows f ON f.nth = m.nth - 2
            AND f.code_arrondissement = m.code_arrondissement, (VALUES (1993), (1996)) AS v(y)
        WHERE y <= m.year AND coalesce(f.year, 0) <= y) AS untouched FROM timeline""")
def refreshed_timeline(spark, sf):
    """A year lands whose prices were wrong and whose sales were few; the rest keeps its files."""
    facts, series = new_scratch_path(spark, "facts"), new_scratch_path(spark, "series")
    sales = stage(S.area_sales(spark, sf), "area-sales")
    wrong = sales.filter("year <> 1993 OR month < 4").withColumn(
        "prix_m2", F.expr("CASE WHEN year = 1996 THEN prix_m2 * 1.01 ELSE prix_m2 END"))
    refresh.refresh_facts(wrong, facts)
    refresh.refresh_timeline(spark, facts, series)
    old = set(versions.current(spark, series))
    refresh.refresh_facts(sales, facts, [1993, 1996])
    refresh.refresh_timeline(spark, facts, series, [1993, 1996])
    kept = [int(f.rpartition("=")[2]) for f in versions.current(spark, series) if f in old]
    out = read_table(spark, series).withColumn("untouched", F.col("year").isin(kept))
    return rounded(out, 6, *TIMELINE_ROUNDED)


# With fewer rows per group than its accuracy, the approximation is the discrete quantile.
@query("approx_monthly_area_stats", f"""
    SELECT code_arrondissement, year, month, count(*) AS nb_transactions,
        quantile_disc(prix_m2, 0.5) AS prix_m2_median, {rnd_sql('avg(prix_m2)', 6)}
        AS prix_m2_moyen, quantile_disc(prix_m2, 0.25) AS prix_m2_p25,
        quantile_disc(prix_m2, 0.75) AS prix_m2_p75, {rnd_sql('sum(valeur_fonciere)', 2)}
        AS volume_eur
    FROM area_sales WHERE prix_m2 BETWEEN 1000 AND 40000 GROUP BY 1, 2, 3""")
def approx_monthly_area_stats(spark, sf):
    return rounded(gold.approx_monthly_area_stats(S.area_sales(spark, sf)), 6,
                   "prix_m2_moyen", "volume_eur")


@query("merged_day_sketches", f"""
    SELECT code_arrondissement, year, count(*) AS nb_transactions,
        {rnd_sql('avg(prix_m2)', 6)} AS prix_m2_moyen, {rnd_sql('sum(valeur_fonciere)', 2)}
        AS volume_eur, true AS ranks_within_two_percent
    FROM area_sales WHERE prix_m2 BETWEEN 1000 AND 40000 GROUP BY 1, 2""")
def merged_day_sketches(spark, sf):
    """Sketches stored by quarter, merged to years; how far their ranks are off is measured."""
    sales = S.area_sales(spark, sf).withColumn("day", F.expr(
        "concat(year, '-', (month + 2) div 3)"))
    path = new_scratch_path(spark, "day-sketches")
    for odd in (0, 1):
        sketches.store_days(sales.filter(F.pmod(F.hash("day"), F.lit(2)) == odd), path, "day")
    keys = ["code_arrondissement", "year"]
    years = sketches.stats_from_sketches(spark.read.parquet(path), keys)
    found = years.select(*keys, *[f"prix_m2_{c}" for c in ("p25", "median", "p75")])
    parts = ("p25", "median", "p75")
    shares = [F.avg(op(F.col("prix_m2"), F.col(f"prix_m2_{c}")).cast("double")).alias(f"{n}_{c}")
              for n, op in (("lt", operator.lt), ("le", operator.le)) for c in parts]
    below = gold.plausible_prices(sales).join(found, keys).groupBy(*keys).agg(*shares)
    close = reduce(lambda a, b: a & b, [
        (F.col(f"lt_{c}") <= q + .02) & (F.col(f"le_{c}") >= q - .02)
        for c, q in zip(parts, sketches.QUARTILES, strict=True)])
    out = years.join(below.select(*keys, close.alias("ranks_within_two_percent")), keys)
    return rounded(out.select(*keys, "nb_transactions", "prix_m2_moyen", "volume_eur",
                              "ranks_within_two_percent"), 6, "prix_m2_moyen", "volume_eur")


@query("social_units_by_area_year", "SELECT * FROM units")
def social_units_by_area_year(spark, sf):
    return S.units(spark, sf)


@query("poi_counts", "SELECT * FROM counts")
def poi_counts(spark, sf):
    return S.counts(spark, sf)


@query("poi_category_pivot", "SELECT * FROM pivoted")
def poi_category_pivot(spark, sf):
    return gold.poi_category_pivot(S.counts(spark, sf))


_FOLDED = ["no2", "o3", "pm10", "PM25"]


def _numbers(spark, sf):
    raw = S.air_raw(spark, sf)
    return raw.withColumns({c: F.col(c).cast("double") for c in _FOLDED})


@query("row_fold_sum", "SELECT date_heure, aqi_sum FROM air")
def row_fold_sum(spark, sf):
    return _numbers(spark, sf).select("date_heure", R.row_sum(_FOLDED).alias("aqi_sum"))


@query("row_fold_mean", "SELECT date_heure, aqi_mean_paris FROM air")
def row_fold_mean(spark, sf):
    return _numbers(spark, sf).select("date_heure", R.row_mean(_FOLDED).alias("aqi_mean_paris"))


# Windows -------------------------------------------------------------------------------

_SALE_KEYS = "code_arrondissement, year, month, id_mutation, numero_disposition, prix_m2"


def _sales(spark, sf):
    return S.area_sales(spark, sf).select(
        "code_arrondissement", "year", "month", "date_mutation", "id_mutation",
        "numero_disposition", "prix_m2")


@query("median_over_area", f"""
    SELECT {_SALE_KEYS}, {rnd_sql('median(prix_m2) OVER (PARTITION BY code_arrondissement)', 6)}
        AS prix_m2_median_arr FROM area_sales""")
def median_over_area(spark, sf):
    out = median_over(_sales(spark, sf), ["code_arrondissement"], "prix_m2", "prix_m2_median_arr")
    return rounded(out.drop("date_mutation"), 6, "prix_m2_median_arr")


@query("dense_rank_month", f"""
    SELECT {_SALE_KEYS}, dense_rank() OVER (PARTITION BY year, month ORDER BY prix_m2 DESC)
        AS rank_prix_m2_dans_mois FROM area_sales""")
def dense_rank_month(spark, sf):
    return dense_rank_desc(_sales(spark, sf).drop("date_mutation"), ["year", "month"], "prix_m2",
                           "rank_prix_m2_dans_mois")


@query("delta_prev_sale", f"""
    SELECT {_SALE_KEYS}, prix_m2 - lag(prix_m2) OVER (PARTITION BY code_arrondissement, year
        ORDER BY date_mutation, id_mutation, numero_disposition, prix_m2)
        AS delta_prix_m2_vs_prev FROM area_sales""")
def delta_prev_sale(spark, sf):
    out = lag_delta(_sales(spark, sf), ["code_arrondissement", "year"], "prix_m2",
                    ["date_mutation", "id_mutation", "numero_disposition", "prix_m2"],
                    "delta_prix_m2_vs_prev")
    return out.drop("date_mutation")


@query("zscore_global", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, {rnd_sql('''(l_extendedprice -
        (SELECT avg(l_extendedprice) FROM lineitem))
        / (SELECT nullif(stddev_samp(l_extendedprice), 0) FROM lineitem)''', 6)} AS z
    FROM lineitem""")
def zscore_global(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return lines.withColumn("z", rnd(R.zscore(lines, "l_extendedprice"), 6)).drop(
        "l_extendedprice")


@query("rolling_avg_3m", f"""
    SELECT code_arrondissement, year_month, {rnd_sql('prix_m2_median_3m', 6)} AS prix_m2_median_3m
    FROM timeline""")
def rolling_avg_3m(spark, sf):
    return rounded(S.timeline(spark, sf), 6, "prix_m2_median_3m").select(
        "code_arrondissement", "year_month", "prix_m2_median_3m")


@query("delta_mom", f"""
    SELECT code_arrondissement, year_month, {rnd_sql('delta_prix_m2_mom', 6)} AS delta_prix_m2_mom
    FROM timeline""")
def delta_mom(spark, sf):
    return rounded(S.timeline(spark, sf), 6, "delta_prix_m2_mom").select(
        "code_arrondissement", "year_month", "delta_prix_m2_mom")


# Geometry ------------------------------------------------------------------------------

# A square with sides of w and, in its lower left corner region, a square hole of w/4.
_W = "(s_suppkey % 7 + 1) / 1e3"
_X, _Y = "2.2e0 + s_suppkey % 90 / 1e3", "48.8e0 + s_suppkey % 70 / 1e3"
_SOLID = "(w * w - (w / 4) * (w / 4))"


def _holed(spark, sf):
    square = lambda x, y, w: (
        f"array(array({x}, {y}), array({x} + {w}, {y}), array({x} + {w}, {y} + {w}), "
        f"array({x}, {y} + {w}), array({x}, {y}))")
    outer, hole = square("x", "y", "w"), square("(x + w / 8)", "(y + w / 8)", "w / 4")
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey", f"{_W} AS w", f"{_X} AS x", f"{_Y} AS y"
    ).selectExpr("s_suppkey", f"array(array({outer}, {hole})) AS parts").withColumn(
        "m", G.parts_moments("parts"))


_HOLED = f"(SELECT s_suppkey, {_W} AS w, {_X} AS x, {_Y} AS y FROM supplier)"
_CENTRE = lambda c: f"(w * w * ({c} + w / 2) - (w / 4) * (w / 4) * ({c} + w / 4)) / {_SOLID}"


@query("polygon_centroid", f"""
    SELECT s_suppkey, {rnd_sql(_CENTRE('x'), 8)} AS lon, {rnd_sql(_CENTRE('y'), 8)} AS lat
    FROM {_HOLED}""")
def polygon_centroid(spark, sf):
    m = F.col("m")
    return _holed(spark, sf).select("s_suppkey", rnd(G.centroid_lon(m), 8).alias("lon"),
                                    rnd(G.centroid_lat(m), 8).alias("lat"))


@query("polygon_area_km2", f"""
    SELECT s_suppkey, {rnd_sql(f'{_SOLID} * 111 * 111', 8)} AS area_km2 FROM {_HOLED}""")
def polygon_area_km2(spark, sf):
    return _holed(spark, sf).select("s_suppkey", rnd(G.area_km2(F.col("m")), 8).alias("area_km2"))


# Indicators ----------------------------------------------------------------------------

_AMOUNTS = """(SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 9 = 0 THEN 0
        WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey % 500 END AS b FROM customer)"""


def _amounts(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_acctbal", "CASE WHEN c_custkey % 9 = 0 THEN 0 WHEN c_custkey % 10 = 0 "
        "THEN NULL ELSE c_custkey % 500 END AS b")


@query("idx_affordability", f"""
    SELECT c_custkey, c_acctbal / nullif(CAST(b AS DOUBLE) * 50e0, 0e0) AS idx FROM {_AMOUNTS}""")
def idx_affordability(spark, sf):
    return _amounts(spark, sf).select(
        "c_custkey", I.affordability(F.col("c_acctbal"), F.col("b").cast("double")).alias("idx"))


@query("idx_tension", f"""
    SELECT c_custkey, c_custkey * 1000e0 / nullif(CAST(b AS DOUBLE), 0e0) AS idx
    FROM {_AMOUNTS}""")
def idx_tension(spark, sf):
    return _amounts(spark, sf).select(
        "c_custkey", I.tension(F.col("c_custkey"), F.col("b")).alias("idx"))


@query("idx_social_effort", f"""
    SELECT c_custkey, coalesce(b, 0) * 10000e0 / nullif(CAST(c_custkey % 7 AS DOUBLE), 0e0) AS idx
    FROM {_AMOUNTS}""")
def idx_social_effort(spark, sf):
    return _amounts(spark, sf).select(
        "c_custkey", I.social_effort(F.col("b"), F.col("c_custkey") % 7).alias("idx"))


@query("poi_density", f"""
    SELECT c_custkey, CASE WHEN b = 0 THEN 0e0
        ELSE (c_custkey + 1) * 1000e0 / CAST(b AS DOUBLE) END AS density FROM {_AMOUNTS}""")
def poi_density(spark, sf):
    return _amounts(spark, sf).select(
        "c_custkey", I.poi_density([F.col("c_custkey"), F.lit(1)], F.col("b")).alias("density"))


@query("idx_attractiveness", f"""
    SELECT code_arrondissement, {rnd_sql('idx_attractivite', 6)} AS idx_attractivite FROM kpi""")
def idx_attractiveness(spark, sf):
    return rounded(S.kpi(spark, sf), 6, "idx_attractivite").select(
        "code_arrondissement", "idx_attractivite")


# Layer tables --------------------------------------------------------------------------


@query("silver_transactions", f"""
    SELECT * EXCLUDE (date_mutation), CAST(date_mutation AS VARCHAR) AS date_mutation,
        {rnd_sql('median(prix_m2) OVER (PARTITION BY code_arrondissement)', 6)}
            AS prix_m2_median_arr,
        dense_rank() OVER (PARTITION BY year, month ORDER BY prix_m2 DESC)
            AS rank_prix_m2_dans_mois,
        prix_m2 - lag(prix_m2) OVER (PARTITION BY code_arrondissement, year
            ORDER BY date_mutation, id_mutation, numero_disposition, prix_m2)
            AS delta_prix_m2_vs_prev
    FROM located_sales""")
def silver_transactions(spark, sf):
    out = silver.silver_transactions(S.sales_raw(spark, sf), S.areas(spark, sf))
    return rounded(out, 6, "prix_m2_median_arr").withColumn(
        "date_mutation", F.col("date_mutation").cast("string"))


@query("silver_social_housing", "SELECT * FROM units")
def silver_social_housing(spark, sf):
    return silver.social_units(S.units_raw(spark, sf))


@query("silver_income", "SELECT * FROM income")
def silver_income(spark, sf):
    return S.income(spark, sf)


@query("silver_areas", f"""
    SELECT '751' || lpad(CAST(s_suppkey % 20 + 1 AS VARCHAR), 2, '0') AS code_arrondissement,
        {rnd_sql(_CENTRE('x'), 8)} AS centroid_lon, {rnd_sql(_CENTRE('y'), 8)} AS centroid_lat,
        {rnd_sql(f'{_SOLID} * 111 * 111', 8)} AS area_km2,
        CASE WHEN s_suppkey % 2 = 0 THEN 'L' || CAST(s_suppkey AS VARCHAR)
            ELSE CAST(s_suppkey % 20 + 1 AS VARCHAR) || 'e' END AS label FROM {_HOLED}""")
def silver_areas(spark, sf):
    polygons = _holed(spark, sf).drop("m").withColumn("properties", F.expr(
        "map('c_ar', CAST(s_suppkey % 20 + 1 AS STRING), "
        "'l_ar', if(s_suppkey % 2 = 0, concat('L', s_suppkey), null))"))
    return rounded(silver.silver_areas(polygons), 8, "centroid_lon", "centroid_lat", "area_km2")


@query("silver_air", "SELECT * FROM air")
def silver_air(spark, sf):
    return S.air(spark, sf)


@query("silver_poi", "SELECT * FROM poi")
def silver_poi(spark, sf):
    return S.poi(spark, sf)


@query("kpi_area", f"SELECT {KPI_OUT} FROM kpi")
def kpi_area(spark, sf):
    return rounded(S.kpi(spark, sf), 6, *KPI_ROUNDED)


@query("timeline_area", f"SELECT {TIMELINE_OUT} FROM timeline")
def timeline_area(spark, sf):
    return rounded(S.timeline(spark, sf), 6, *TIMELINE_ROUNDED)

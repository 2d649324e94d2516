"""The given tables dressed up as sales, dwellings, air measures and points of interest.

Every frame here has a named SQL part that describes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import part, rnd_sql
from parvis.constants import (
    AREA_BOX, AREA_CENTRES, AREA_CODES, CATEGORIES, CITY_POI, DWELLINGS, NATIONAL_POI, POPULATION,
)
from parvis.plans import gold, silver
from parvis.sources.readers import fallback_polygons

DAY = "2024-05-03"


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file footers once per process."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


# Sales ---------------------------------------------------------------------------------

LON = "2.2e0 + ((l_orderkey * 7919 + l_linenumber * 104729) % 30000) / 1e5"
LAT = "48.8e0 + ((l_orderkey * 6101 + l_linenumber * 15485) % 12000) / 1e5"
KIND = "CASE l_returnflag WHEN 'A' THEN 'Appartement' WHEN 'R' THEN 'Maison' ELSE 'Local' END"
SALE_COLUMNS = [
    "l_extendedprice AS valeur_fonciere", "l_quantity AS surface_reelle_bati",
    f"{LON} AS longitude", f"{LAT} AS latitude",
    "CAST(l_linenumber AS BIGINT) AS nombre_pieces_principales", f"{KIND} AS type_local",
    "l_orderkey AS id_mutation", "CAST(l_linenumber AS BIGINT) AS numero_disposition",
]
SUPPLIER_AREA = "'751' || lpad(CAST(s_nationkey % 20 + 1 AS {text}), 2, '0')"


def sales_raw(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "date_format(l_shipdate, 'yyyy-MM-dd') AS date_mutation", *SALE_COLUMNS)


part("sales_raw", f"""
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS date_mutation, {', '.join(SALE_COLUMNS)}
    FROM lineitem""")


def area_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sales with the area of their supplier's nation instead of a geometric one."""
    area = table(spark, sf, "supplier").selectExpr(
        "s_suppkey", SUPPLIER_AREA.format(text="STRING") + " AS code_arrondissement")
    return table(spark, sf, "lineitem").join(area, F.expr("l_suppkey = s_suppkey")).selectExpr(
        "code_arrondissement", "CAST(year(l_shipdate) AS BIGINT) AS year",
        "CAST(month(l_shipdate) AS BIGINT) AS month",
        "date_format(l_shipdate, 'yyyy-MM-dd') AS date_mutation",
        "l_orderkey AS id_mutation", "CAST(l_linenumber AS BIGINT) AS numero_disposition",
        "l_extendedprice AS valeur_fonciere", "l_extendedprice / l_quantity AS prix_m2")


part("area_sales", f"""
    SELECT {SUPPLIER_AREA.format(text='VARCHAR')} AS code_arrondissement,
        year(l_shipdate) AS year, month(l_shipdate) AS month,
        strftime(l_shipdate, '%Y-%m-%d') AS date_mutation,
        l_orderkey AS id_mutation, CAST(l_linenumber AS BIGINT) AS numero_disposition,
        l_extendedprice AS valeur_fonciere, l_extendedprice / l_quantity AS prix_m2
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return gold.monthly_area_stats(area_sales(spark, sf))


part("month_prices", """
    SELECT code_arrondissement, year, month, list(prix_m2) AS prices, sum(valeur_fonciere) AS paid
    FROM area_sales WHERE prix_m2 >= 1000 AND prix_m2 <= 40000 GROUP BY ALL""")
part("monthly", """
    SELECT code_arrondissement, year, month, CAST(len(prices) AS BIGINT) AS nb_transactions,
        list_median(prices) AS prix_m2_median, list_avg(prices) AS prix_m2_moyen,
        list_aggregate(prices, 'quantile_cont', 0.25) AS prix_m2_p25,
        list_aggregate(prices, 'quantile_cont', 0.75) AS prix_m2_p75, paid AS volume_eur
    FROM month_prices""")


def timeline(spark: SparkSession, sf: str) -> DataFrame:
    return gold.timeline_area(monthly(spark, sf))


part("month_rows", """
    SELECT *, rank() OVER (PARTITION BY code_arrondissement ORDER BY year * 12 + month) AS nth
    FROM monthly""")
part("timeline", """
    SELECT m.code_arrondissement, m.year, m.month, printf('%d-%02d', m.year, m.month) AS year_month,
        m.prix_m2_median, m.nb_transactions, m.volume_eur,
        (SELECT avg(p.prix_m2_median) FROM month_rows p WHERE m.nth - p.nth IN (0, 1, 2)
            AND p.code_arrondissement = m.code_arrondissement) AS prix_m2_median_3m,
        m.prix_m2_median - one.prix_m2_median AS delta_prix_m2_mom
    FROM month_rows m LEFT JOIN month_rows one
        ON one.code_arrondissement = m.code_arrondissement AND one.nth + 1 = m.nth""")

# Areas ---------------------------------------------------------------------------------


def polygons(spark: SparkSession, sf: str) -> DataFrame:
    return fallback_polygons(spark)


def areas(spark: SparkSession, sf: str) -> DataFrame:
    return silver.area_polygons(polygons(spark, sf))


_rows = ", ".join(f"({i}, '{code}', {lon}e0, {lat}e0)" for i, (code, (lon, lat))
                  in enumerate(zip(AREA_CODES, AREA_CENTRES, strict=True)))
part("boxes", f"""
    SELECT ord, code, lon, lat, lon - {AREA_BOX[0]}e0 AS x0, lon + {AREA_BOX[0]}e0 AS x1,
        lat - {AREA_BOX[1]}e0 AS y0, lat + {AREA_BOX[1]}e0 AS y1
    FROM (VALUES {_rows}) AS t(ord, code, lon, lat)""")


def first_box(lon: str, lat: str) -> str:
    return (f"(SELECT arg_min(b.code, b.ord) FROM boxes b WHERE {lon} > b.x0 AND {lon} < b.x1 "
            f"AND {lat} > b.y0 AND {lat} < b.y1)")


part("dim", """
    SELECT code AS code_arrondissement, lon AS centroid_lon, lat AS centroid_lat,
        0.024e0 * 0.016e0 * 111 * 111 AS area_km2,
        CAST(ord + 1 AS VARCHAR) || 'e arrondissement' AS label FROM boxes""")


def dim(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_areas(polygons(spark, sf))


part("valid_sales", """
    SELECT *, valeur_fonciere / surface_reelle_bati AS prix_m2 FROM sales_raw
    WHERE date_mutation IS NOT NULL AND valeur_fonciere > 0 AND surface_reelle_bati > 9
        AND valeur_fonciere BETWEEN 50000 AND 50000000
        AND longitude BETWEEN 2.20 AND 2.50 AND latitude BETWEEN 48.80 AND 48.92
        AND type_local IN ('Appartement', 'Maison')""")
part("located_sales", f"""
    SELECT * FROM (SELECT v.*, {first_box('v.longitude', 'v.latitude')} AS code_arrondissement,
        year(CAST(date_mutation AS DATE)) AS year, month(CAST(date_mutation AS DATE)) AS month
        FROM valid_sales v) WHERE code_arrondissement IS NOT NULL""")

# Social housing ------------------------------------------------------------------------


def units_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Columns as a portal might name them, all text; some without digits or units."""
    return table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.expr("o_custkey = c_custkey")).selectExpr(
        "CASE WHEN o_orderkey % 41 = 0 THEN 'sans objet' WHEN o_orderkey % 2 = 0 "
        "THEN concat('Paris ', CAST(c_nationkey % 20 + 1 AS STRING)) "
        "ELSE concat(CAST(c_nationkey % 20 + 1 AS STRING), 'e') END AS Arrondissement_Nom",
        "CASE WHEN o_orderkey % 37 = 0 THEN 'n.c.' ELSE "
        "CAST(o_orderkey % 60 AS STRING) END AS Nombre_total",
        "CAST(year(o_orderdate) AS STRING) AS Annee")


part("units_raw", """
    SELECT CASE WHEN o_orderkey % 41 = 0 THEN 'sans objet' WHEN o_orderkey % 2 = 0
            THEN 'Paris ' || CAST(c_nationkey % 20 + 1 AS VARCHAR)
            ELSE CAST(c_nationkey % 20 + 1 AS VARCHAR) || 'e' END AS area_text,
        CASE WHEN o_orderkey % 37 = 0 THEN 'n.c.' ELSE CAST(o_orderkey % 60 AS VARCHAR)
            END AS units_text,
        year(o_orderdate) AS year
    FROM orders JOIN customer ON o_custkey = c_custkey""")


def units(spark: SparkSession, sf: str) -> DataFrame:
    return silver.social_units(units_raw(spark, sf))


part("units", """
    SELECT '751' || lpad(regexp_extract(area_text, '(\\d+)', 1), 2, '0') AS code_arrondissement,
        year, CAST(sum(TRY_CAST(units_text AS BIGINT)) AS BIGINT) AS nb_logements_finances
    FROM units_raw WHERE regexp_extract(area_text, '(\\d+)', 1) <> ''
        AND TRY_CAST(units_text AS BIGINT) > 0 GROUP BY 1, 2""")

# Income --------------------------------------------------------------------------------

_MEAN = "20000e0 + floor(avg(c_acctbal) * 100 + 0.5) / 100"


def income_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Income per area with columns the cleaning step keeps and drops."""
    return table(spark, sf, "customer").groupBy(F.expr(
        "'751' || lpad(CAST(c_nationkey % 20 + 1 AS STRING), 2, '0') AS code_arrondissement")
    ).agg(F.expr(f"{_MEAN} AS MED21"), F.expr("CAST(count(*) AS DOUBLE) AS PIMP21"),
          F.expr("CAST(max(c_custkey) AS DOUBLE) AS TP6021"))


part("income", f"""
    SELECT '751' || lpad(CAST(c_nationkey % 20 + 1 AS VARCHAR), 2, '0') AS code_arrondissement,
        {_MEAN} AS MED21, CAST(count(*) AS DOUBLE) AS PIMP21
    FROM customer GROUP BY 1""")


def income(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_income(income_raw(spark, sf))


# Air -----------------------------------------------------------------------------------

_POLLUTANT = {"no2": 0, "o3": 1, "pm10": 2, "PM25": 3}


def air_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly measures as text; the pollutant follows from the user, absent ones are null."""
    value = "CAST(CAST(max(CASE WHEN user_id % 4 = {n} AND event_id % 3 <> 0 " \
            "THEN CAST(floor(value * 100) AS BIGINT) END) AS BIGINT) AS STRING) AS {name}"
    return table(spark, sf, "events").groupBy(
        F.date_format("ts", "yyyy-MM-dd'T'HH:'00:00Z'").alias("date_heure")
    ).agg(*[F.expr(value.format(n=n, name=name)) for name, n in _POLLUTANT.items()])


part("air_raw", "SELECT strftime(ts, '%Y-%m-%dT%H:00:00Z') AS date_heure, " + ", ".join(
    f"max(CASE WHEN user_id % 4 = {n} AND event_id % 3 <> 0 "
    f"THEN CAST(floor(value * 100) AS BIGINT) END) AS {name}" for name, n in _POLLUTANT.items())
    + " FROM events GROUP BY 1")
_SUM = " + ".join(f"coalesce(CAST({name} AS DOUBLE), 0e0)" for name in _POLLUTANT)
part("air", f"""
    SELECT date_heure, {', '.join(f'CAST({n} AS DOUBLE) AS {n}' for n in _POLLUTANT)},
        {_SUM} AS aqi_sum, ({_SUM}) / 4e0 AS aqi_mean_paris FROM air_raw""")


def air(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_air(air_raw(spark, sf))


# Points of interest --------------------------------------------------------------------

POI_LON = "2.2e0 + ((event_id * 7919) % 31000) / 1e5"
POI_LAT = "48.8e0 + ((event_id * 6101) % 12500) / 1e5"
_CATEGORY = "CASE event_id % 6 " + " ".join(
    f"WHEN {i} THEN '{c}'" for i, c in enumerate(CATEGORIES)) + " END"
_KINDS = {"Nom": "event_id % 2 = 0", "title": "event_id % 2 = 1"}


def poi_sources(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Two portals' tables: flat columns with a name, and a ``"lat,lon"`` text with a title."""
    k = "'k' || CAST(CAST(get_json_object(props, '$.k') AS BIGINT) % 3 AS STRING) AS subcategory"
    events = table(spark, sf, "events")
    flat = events.filter(_KINDS["Nom"]).selectExpr(
        f"{_CATEGORY} AS category", k, "concat('u', CAST(user_id AS STRING)) AS Nom",
        f"{POI_LON} AS X", f"{POI_LAT} AS Y")
    text = events.filter(_KINDS["title"]).selectExpr(
        f"{_CATEGORY} AS category", k, "concat('u', CAST(user_id AS STRING)) AS title",
        "concat('48.', substr(CAST(180000 + (event_id * 6101) % 12500 AS STRING), 2), ',2.', "
        "substr(CAST(120000 + (event_id * 7919) % 31000 AS STRING), 2)) AS geo_point_2d")
    return [flat, text]


part("poi_raw", f"""
    SELECT {_CATEGORY} AS category,
        'k' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS VARCHAR)
            AS subcategory,
        'u' || CAST(user_id AS VARCHAR) AS name,
        CASE WHEN event_id % 2 = 0 THEN {POI_LON} ELSE CAST('2.' || substr(
            CAST(120000 + (event_id * 7919) % 31000 AS VARCHAR), 2) AS DOUBLE) END AS lon,
        CASE WHEN event_id % 2 = 0 THEN {POI_LAT} ELSE CAST('48.' || substr(
            CAST(180000 + (event_id * 6101) % 12500 AS VARCHAR), 2) AS DOUBLE) END AS lat
    FROM events""")
part("poi_points", """
    SELECT * FROM poi_raw WHERE lon BETWEEN 2.20e0 AND 2.50e0 AND lat BETWEEN 48.80e0 AND 48.92e0
    """)
part("poi", f"""
    SELECT * FROM (SELECT {first_box('p.lon', 'p.lat')} AS code_arrondissement, p.*,
        '{DAY}' AS ingestion_date FROM poi_points p) WHERE code_arrondissement IS NOT NULL""")


def poi(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_poi(spark, poi_sources(spark, sf), areas(spark, sf), DAY)


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return gold.poi_counts(poi(spark, sf))


part("counts", """
    SELECT code_arrondissement, category, subcategory, count(*) AS nb_poi FROM poi
    GROUP BY 1, 2, 3""")
part("pivoted", "SELECT code_arrondissement, " + ", ".join(
    f"CAST(sum(CASE WHEN category = '{c}' THEN nb_poi ELSE 0 END) AS BIGINT) AS nb_{c}"
    for c in CATEGORIES) + " FROM counts GROUP BY 1")
REGISTRY = {**CITY_POI, **NATIONAL_POI}

# Indicators ----------------------------------------------------------------------------

part("population", "SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', CAST({p} AS BIGINT), CAST({d} AS BIGINT))" for c, p, d in zip(
        AREA_CODES, POPULATION, DWELLINGS, strict=True)) +
    ") AS t(code_arrondissement, population, parc_logements)")
part("latest", """
    SELECT code_arrondissement, median(prix_m2_median) AS prix_m2,
        CAST(sum(nb_transactions) AS BIGINT) AS transactions_an
    FROM monthly WHERE year = (SELECT max(year) FROM monthly) GROUP BY 1""")
part("all_units", """
    SELECT code_arrondissement, CAST(sum(nb_logements_finances) AS BIGINT) AS log_sociaux_finances
    FROM units GROUP BY 1""")
_FIGURES = {
    "population": "population FROM population", "parc_logements": "parc_logements FROM population",
    "revenu_median": "MED21 FROM income", "prix_m2": "prix_m2 FROM latest",
    "transactions_an": "transactions_an FROM latest",
    "log_sociaux_finances": "log_sociaux_finances FROM all_units",
    **{f"nb_{c}": f"nb_{c} FROM pivoted" for c in CATEGORIES}}
_COUNTED = ["population", "parc_logements", *[f"nb_{c}" for c in CATEGORIES]]
# Every figure of every area in one long table, and a sheet with a column for each.
part("figures", " UNION ALL ".join(
    f"SELECT code_arrondissement AS area, '{name}' AS figure, "
    + source.replace(" FROM", " AS amount FROM", 1) for name, source in _FIGURES.items()))
part("area_sheet", "SELECT code_arrondissement, label, centroid_lon, centroid_lat, "
     "(SELECT avg(aqi_mean_paris) FROM air) AS aqi_paris, " + ", ".join(
         (f"CAST(coalesce({held}, 0) AS BIGINT)" if name in _COUNTED else
          f"CAST({held} AS BIGINT)" if name in ("transactions_an", "log_sociaux_finances") else held)
         + f" AS {name}" for name in _FIGURES
         for held in [f"max(amount) FILTER (figure = '{name}')"])
     + " FROM dim LEFT JOIN figures ON area = code_arrondissement GROUP BY ALL")
part("area_ratios", """
    SELECT code_arrondissement AS area, revenu_median / 50e0 / nullif(prix_m2, 0) AS affordable,
        1000e0 * transactions_an / nullif(parc_logements, 0) AS tense,
        1e4 * coalesce(log_sociaux_finances, 0) / nullif(population, 0) AS social,
        coalesce(1000e0 * (nb_transport + nb_culture + nb_sante + nb_environnement)
            / nullif(population, 0), 0) AS served FROM area_sheet""")
_WEIGHTS = {"affordable": 0.3, "served": 0.4, "social": 0.15, "tense": -0.15}
part("ratio_moments", "SELECT " + ", ".join(
    f"avg({r}) AS {r}_mean, nullif(stddev_samp({r}), 0) AS {r}_spread" for r in _WEIGHTS)
    + " FROM area_ratios")
KPI_COLUMNS = ["code_arrondissement", "label", "centroid_lon", "centroid_lat", "population",
               "parc_logements", "revenu_median", "prix_m2", "transactions_an",
               "log_sociaux_finances", "aqi_paris", *[f"nb_{c}" for c in CATEGORIES],
               "idx_accessibilite", "idx_tension", "idx_effort_social"]
_RATIOS = {"idx_accessibilite": "affordable", "idx_tension": "tense", "idx_effort_social": "social"}
part("kpi", "SELECT " + ", ".join(
    f"{_RATIOS[c]} AS {c}" if c in _RATIOS else c for c in KPI_COLUMNS) + ", " + " + ".join(
    f"{w}e0 * coalesce(({r} - {r}_mean) / {r}_spread, 0)" for r, w in _WEIGHTS.items())
    + """ AS idx_attractivite FROM area_sheet JOIN area_ratios ON area = code_arrondissement
    JOIN ratio_moments ON true""")

KPI_ROUNDED = ("centroid_lon", "centroid_lat", "revenu_median", "prix_m2", "aqi_paris",
               "idx_accessibilite", "idx_tension", "idx_effort_social", "idx_attractivite")
KPI_OUT = ", ".join(
    f"{rnd_sql(c, 6)} AS {c}" if c in KPI_ROUNDED else c
    for c in [*KPI_COLUMNS, "idx_attractivite"])


def kpi(spark: SparkSession, sf: str, facts: DataFrame | None = None,
        poi_facts: DataFrame | None = None) -> DataFrame:
    """The indicator table; ``facts`` and ``poi_facts`` pass on fact tables already built."""
    return gold.kpi_area(
        dim(spark, sf), monthly(spark, sf) if facts is None else facts, units(spark, sf),
        income(spark, sf), air(spark, sf), counts(spark, sf) if poi_facts is None else poi_facts)

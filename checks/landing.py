"""Readers and writers: the given tables are landed as files, read back and compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import query
from checks.standin import REGISTRY, poi, table
from parvis.constants import AREA_CODES
from parvis.plans.gold import dwellings_table, population_table
from parvis.sources import layout, quoted, readers, schemas
from parvis.staging import new_scratch_path, stage

# Sales as gzipped CSV ------------------------------------------------------------------

_SALE_TEXT = """
    CAST(l_orderkey AS {text}) AS id_mutation,
    CAST(l_linenumber AS {text}) AS numero_disposition,
    {date} AS date_mutation,
    CASE WHEN l_orderkey % 11 = 0 THEN {na}
        ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS {text}) END AS valeur_fonciere,
    CASE WHEN l_orderkey % 13 = 0 THEN {na}
        ELSE CAST(CAST(l_quantity AS BIGINT) AS {text}) END AS surface_reelle_bati,
    '2.' || substr(CAST(120000 + (l_orderkey * 7919 + l_linenumber * 104729) % 30000 AS {text}), 2)
        AS longitude,
    '48.' || substr(CAST(180000 + (l_orderkey * 6101 + l_linenumber * 15485) % 12000
        AS {text}), 2) AS latitude,
    CAST(l_linenumber AS {text}) AS nombre_pieces_principales,
    l_returnflag AS type_local,
    CASE WHEN l_suppkey % 3 = 0 THEN '75' WHEN l_suppkey % 3 = 1 THEN '92' ELSE {na} END
        AS code_departement"""


_NUMBERS = ["valeur_fonciere", "surface_reelle_bati", "longitude", "latitude"]


@query("read_transactions", f"""SELECT * REPLACE (
        {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _NUMBERS)},
        CAST(nombre_pieces_principales AS BIGINT) AS nombre_pieces_principales)
    FROM (SELECT l_linestatus AS nature_mutation, {_SALE_TEXT.format(
    text='VARCHAR', na='NULL', date="strftime(l_shipdate, '%Y-%m-%d')")}
    FROM lineitem) WHERE code_departement = '75'""")
def read_transactions(spark, sf):
    """The files hold one column more than is needed, and the columns in reverse order."""
    path = new_scratch_path(spark, "landed-sales")
    fields = _SALE_TEXT.format(text="STRING", na="'NA'",
                               date="date_format(l_shipdate, 'yyyy-MM-dd')")
    table(spark, sf, "lineitem").selectExpr(
        "year(l_shipdate) AS annee", "l_linestatus AS nature_mutation",
        *[f.strip() for f in reversed(_split(fields))]).write.partitionBy("annee").option(
        "header", True).option("compression", "gzip").csv(path)
    return readers.read_transactions(spark, f"{path}/*/")


@query("read_quoted_csv", """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
        CASE o_orderkey % 3 WHEN 0 THEN o_orderpriority || chr(10) || 'next "line", here' || chr(10)
            WHEN 1 THEN o_orderstatus || ';' ELSE NULL END AS note,
        CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders""")
def read_quoted_csv(spark, sf):
    """Plain files with line breaks, quotes and separators in their values."""
    path = new_scratch_path(spark, "landed-quoted")
    table(spark, sf, "orders").selectExpr(
        "o_orderkey", "case o_orderkey % 3 when 0 then concat(o_orderpriority, '\\n', "
        "'next \"line\", here\\n') when 1 then concat(o_orderstatus, ';') end as note",
        "o_custkey").write.options(
            header=True, escape='"', sep=";", ignoreTrailingWhiteSpace=False).csv(path)
    return quoted.read_csv(spark, path, ";")


def _split(fields: str) -> list[str]:
    """Top-level comma split of a select list."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(fields):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(fields[start:i])
            start = i + 1
    return [*out, fields[start:]]


# JSON pages ----------------------------------------------------------------------------

_RECORD = T.StructType([T.StructField("o_orderkey", T.LongType()),
                        T.StructField("o_orderstatus", T.StringType()),
                        T.StructField("o_custkey", T.LongType())])


@query("read_paged_records", """
    SELECT o_orderkey, o_orderstatus, o_custkey FROM orders""")
def read_paged_records(spark, sf):
    """Pages of uneven length, all of which count."""
    orders = table(spark, sf, "orders")
    path = new_scratch_path(spark, "landed-pages")
    orders.groupBy(
        F.expr("cast(sqrt(o_orderkey) * 10 as bigint)").alias("page")
    ).agg(F.collect_list(F.struct(*_RECORD.names)).alias("results")).write.json(path)
    return readers.read_paged_records(spark, path, _RECORD)


# Income --------------------------------------------------------------------------------

_INCOME_SQL = """SELECT CAST(75049 + c_nationkey AS VARCHAR) AS CODGEO,
        CAST(count(*) AS DOUBLE) AS MED21, CAST(count(*) + 1 AS DOUBLE) AS MED20,
        NULL::DOUBLE AS PIMP21,
        CAST(75049 + c_nationkey AS VARCHAR) AS code_commune,
        NULL::DOUBLE AS TP6021, NULL::DOUBLE AS RD21
    FROM customer WHERE c_nationkey = 7 GROUP BY c_nationkey"""


def _landed_income(spark, sf):
    path = new_scratch_path(spark, "landed-income")
    table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("MED21")).select(
        (F.col("c_nationkey") + 75049).alias("CODGEO"), "MED21",
        (F.col("MED21") + 1).alias("MED20"), F.lit("ND").alias("PIMP21")
    ).write.option("header", True).option("sep", ";").csv(path)
    return readers.read_income(spark, path)


@query("read_income_csv", _INCOME_SQL)
def read_income_csv(spark, sf):
    return _landed_income(spark, sf)


@query("income_fan_out", f"""
    SELECT t.*, a.code_arrondissement FROM ({_INCOME_SQL}) t,
        (SELECT unnest([{', '.join(f"'{c}'" for c in AREA_CODES)}]) AS code_arrondissement) a""")
def income_fan_out(spark, sf):
    return readers.income_fan_out(_landed_income(spark, sf))


# Air -----------------------------------------------------------------------------------

_MEASURES_A_FILE = 100_000

@query("read_air_json", """
    SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS date_heure, CAST(user_id AS VARCHAR) AS no2,
        NULL::VARCHAR AS o3, event_type AS pm10, NULL::VARCHAR AS pm25
    FROM events""")
def read_air_json(spark, sf):
    """Files of one day each, a JSON array in each; a day of many measures has several."""
    path = new_scratch_path(spark, "landed-air")
    measures = table(spark, sf, "events").select(
        F.to_date("ts").alias("day"), F.monotonically_increasing_id().alias("n"),
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date_heure"),
                 F.col("user_id").alias("no2"), F.col("event_type").alias("pm10")).alias("m"))
    days = stage(table(spark, sf, "events").groupBy(F.to_date("ts").alias("of")).agg(
        F.ceil(F.count("*") / _MEASURES_A_FILE).alias("files")), "days")
    measures.join(days, F.expr("day <=> of")).groupBy(
        "day", F.expr("pmod(xxhash64(n), files) AS file")
    ).agg(F.to_json(F.collect_list("m")).alias("value")).select("value").write \
        .option("maxRecordsPerFile", 1).text(path)
    return readers.read_air(spark, path)


# Points of interest --------------------------------------------------------------------


@query("read_poi_csv", """
    SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 7 <> 0 THEN
            event_type || ' "' || event_id || '"; ' || chr(10) || 'x' END AS nom,
        '11' AS "REGION", 'culture' AS category, 'musee' AS subcategory
    FROM events WHERE event_id % 5 = 0""")
def read_poi_csv(spark, sf):
    path = new_scratch_path(spark, "landed-poi")
    table(spark, sf, "events").selectExpr(
        "event_id AS id", """if(event_id % 7 = 0, 'NA',
            concat(event_type, ' "', event_id, '"; ', char(10), 'x')) AS nom""",
        "if(event_id % 5 = 0, '11', '93') AS REGION"
    ).write.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    return readers.read_poi_csv(spark, path, "musees_france")


_KEYS = list(REGISTRY)


@query("tag_poi_source", "SELECT event_id, key, category, subcategory FROM events JOIN (VALUES "
       + ", ".join(f"({i}, '{k}', '{c}', '{s}')" for i, (k, (c, s)) in enumerate(REGISTRY.items()))
       + f") AS t(n, key, category, subcategory) ON event_id % {len(_KEYS)} = n")
def tag_poi_source(spark, sf):
    """Every source is tagged as the build does it, and the sources are joined."""
    events = table(spark, sf, "events").select("event_id")
    return reduce(lambda a, b: a.unionByName(b), [
        readers.tag_poi_source(
            events.filter(F.col("event_id") % len(_KEYS) == i).withColumn("key", F.lit(k)), k)
        for i, k in enumerate(_KEYS)])


# Polygons ------------------------------------------------------------------------------


@query("read_polygons", """
    SELECT s_suppkey // 50 AS batch, row_number() OVER (ORDER BY s_suppkey) - 1 AS ord,
        CASE WHEN s_suppkey % 3 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind,
        CAST(s_suppkey AS VARCHAR) AS c_ar,
        CAST(CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_parts,
        s_suppkey + 0.25e0 AS east
    FROM supplier""")
def read_polygons(spark, sf):
    """A FeatureCollection per fifty suppliers, in files whose names are in the order of their
    keys; every third feature is made of two parts. The order goes on from file to file."""
    path = new_scratch_path(spark, "landed-areas")
    ring = "array(array(x, 1D), array(x + 0.25D, 1D), array(x + 0.25D, 2D), array(x, 2D), " \
           "array(x, 1D))"
    table(spark, sf, "supplier").selectExpr(
        "s_suppkey", "s_suppkey div 50 AS batch", "CAST(s_suppkey AS DOUBLE) AS x"
    ).selectExpr(
        "batch", "s_suppkey", f"to_json(array({ring})) AS rings",
    ).selectExpr(
        "batch", "s_suppkey",
        """concat('{"type":"Feature","properties":{"batch":"', batch, '","c_ar":', s_suppkey,
        '},"geometry":{"type":"', if(s_suppkey % 3 = 0, 'MultiPolygon', 'Polygon'),
        '","coordinates":', if(s_suppkey % 3 = 0, concat('[', rings, ',', rings, ']'), rings),
        '}}') AS feature"""
    ).groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "feature"))).alias("f")
    ).selectExpr(
        "lpad(batch, 9, '0') AS folder",
        """concat('{"type":"FeatureCollection","features":[', array_join(f.feature, ','), ']}')
        AS value""").write.partitionBy("folder").text(path)
    return readers.read_polygons(spark, path).selectExpr(
        "CAST(properties['batch'] AS BIGINT) AS batch", "CAST(ord AS BIGINT) AS ord", "kind",
        "properties['c_ar'] AS c_ar", "CAST(size(parts) AS BIGINT) AS n_parts",
        "parts[0][0][1][0] AS east")


# Snapshots and tables ------------------------------------------------------------------

_DAYS = "CASE o_orderkey % 3 WHEN 0 THEN '2024-05-01' WHEN 1 THEN '2024-05-02' ELSE '2024-05-03' END"


def _snapshots(spark, sf):
    path = new_scratch_path(spark, "snapshots")
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", f"{_DAYS} AS ingestion_date")
    layout.write_partitioned(orders, path, layout.INGESTION)
    return path


@query("stamp_ingestion_date", """
    SELECT o_orderkey, o_orderstatus, '2024-05-03' AS ingestion_date FROM orders""")
def stamp_ingestion_date(spark, sf):
    """A day written twice with other rows holds the last ones, under its stamp."""
    path = new_scratch_path(spark, "stamped")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    layout.write_snapshot(orders.withColumn("o_orderstatus", F.lit("old")), path, "2024-05-03")
    layout.write_snapshot(orders, path, "2024-05-03")
    return layout.read_table(spark, path)


@query("empty_placeholder", """
    SELECT code_arrondissement, count(*) AS nb_poi FROM poi GROUP BY 1""")
def empty_placeholder(spark, sf):
    """A source that was not landed is a typed table without rows beside the landed ones."""
    landed = poi(spark, sf)
    path = new_scratch_path(spark, "absent")
    layout.create_or_replace(schemas.empty(spark, landed.schema), path)
    return landed.unionByName(layout.read_table(spark, path)).groupBy(
        "code_arrondissement").agg(F.count("*").alias("nb_poi"))


@query("cache_silver", """
    SELECT code_arrondissement, category, count(*) AS nb_poi, min(lon) AS west, max(lon) AS east
    FROM poi GROUP BY 1, 2""")
def cache_silver(spark, sf):
    """Two results of one staged table, which is computed once."""
    points = stage(poi(spark, sf), "silver_poi")
    by = ["code_arrondissement", "category"]
    sizes = points.groupBy(*by).agg(F.count("*").alias("nb_poi"))
    return sizes.join(points.groupBy(*by).agg(
        F.min("lon").alias("west"), F.max("lon").alias("east")), by)


@query("scan_latest_snapshot", f"""
    SELECT o_orderkey, o_orderstatus, {_DAYS} AS ingestion_date FROM orders
    WHERE o_orderkey % 3 = 2""")
def scan_latest_snapshot(spark, sf):
    return layout.read_latest(spark, _snapshots(spark, sf))


@query("scan_all_snapshots", f"""
    SELECT o_orderkey, o_orderstatus, {_DAYS} AS ingestion_date FROM orders""")
def scan_all_snapshots(spark, sf):
    return layout.read_table(spark, _snapshots(spark, sf))


@query("write_partitioned", f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN 'again' ELSE o_orderstatus END
        AS o_orderstatus, {_DAYS} AS ingestion_date FROM orders""")
def write_partitioned(spark, sf):
    """The second day is written again and replaces only itself."""
    path = _snapshots(spark, sf)
    again = table(spark, sf, "orders").filter("o_orderkey % 3 = 1").selectExpr(
        "o_orderkey", "'again' AS o_orderstatus", f"{_DAYS} AS ingestion_date")
    layout.write_partitioned(again, path, layout.INGESTION)
    return layout.read_table(spark, path)


@query("create_or_replace_table", """
    SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer""")
def create_or_replace_table(spark, sf):
    path = new_scratch_path(spark, "replaced")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    layout.create_or_replace(customers, path)
    layout.create_or_replace(
        customers.selectExpr("c_custkey", "lower(c_mktsegment) AS segment"), path)
    return layout.read_table(spark, path)


@query("inline_values", """
    SELECT c.code_arrondissement, n_customers, population, parc_logements
    FROM (SELECT '751' || lpad(CAST(c_nationkey % 20 + 1 AS VARCHAR), 2, '0')
            AS code_arrondissement, count(*) AS n_customers FROM customer GROUP BY 1) c
    JOIN population USING (code_arrondissement)""")
def inline_values(spark, sf):
    per_area = table(spark, sf, "customer").groupBy(F.expr(
        "'751' || lpad(CAST(c_nationkey % 20 + 1 AS STRING), 2, '0') AS code_arrondissement")
    ).agg(F.count("*").alias("n_customers"))
    return per_area.join(population_table(spark), "code_arrondissement").join(
        dwellings_table(spark), "code_arrondissement")


@query("partition_inventory", " UNION ALL ".join(
    f"SELECT '{t}' AS source, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows FROM {t}"
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")))
def partition_inventory(spark, sf):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
             "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
    parts = [layout.partition_inventory(table(spark, sf, n), n) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""Pages, slices, GeoJSON, dashboard steps and quality of the finished tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from checks import standin as S
from checks.cleaning import TIMELINE_OUT, TIMELINE_ROUNDED
from checks.registry import query, rnd_sql, rounded
from checks.standin import KPI_OUT, KPI_ROUNDED, table
from parvis.constants import CATEGORIES, FEATURE_BOX, INDICATORS
from parvis.operators import paging as P
from parvis.plans import gold, quality, serving
from parvis.sources import layout
from parvis.staging import new_scratch_path, stage

# Sorting and paging --------------------------------------------------------------------


@query("order_result", f"SELECT {TIMELINE_OUT} FROM timeline ORDER BY 1, 2, 3")
def order_result(spark, sf):
    out = serving.order_result(S.timeline(spark, sf), serving.TIMELINE_ORDER)
    return rounded(out, 6, *TIMELINE_ROUNDED)


@query("sort_kpi", f"SELECT {KPI_OUT} FROM kpi ORDER BY prix_m2 DESC NULLS LAST, 1")
def sort_kpi(spark, sf):
    return rounded(S.kpi(spark, sf).orderBy(*serving.kpi_order("prix_m2", True)), 6, *KPI_ROUNDED)


@query("page_slice", f"""
    SELECT {TIMELINE_OUT} FROM timeline ORDER BY code_arrondissement, year, month
    LIMIT 50 OFFSET 100""")
def page_slice(spark, sf):
    rows, _ = serving.timeline_page(S.timeline(spark, sf), page=3)
    return rounded(rows, 6, *TIMELINE_ROUNDED)


@query("page_after", """
    SELECT o_orderstatus, o_orderkey, o_custkey FROM orders
    WHERE o_orderstatus > 'F' OR (o_orderstatus = 'F' AND o_orderkey > 5000)
    ORDER BY 1, 2 LIMIT 500""")
def page_after(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_custkey")
    return P.page_after(orders, ["o_orderstatus", "o_orderkey"], ["F", 5000], 500)


@query("page_deep", """
    SELECT o_orderstatus, o_orderkey, o_custkey FROM orders
    ORDER BY o_orderstatus, o_orderkey, o_custkey LIMIT 400 OFFSET 800""")
def page_deep(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_custkey")
    path = new_scratch_path(spark, "pages")
    P.write_pages(orders, ["o_orderstatus", "o_orderkey"], path, slices=16)
    return P.read_page(spark, path, 3, 400)


@query("page_meta", """
    SELECT CAST(3 AS BIGINT) AS page, CAST(50 AS BIGINT) AS page_size, count(*) AS total,
        CAST(ceil(count(*) / 50e0) AS BIGINT) AS pages,
        CASE WHEN 3 < ceil(count(*) / 50e0) THEN CAST(4 AS BIGINT) END AS next_page,
        CAST(2 AS BIGINT) AS prev_page FROM orders WHERE o_orderstatus = 'F'""")
def page_meta(spark, sf):
    return P.page_meta(table(spark, sf, "orders").filter("o_orderstatus = 'F'"), page=3)


@query("table_total", "SELECT count(*) AS total FROM orders WHERE o_totalprice <= 100000")
def table_total(spark, sf):
    kept = P.keep_if(table(spark, sf, "orders"), P.at_most("o_totalprice", 100000))
    return P.page_meta(kept).select("total")


@query("top_areas", f"""
    SELECT {KPI_OUT} FROM kpi ORDER BY prix_m2 DESC NULLS LAST, code_arrondissement LIMIT 5""")
def top_areas(spark, sf):
    return rounded(serving.top_areas(S.kpi(spark, sf)), 6, *KPI_ROUNDED)


@query("unpivot_indicators", " UNION ALL ".join(
    f"SELECT code_arrondissement, label, '{i}' AS indicator, {rnd_sql(i, 6)} AS value FROM kpi"
    for i in INDICATORS))
def unpivot_indicators(spark, sf):
    return rounded(serving.unpivot_indicators(S.kpi(spark, sf)), 6, "value")


@query("distinct_months", "SELECT DISTINCT year_month FROM timeline ORDER BY 1")
def distinct_months(spark, sf):
    return serving.distinct_months(S.timeline(spark, sf))


# GeoJSON -------------------------------------------------------------------------------


@query("coerce_json_safe", """
    SELECT o_orderkey, o_orderstatus, CAST(o_custkey AS DOUBLE) / 4 AS quarter,
        strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def coerce_json_safe(spark, sf):
    return serving.json_safe(table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "CAST(o_custkey / 4 AS DECIMAL(18, 2)) AS quarter",
        "CAST(o_orderdate AS DATE) AS day"))


@query("to_geojson_points", """
    SELECT 'Feature' AS kind, 'Point' AS shape, lon, lat, code_arrondissement AS code, category,
        subcategory, name FROM poi""")
def to_geojson_points(spark, sf):
    features = serving.to_geojson_points(gold.poi_table(S.poi(spark, sf)))
    read = "struct<type: string, geometry: struct<type: string, coordinates: array<double>>, " \
           "properties: struct<code_arrondissement: string, category: string, " \
           "subcategory: string, name: string>>"
    return features.select(F.from_json("feature", read).alias("f")).selectExpr(
        "f.type AS kind", "f.geometry.type AS shape", "f.geometry.coordinates[0] AS lon",
        "f.geometry.coordinates[1] AS lat", "f.properties.code_arrondissement AS code",
        "f.properties.category", "f.properties.subcategory", "f.properties.name")


@query("feature_collection", """
    SELECT lon, lat, code_arrondissement AS code, category, subcategory, name, NULL AS document
    FROM poi UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'FeatureCollection'""")
def feature_collection(spark, sf):
    """A document's lines read back: all its features, and one row for what encloses them."""
    path = new_scratch_path(spark, "document")
    serving.write_feature_collection(
        serving.to_geojson_points(gold.poi_table(S.poi(spark, sf))), path)
    lines = spark.read.text(path)
    ends = lines.agg(F.concat(
        F.max(F.when(F.col("value").endswith("["), F.col("value"))),
        F.max(F.when(F.col("value") == "]}", F.col("value")))).alias("document"))
    read = "struct<geometry: struct<coordinates: array<double>>, properties: struct<" \
           "code_arrondissement: string, category: string, subcategory: string, name: string>>"
    features = lines.filter(~F.col("value").endswith("[") & (F.col("value") != "]}")).select(
        F.from_json(F.ltrim("value", F.lit(",")), read).alias("f")).selectExpr(
        "f.geometry.coordinates[0] AS lon", "f.geometry.coordinates[1] AS lat",
        "f.properties.code_arrondissement AS code", "f.properties.category",
        "f.properties.subcategory", "f.properties.name")
    return features.unionByName(ends.select(
        F.get_json_object("document", "$.type").alias("document")), allowMissingColumns=True)


@query("box_features", f"""
    SELECT code_arrondissement AS code, label,
        {rnd_sql(f'centroid_lon - {FEATURE_BOX[0]}e0', 6)} AS west,
        {rnd_sql(f'centroid_lon + {FEATURE_BOX[0]}e0', 6)} AS east,
        {rnd_sql(f'centroid_lat - {FEATURE_BOX[1]}e0', 6)} AS south,
        {rnd_sql(f'centroid_lat + {FEATURE_BOX[1]}e0', 6)} AS north
    FROM kpi WHERE centroid_lon IS NOT NULL AND centroid_lat IS NOT NULL""")
def box_features(spark, sf):
    """Areas drawn as boxes, as where no polygons were landed."""
    kpi = stage(S.kpi(spark, sf), "kpi")
    features = serving.to_geojson_areas(serving.enrich_features(serving.box_features(kpi), kpi))
    corner = lambda place, axis: F.get_json_object(
        "feature", f"$.geometry.coordinates[0][{place}][{axis}]").cast("double")
    return rounded(features.select(
        F.get_json_object("feature", "$.properties.code_arrondissement").alias("code"),
        F.get_json_object("feature", "$.properties.label").alias("label"),
        corner(0, 0).alias("west"), corner(2, 0).alias("east"),
        corner(0, 1).alias("south"), corner(2, 1).alias("north")),
        6, "west", "east", "south", "north")


@query("enrich_features", f"""
    SELECT CAST(ord AS BIGINT) AS ord, code, {rnd_sql('prix_m2', 6)} AS prix_m2, transactions_an,
        kpi.label AS label FROM boxes LEFT JOIN kpi ON code = code_arrondissement""")
def enrich_features(spark, sf):
    out = serving.enrich_features(S.polygons(spark, sf), S.kpi(spark, sf))
    return rounded(out.selectExpr(
        "CAST(ord AS BIGINT) AS ord", "code", "figures.prix_m2 AS prix_m2",
        "figures.transactions_an AS transactions_an", "figures.label AS label"), 6, "prix_m2")


@query("to_geojson_areas", f"""
    SELECT 'Feature' AS kind, 'Polygon' AS shape, x0 AS west, code,
        CAST(ord + 1 AS VARCHAR) AS c_ar, kpi.label AS label,
        {rnd_sql('prix_m2', 6)} AS prix_m2, transactions_an
    FROM boxes LEFT JOIN kpi ON code = code_arrondissement""")
def to_geojson_areas(spark, sf):
    features = serving.to_geojson_areas(
        serving.enrich_features(S.polygons(spark, sf), S.kpi(spark, sf)))
    field = lambda path: F.get_json_object("feature", f"$.{path}")
    return rounded(features.select(
        field("type").alias("kind"), field("geometry.type").alias("shape"),
        field("geometry.coordinates[0][0][0]").cast("double").alias("west"),
        field("properties.code_arrondissement").alias("code"),
        field("properties.c_ar").alias("c_ar"), field("properties.label").alias("label"),
        field("properties.prix_m2").cast("double").alias("prix_m2"),
        field("properties.transactions_an").cast("long").alias("transactions_an"),
    ), 6, "prix_m2")


# Dashboard -----------------------------------------------------------------------------


@query("choropleth_scale", f"""
    SELECT code_arrondissement, {rnd_sql('v', 6)} AS value, {rnd_sql('lo', 6)} AS scale_min,
        {rnd_sql('(lo + hi) / 2', 6)} AS scale_mid, {rnd_sql('hi', 6)} AS scale_max,
        {rnd_sql('(coalesce(v, lo) - lo) / (hi - lo)', 6)} AS position
    FROM (SELECT code_arrondissement, idx_tension AS v, min(idx_tension) OVER () AS lo,
        max(idx_tension) OVER () AS hi FROM kpi)""")
def choropleth_scale(spark, sf):
    return rounded(serving.choropleth_scale(S.kpi(spark, sf), "idx_tension"), 6,
                   "value", "scale_min", "scale_mid", "scale_max", "position")


@query("month_overlay", f"""
    SELECT code_arrondissement, label, {rnd_sql('coalesce(t.prix_m2_median, prix_m2)', 6)}
        AS prix_m2 FROM kpi LEFT JOIN (SELECT code_arrondissement, prix_m2_median FROM timeline
        WHERE year_month = '1998-07') t USING (code_arrondissement)""")
def month_overlay(spark, sf):
    facts = stage(S.monthly(spark, sf), "facts")
    out = serving.month_overlay(S.kpi(spark, sf, facts), gold.timeline_area(facts), "1998-07")
    return rounded(out.select("code_arrondissement", "label", "prix_m2"), 6, "prix_m2")


@query("area_series", f"""
    SELECT {TIMELINE_OUT} FROM timeline WHERE code_arrondissement = '75105' ORDER BY year_month""")
def area_series(spark, sf):
    return rounded(serving.area_series(S.timeline(spark, sf), "75105"), 6, *TIMELINE_ROUNDED)


@query("compare_areas", " UNION ALL ".join(
    f"""SELECT '{m}' AS metric,
        {rnd_sql(f"max(CASE WHEN code_arrondissement = '75101' THEN abs(coalesce({m}, 0)) END)", 6)}
            AS first,
        {rnd_sql(f"max(CASE WHEN code_arrondissement = '75105' THEN abs(coalesce({m}, 0)) END)", 6)}
            AS second FROM kpi""" for m in ["prix_m2", *INDICATORS]))
def compare_areas(spark, sf):
    return rounded(serving.compare_areas(S.kpi(spark, sf), "75101", "75105"), 6,
                   "first", "second")


# Quality -------------------------------------------------------------------------------


def _digest_sql(columns: list[str]) -> str:
    texts = " || ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || '=' || CAST({c} AS VARCHAR), '-')"
        for c in columns)
    return f"CAST('0x' || substr(md5({texts}), 1, 15) AS BIGINT)"


_PRINTED = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "cents"]


@query("table_fingerprint", f"""
    SELECT 'lineitem' AS table_name, count(*) AS row_count,
        CAST(sum({_digest_sql(_PRINTED)}) AS VARCHAR) AS digest
    FROM (SELECT *, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents FROM lineitem)
    UNION ALL SELECT 'counts', count(*), CAST(sum({_digest_sql(
        ['code_arrondissement', 'category', 'subcategory', 'nb_poi'])}) AS VARCHAR) FROM counts""")
def table_fingerprint(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "*", "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents").select(*_PRINTED)
    return quality.table_fingerprint(lines, "lineitem").unionByName(
        quality.table_fingerprint(S.counts(spark, sf), "counts"))


@query("merge_fingerprints", f"""
    SELECT 'orders' AS table_name, count(*) AS row_count,
        CAST(sum({_digest_sql(['o_orderkey', 'o_orderstatus', 'o_orderpriority'])}) AS VARCHAR)
            AS digest FROM orders""")
def merge_fingerprints(spark, sf):
    """Each year has a fingerprint of its own; their sum is that of the table."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year"))
    years = [r["year"] for r in orders.select("year").distinct().collect()]
    parts = [quality.table_fingerprint(orders.filter(F.col("year") == y).drop("year"), "orders")
             for y in years]
    return quality.merge_fingerprints(reduce(lambda a, b: a.unionByName(b), parts))


_BY_STATUS = ["o_orderkey", "o_custkey", "o_orderstatus"]


@query("run_manifest", f"""
    SELECT 'silver' AS layer, 'orders' AS source, count(DISTINCT o_orderstatus) AS n_files,
        count(*) AS n_rows, CAST(sum({_digest_sql(_BY_STATUS)}) AS VARCHAR) AS digest FROM orders
    UNION ALL SELECT 'gold', 'counts', 1, count(*), CAST(sum({_digest_sql(
        ['code_arrondissement', 'category', 'subcategory', 'nb_poi'])}) AS VARCHAR) FROM counts""")
def run_manifest(spark, sf):
    """Two written layers: one partitioned with a file a status, one replaced by a commit."""
    root = new_scratch_path(spark, "run")
    orders = table(spark, sf, "orders").select(*_BY_STATUS).repartition("o_orderstatus")
    layout.write_partitioned(orders, layout.table_path(root, "silver", "orders"), "o_orderstatus")
    layout.create_or_replace(
        S.counts(spark, sf).coalesce(1), layout.table_path(root, "gold", "counts"))
    return quality.run_manifest(spark, root)


_CHECKED = {
    "kpi": {
        "area_count": "abs(sign(count(*) - 20))",
        "areas_missing": "20 - count(DISTINCT code_arrondissement) FILTER (code_arrondissement "
                         "IN (SELECT code FROM boxes))",
        "code_pattern": "count(*) FILTER (NOT regexp_full_match(code_arrondissement, '751..'))",
        "indicators_present": "count(*) FILTER (idx_accessibilite + idx_tension + idx_effort_social"
                              " + idx_attractivite IS NULL)",
        "attractiveness_centred": "CAST(coalesce(abs(avg(idx_attractivite)) >= 0.05, true) AS INT)",
        "price_range": "count(*) FILTER (prix_m2 NOT BETWEEN 5000 AND 25000)"},
    "(SELECT code_arrondissement, count(*) AS n FROM timeline WHERE code_arrondissement <> '75105' "
    "GROUP BY ALL)": {
        "timeline_areas_missing": "20 - count(DISTINCT code_arrondissement)",
        "timeline_months": "count(*) FILTER (n <> 72)"},
    "(SELECT DISTINCT category IN ('" + "', '".join(CATEGORIES) + "') AS known, category FROM counts)":
        {"categories_missing": "6 - count(*) FILTER (known)",
         "categories_unknown": "count(*) FILTER (NOT known)"}}


@query("quality_checks", " UNION ALL ".join(
    f"""SELECT unnest([{', '.join(f"'{c}'" for c in checks)}]) AS "check",
        unnest([{', '.join(f'CAST({e} AS BIGINT)' for e in checks.values())}]) AS failures
        FROM {source}""" for source, checks in _CHECKED.items()))
def quality_checks(spark, sf):
    """One area is left out of the timeline, which the checks have to notice."""
    facts, poi_facts = stage(S.monthly(spark, sf), "facts"), stage(S.counts(spark, sf), "facts")
    series = gold.timeline_area(facts.filter("code_arrondissement <> '75105'"))
    return quality.quality_checks(S.kpi(spark, sf, facts, poi_facts), series, poi_facts)

"""From landed files to gold tables, and what is served from them."""

from __future__ import annotations

import csv
import gzip
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from parvis.constants import AREA_CENTRES, AREA_CODES
from parvis.plans import gold, quality, serving, silver
from parvis.plans.build import GOLD, Build, build_layers, if_landed
from parvis.session import scratch_dir
from parvis.sources import layout, readers
from test_sources import HEADER

DAY = "2024-05-03"
YEARS = range(2019, 2025)


def land(root: Path, years=YEARS, rows_per_month=2):
    """Six years of sales, three in each area and month, and every other source."""
    rng = random.Random(5)
    at = lambda *parts: (root / "landing").joinpath(*parts)
    for year in years:
        path = at("dvf", f"{year}.csv.gz")
        path.parent.mkdir(parents=True, exist_ok=True)
        with gzip.open(path, "wt", newline="") as f:
            out = csv.writer(f)
            out.writerow(HEADER.split(","))
            for a, (lon, lat) in enumerate(AREA_CENTRES):
                for month in range(1, 13):
                    for i in range(rows_per_month):
                        surface = 20 + rng.randrange(80)
                        price = 9000 + 100 * a + rng.randrange(2000)
                        out.writerow([f"{year}-{a}-{month}-{i}", 1, f"{year}-{month:02d}-{1 + i:02d}",
                                      surface * price, surface, lon + rng.uniform(-.003, .003),
                                      lat + rng.uniform(-.002, .002), 2, "Appartement", 75])
            out.writerow(["bad", 1, "not a date", 100000, 20, 2.34, 48.86, 1, "Maison", 75])
            out.writerow(["far", 1, f"{year}-01-01", 100000, 20, 2.01, 48.86, 1, "Maison", 75])
            out.writerow(["dep", 1, f"{year}-01-01", 100000, 20, 2.34, 48.86, 1, "Maison", 92])
    write = lambda text, *parts: (at(*parts).parent.mkdir(parents=True, exist_ok=True),
                                  at(*parts).write_text(text))
    # Small boxes that do not overlap, so that every sale belongs to the area it is made for.
    box = lambda x, y: [[[x + dx * .004, y + dy * .003] for dx, dy in
                         ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]]
    write(json.dumps({"features": [
        {"type": "Feature", "properties": {"c_ar": n + 1, "l_ar": f"{n + 1}e arrondissement"},
         "geometry": {"type": "Polygon", "coordinates": box(*c)}}
        for n, c in enumerate(AREA_CENTRES)]}), "arrondissements", "a.geojson")
    write("CODGEO;MED21;PIMP21;X\n75056;31000;80;1\n", "filosofi", "f.csv")
    units = [{"arrondissement": f"{n}e", "nombre_de_logements": str(100 + n), "annee": y}
             for n in range(1, 21) for y in ("2022", "2023")]
    pages = [{"page": i, "results": units[100 * i:100 * i + 100]} for i in range(2)]
    write("\n".join(map(json.dumps, pages)), "social_housing", "p.json")
    write(json.dumps([{"date_heure": "h", "no2": 10, "o3": 20, "pm10": None, "pm25": "30"}]),
          "air_quality", "a.json")
    for key, lon, lat in [("velib_stations", "lon", "lat"), ("colleges", "x", "y"),
                          ("marches", "longitude", "latitude"), ("que_faire_paris", "lon", "lat"),
                          ("espaces_verts", "lon", "lat")]:
        points = [{"nom": f"{key}{i}", lon: x, lat: y} for i, (x, y) in enumerate(AREA_CENTRES)]
        write(json.dumps({"page": 0, "results": points}), key, "p.json")
    write("nom;geo_point_2d\n" + "\n".join(f"h;{y},{x}" for x, y in AREA_CENTRES),
          "hopitaux_idf", "h.csv")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("city")
    land(root)
    return str(root), build_layers(spark, str(root), DAY)


def test_outcome(built):
    _, outcome = built
    done = {k for k, v in outcome.items() if v == "ok"}
    assert {"raw/dvf", "raw/velib_stations", "silver/dvf", "silver/poi", "gold"} <= done
    # Sources that were not landed fail alone.
    assert outcome["raw/musees_france"] != "ok" and outcome["raw/sanisettes"] != "ok"


def test_all_gold_tables_exist(spark, built):
    build = Build(spark, built[0], DAY)
    sizes = {name: build.gold(name).count() for name in GOLD}
    assert sizes["dim_arrondissement"] == sizes["kpi_arrondissement"] == 20
    assert sizes["fact_transactions_arr_mois"] == sizes["timeline_arrondissement"] == 20 * 72
    assert sizes["fact_logements_sociaux"] == 40 and sizes["fact_air_quality"] == 1
    assert sizes["dim_poi"] == 6 * 20
    assert build.gold("fact_poi_arr").agg(F.sum("nb_poi")).first()[0] == 6 * 20


def test_silver_transactions(spark, built):
    df = Build(spark, built[0], DAY).latest("silver", "dvf")
    assert df.count() == 20 * 72 * 2
    assert df.filter("id_mutation IN ('bad', 'far', 'dep')").count() == 0
    assert df.filter("year <> left(id_mutation, 4)").count() == 0
    first = df.filter("delta_prix_m2_vs_prev IS NULL").count()
    assert first == 20 * len(YEARS)


def test_invariants(spark, built):
    build = Build(spark, built[0], DAY)
    checks = quality.quality_checks(
        build.gold("kpi_arrondissement"), build.gold("timeline_arrondissement"),
        build.gold("fact_poi_arr"))
    got = {r["check"]: r.failures for r in checks.collect()}
    assert len(got) == 10 and set(got.values()) == {0}


def test_invariants_notice_damage(spark, built):
    build = Build(spark, built[0], DAY)
    kpi = build.gold("kpi_arrondissement").filter("code_arrondissement <> '75103'").withColumns({
        "prix_m2": F.lit(1.0), "idx_attractivite": F.col("idx_attractivite") + 1,
        "code_arrondissement": F.concat("code_arrondissement", F.lit("x")),
        "idx_tension": F.lit(None).cast("double")})
    timeline = build.gold("timeline_arrondissement").filter("year_month <> '2020-02'")
    counts = build.gold("fact_poi_arr").filter("category <> 'sante'").unionByName(
        build.gold("fact_poi_arr").limit(1).withColumn("category", F.lit("autre")))
    got = {r["check"]: r.failures for r in quality.quality_checks(kpi, timeline, counts).collect()}
    assert got == {"area_count": 1, "areas_missing": 20, "timeline_areas_missing": 0,
                   "code_pattern": 19, "indicators_present": 19,
                   "attractiveness_centred": 1, "price_range": 19, "timeline_months": 20,
                   "categories_missing": 1, "categories_unknown": 1}


def test_kpi_figures(spark, built):
    r = Build(spark, built[0], DAY).gold("kpi_arrondissement").filter(
        "code_arrondissement = '75108'").first()
    assert (r.population, r.parc_logements, r.revenu_median) == (35_879, 25_700, 31000.0)
    assert r.log_sociaux_finances == 2 * 108 and r.aqi_paris == 15.0
    assert r.transactions_an == 24
    assert r.idx_tension == pytest.approx(24 * 1000 / 25_700)
    assert r.idx_accessibilite == pytest.approx(31000 / (r.prix_m2 * 50))
    assert r.idx_effort_social == pytest.approx(216 * 10000 / 35_879)


def test_served_pages(spark, built):
    build = Build(spark, built[0], DAY)
    kpi, timeline = build.gold("kpi_arrondissement"), build.gold("timeline_arrondissement")
    page, meta = serving.kpi_page(kpi, 1, 5)
    assert [r.code_arrondissement for r in page.collect()] == AREA_CODES[:5]
    assert tuple(meta.first()) == (1, 5, 20, 4, 2, None)
    page, meta = serving.kpi_page(kpi, code="75108")
    assert [r.code_arrondissement for r in page.collect()] == ["75108"]
    prices = [r.prix_m2 for r in serving.kpi_page(kpi, 1, 5, "prix_m2", True)[0].collect()]
    assert prices == sorted(prices, reverse=True)
    page, meta = serving.timeline_page(timeline, 1, 20, code="75108", year_from=2024, year_to=2024)
    assert meta.first().total == 12 and {r.year for r in page.collect()} == {2024}
    page, meta = serving.indicators_page(kpi, 1, 50, "idx_attractivite")
    assert meta.first().total == 20 and {r.indicator for r in page.collect()} == {"idx_attractivite"}
    assert serving.indicators_page(kpi)[1].first().total == 80
    with pytest.raises(ValueError):
        serving.kpi_order("label; DROP TABLE kpi")
    with pytest.raises(ValueError):
        serving.unpivot_indicators(kpi, "prix_m2")
    many = spark.range(60_000).selectExpr("'transport' AS category", "'k1' AS subcategory", "id")
    assert serving.filter_poi(many, "transport", "k1").count() == 60_000


def test_geojson(spark, built):
    build = Build(spark, built[0], DAY)
    points = serving.to_geojson_points(serving.filter_poi(build.gold("dim_poi"), "transport"))
    features = [json.loads(r.feature) for r in points.collect()]
    assert len(features) == 20
    assert {f["properties"]["category"] for f in features} == {"transport"}
    polygons = build.latest("raw", "arrondissements").drop("ingestion_date")
    kpi = build.gold("kpi_arrondissement").filter("code_arrondissement <> '75102'")
    areas = [json.loads(r.feature) for r in serving.to_geojson_areas(
        serving.enrich_features(polygons, kpi)).orderBy("ord").collect()]
    assert len(areas) == 20 and areas[0]["properties"]["population"] == 16_888
    assert areas[0]["properties"]["c_ar"] == "1" and "l_ar" in areas[0]["properties"]
    assert len(areas[0]["geometry"]["coordinates"][0]) == 5
    # An area without figures keeps its own properties.
    assert areas[1]["properties"] == {"c_ar": "2", "l_ar": "2e arrondissement",
                                      "code_arrondissement": "75102"}
    boxes = serving.box_features(kpi)
    assert serving.to_geojson_areas(serving.enrich_features(boxes, kpi)).count() == 19


def test_dashboard_steps(spark, built):
    build = Build(spark, built[0], DAY)
    kpi, timeline = build.gold("kpi_arrondissement"), build.gold("timeline_arrondissement")
    months = [r[0] for r in serving.distinct_months(timeline).collect()]
    assert months[0] == "2019-01" and months[-1] == "2024-12" and len(months) == 72
    series = [r.year_month for r in serving.area_series(timeline, "75105").collect()]
    assert series == months
    gap = kpi.withColumn("prix_m2", F.when(F.col("code_arrondissement") != "75101", F.col("prix_m2")))
    scale = {r.code_arrondissement: r for r in serving.choropleth_scale(gap, "prix_m2").collect()}
    assert scale["75101"].position == 0.0 and max(r.position for r in scale.values()) == 1.0
    march = timeline.filter("NOT (code_arrondissement = '75101' AND year_month = '2020-03')")
    overlay = {r.code_arrondissement: r.prix_m2 for r in
               serving.month_overlay(kpi, march, "2020-03").collect()}
    plain = {r.code_arrondissement: r.prix_m2 for r in kpi.collect()}
    assert overlay["75101"] == plain["75101"] and overlay["75102"] != plain["75102"]
    compared = {r.metric: (r.first, r.second) for r in
                serving.compare_areas(kpi, "75101", "75105").collect()}
    assert len(compared) == 5 and min(v for pair in compared.values() for v in pair) >= 0


def test_fingerprint(spark, built):
    kpi = Build(spark, built[0], DAY).gold("kpi_arrondissement")
    digest = lambda df: tuple(quality.table_fingerprint(df, "t").first())
    assert digest(kpi) == digest(kpi.repartition(7))
    assert digest(kpi) != digest(kpi.withColumn("label", F.lit("x")))
    twice = kpi.unionByName(kpi)
    assert digest(twice)[1] == 40 and digest(twice)[2] != digest(kpi)[2]
    assert digest(kpi.limit(0)) == ("t", 0, "0")
    texts = spark.createDataFrame([(None,), ("",), ("-",)], "a string")
    assert len({digest(texts.filter(c))[2] for c in
                ("a IS NULL", "a = ''", "a = '-'")}) == 3


def test_second_day(spark, tmp_path):
    """A year landed again on another day replaces that year, unless all days are asked for."""
    land(tmp_path, years=[2023, 2024], rows_per_month=1)
    root = str(tmp_path)
    for source in ("arrondissements", "dvf"):
        Build(spark, root, "2024-05-01").land(source)
    (tmp_path / "landing" / "dvf" / "2023.csv.gz").unlink()
    Build(spark, root, "2024-05-02").land("dvf")
    for every, expected in ((False, 2 * 240), (True, 3 * 240)):
        build = Build(spark, root, "2024-05-02", all_snapshots=every)
        build.clean("dvf")
        assert build.latest("silver", "dvf").count() == expected


def test_absent_areas_are_noticed(spark, built):
    build = Build(spark, built[0], DAY)
    gone = "code_arrondissement <> '75103'"
    got = {r["check"]: r.failures for r in quality.quality_checks(
        build.gold("kpi_arrondissement").filter(gone),
        build.gold("timeline_arrondissement").filter(gone), build.gold("fact_poi_arr")).collect()}
    assert (got["areas_missing"], got["timeline_areas_missing"]) == (1, 1)


def test_absent_income_and_air_are_replaced_by_fixed_rows(spark, tmp_path):
    build = Build(spark, str(tmp_path), DAY)
    for source, n in (("filosofi", 20), ("air_quality", 4)):
        build.land(source)
        assert build.latest("raw", source).count() == n


def test_paged_source_without_records(spark, tmp_path):
    path = tmp_path / "landing" / "social_housing" / "p.json"
    path.parent.mkdir(parents=True)
    path.write_text('{"page":0,"results":[]}')
    build = Build(spark, str(tmp_path), DAY)
    build.land("social_housing")
    build.clean("social_housing")
    got = build.latest("silver", "social_housing")
    assert got.count() == 0 and "nb_logements_finances" in got.columns


def test_chosen_sources_and_tables(spark, built):
    root = built[0]
    outcome = build_layers(spark, root, DAY, sources=["filosofi"],
                           tables=["fact_revenus_arr", "timeline_arrondissement"])
    assert outcome == {"raw/filosofi": "ok", "silver/filosofi": "ok", "gold": "ok"}
    with pytest.raises(KeyError):
        Build(spark, root, DAY).publish(["other"])


def test_nothing_staged_is_left_by_a_build(spark, tmp_path):
    land(tmp_path, years=[2024], rows_per_month=1)
    scratch = Path(scratch_dir(spark).removeprefix("file:"))
    before = set(scratch.iterdir())
    build_layers(spark, str(tmp_path), DAY, with_poi=False)
    assert set(scratch.iterdir()) == before


def test_other_errors_than_a_missing_path_are_raised(spark, tmp_path):
    with pytest.raises(ZeroDivisionError):
        if_landed(lambda: 1 / 0)
    assert if_landed(lambda: spark.read.parquet(f"{tmp_path}/none")) is None


def test_a_failed_replacement_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    layout.create_or_replace(spark.range(3), path)
    with pytest.raises(Exception):
        layout.create_or_replace(spark.range(3).selectExpr("raise_error('x') AS id"), path)
    assert layout.read_table(spark, path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    layout.create_or_replace(layout.read_table(spark, path).union(spark.range(1)), path)
    assert layout.read_table(spark, path).count() == 4


def test_gold_failure_is_raised(spark, tmp_path):
    with pytest.raises(Exception):
        build_layers(spark, str(tmp_path), DAY, with_poi=False)


def test_no_poi_gives_empty_typed_tables(spark, tmp_path):
    land(tmp_path, years=[2024], rows_per_month=1)
    outcome = build_layers(spark, str(tmp_path), DAY, with_poi=False)
    assert outcome["gold"] == "ok" and "silver/poi" not in outcome
    build = Build(spark, str(tmp_path), DAY)
    assert build.gold("dim_poi").count() == build.gold("fact_poi_arr").count() == 0
    assert build.gold("kpi_arrondissement").agg(F.sum("nb_culture")).first()[0] == 0


def test_social_units(spark):
    df = spark.createDataFrame(
        [("8e", "5", "2020"), ("Paris 18", "0", "2020"), ("none", "9", "2020"), ("8", "7", None),
         ("8e", "x", "2020"), ("08", "1", "2020")], "Arrondissement string, Logements string, Year string")
    assert rows(silver.social_units(df)) == [("75108", 2020, 6), ("75108", None, 7)]
    odd = df.withColumnRenamed("Year", "when")
    with pytest.raises(silver.SchemaMismatch):
        silver.social_units(odd)
    assert silver.social_units(odd, passthrough=True).columns == odd.columns


def test_air_mean_counts_missing_as_zero(spark):
    df = spark.createDataFrame([("h", "1", None, "x")], "date_heure string, NO2 string, o3 string, pm10 string")
    assert rows(silver.silver_air(df).select("aqi_sum", "aqi_mean_paris")) == [(1.0, 1.0 / 3)]
    bare = df.select("date_heure")
    assert silver.silver_air(bare).columns == ["date_heure"]


def test_poi_normalisation(spark):
    flat = spark.createDataFrame([("a", 2.337, 48.862), ("b", 2.1, 48.862), ("c", None, 48.862)],
                                 "Nom string, lon double, lat double")
    odd = spark.createDataFrame([(1,)], "other int")
    areas = silver.area_polygons(readers.fallback_polygons(spark))
    got = silver.silver_poi(spark, [flat, odd], areas, DAY)
    assert rows(got) == [("75101", "unknown", "unknown", "a", 2.337, 48.862, DAY)]
    assert silver.silver_poi(spark, [], areas, DAY).count() == 0


def test_areas_without_a_code_are_left_out_of_the_join_only(spark):
    polygons = readers.fallback_polygons(spark).limit(3).withColumn("properties", F.expr(
        "CASE ord WHEN 0 THEN map('c_ar', '1') WHEN 1 THEN map('c_ar', 'x') "
        "ELSE map('c_arinsee', '75103') END"))
    assert rows(silver.area_polygons(polygons).select("code")) == [("75101",), ("75103",)]
    assert [r[0] for r in rows(silver.silver_areas(polygons).select("code_arrondissement"))] == \
        ["75101", None, None] or silver.silver_areas(polygons).count() == 3


def test_approximate_stats_are_close(spark):
    sales = spark.range(20_000).selectExpr(
        "concat('7510', id % 3) AS code_arrondissement", "2024 AS year", "id % 2 AS month",
        "1000D + id * 37 % 9001 AS prix_m2", "1D AS valeur_fonciere")
    near = {tuple(r)[:3]: r for r in gold.approx_monthly_area_stats(sales).collect()}
    for r in gold.monthly_area_stats(sales).collect():
        other = near[tuple(r)[:3]]
        assert r.nb_transactions == other.nb_transactions
        assert other.prix_m2_median == pytest.approx(r.prix_m2_median, rel=0.01)

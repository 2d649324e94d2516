"""Column expressions on hand-checked values."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parvis.functions import casts, codes, indices
from parvis.functions import geometry as G
from parvis.functions.coordinates import extract_lon_lat


def column(spark, values, expression, as_type="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {as_type}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_lenient_casts(spark):
    texts = ["1.5", " 2 ", "x", "", None, "1d", "1e3", "NA", "0x1p3", "-.5"]
    assert column(spark, texts, casts.to_double) == \
        [1.5, 2.0, None, None, None, None, 1000.0, None, None, -0.5]
    assert column(spark, ["7", "12.5", "-3", "x", None], casts.to_long) == [7, None, -3, None, None]
    dates = column(spark, ["2024-02-29", "2024-02-30", "29/02/2024", None], casts.to_iso_date)
    assert [str(d) for d in dates] == ["2024-02-29", "None", "None", "None"]


def test_null_tokens(spark):
    df = spark.createDataFrame([("", 1), ("NA", 2), ("ND", 3), ("x", 4)], "a string, b int")
    assert [r.a for r in casts.null_out(df, ["", "NA"]).orderBy("b").collect()] == \
        [None, None, "ND", "x"]


def test_area_codes(spark):
    values = ["1", "12", "100", "-1", "x", "8.0", None, " 7 "]
    assert column(spark, values, codes.normalize_area_code) == \
        ["75101", "75112", "751100", "751-1", None, None, None, "75107"]


def test_area_number_from_text(spark):
    # A run longer than two digits is not cut.
    values = ["8e", "Paris 18", "none", "", None, "75108"]
    assert column(spark, values, codes.extract_area_number) == \
        ["75108", "75118", None, None, None, "75175108"]


def test_code_precedence(spark):
    df = spark.createDataFrame(
        [("", "75112", "3"), (None, None, "3"), ("75101", "75112", "3"), (None, None, "x")],
        "code_arrondissement string, c_arinsee string, c_ar string")
    pick = lambda order: [r[0] for r in df.select(codes.resolve_area_code(order, df.columns))
                          .collect()]
    assert pick(codes.JOIN_PRECEDENCE) == ["75112", "75103", "75101", None]
    assert pick(codes.DIM_PRECEDENCE) == ["75103", "75103", "75101", None]
    assert pick(codes.SERVING_PRECEDENCE) == ["75103", "75103", "75101", None]


def test_labels_and_months(spark):
    df = spark.createDataFrame([("Louvre", "75101"), ("", "75102"), (None, "75120")],
                               "name string, code string")
    assert [r[0] for r in df.select(codes.area_label(F.col("name"), F.col("code"))).collect()] == \
        ["Louvre", "2e", "20e"]
    assert spark.range(1).select(codes.year_month_key(F.lit(2024), F.lit(3))).first()[0] == \
        "2024-03"


@pytest.mark.parametrize("ddl, row, expected", [
    ("longitude string, latitude string", ("2.3", "48.8"), (2.3, 48.8)),
    ("LON double, LAT double", (2.3, 48.8), (2.3, 48.8)),
    ("x_long string, y_lat string", ("2.3", "bad"), (2.3, None)),
    ("x double, y double, longitude double, latitude double", (1.0, 2.0, 2.3, 48.8), (2.3, 48.8)),
    ("geo_point_2d struct<lon: double, lat: double>", ((2.3, 48.8),), (2.3, 48.8)),
    ("geo_point_2d struct<lon: double, lat: double>", (None,), (None, None)),
    ("geo_point_2d string", ("48.8, 2.3",), (2.3, 48.8)),
    ("geo_point_2d string", ("48.8",), (None, 48.8)),
    ("geo_shape struct<geometry: struct<coordinates: array<double>>>",
     ((([2.3, 48.8],),),), (2.3, 48.8)),
    ("geo_shape struct<geometry: struct<coordinates: array<double>>>", ((None,),), (None, None)),
    ("other string", ("1",), (None, None)),
])
def test_coordinates(spark, ddl, row, expected):
    df = spark.createDataFrame([row], ddl)
    assert tuple(df.select(*extract_lon_lat(df.schema)).first()) == expected


def square(x, y, w):
    return [[x, y], [x + w, y], [x + w, y + w], [x, y + w], [x, y]]


def geometry_frame(spark, geometries):
    return spark.createDataFrame(
        [(i, g) for i, g in enumerate(geometries)], f"ord int, parts {G.PARTS_TYPE}")


def test_moments(spark):
    df = geometry_frame(spark, [
        [[square(2.0, 48.0, 4.0)]],
        [[square(2.0, 48.0, 4.0), square(2.0, 48.0, 2.0)]],
        [[square(0.0, 0.0, 1.0)], [square(3.0, 0.0, 1.0)]],
        [[square(0.0, 0.0, 1.0)[::-1]]],
    ])
    out = df.withColumn("m", G.parts_moments("parts")).orderBy("ord").select(
        G.centroid_lon(F.col("m")), G.centroid_lat(F.col("m")), G.area_km2(F.col("m"))).collect()
    expected = [(4.0, 50.0, 16.0), ((16 * 4.0 - 4 * 3.0) / 12, (16 * 50.0 - 4 * 49.0) / 12, 12.0),
                (2.0, 0.5, 2.0), (0.5, 0.5, 1.0)]
    for got, (lon, lat, area) in zip(out, expected, strict=True):
        assert math.isclose(got[0], lon, abs_tol=1e-12)
        assert math.isclose(got[1], lat, abs_tol=1e-12)
        assert math.isclose(got[2], area * 111 * 111, rel_tol=1e-12)


def test_box(spark):
    df = spark.createDataFrame([(2.0, 48.0)], "lon double, lat double")
    ring = df.select(G.box_parts("lon", "lat", 0.5, 0.25)).first()[0][0][0]
    assert ring == [[1.5, 47.75], [2.5, 47.75], [2.5, 48.25], [1.5, 48.25], [1.5, 47.75]]


def test_guarded_ratios(spark):
    df = spark.createDataFrame([(100.0, 10.0, 5, 2), (100.0, 0.0, 0, 0), (100.0, None, None, None)],
                               "money double, price double, n int, base int")
    out = df.select(
        indices.affordability(F.col("money"), F.col("price")),
        indices.tension(F.col("n"), F.col("base")),
        indices.social_effort(F.col("n"), F.col("base")),
        indices.poi_density([F.col("n"), F.col("n")], F.col("base")),
        indices.unit_price(F.col("money"), F.col("price"))).collect()
    assert [tuple(r) for r in out] == [
        (0.2, 2500.0, 25000.0, 5000.0, 10.0), (None, None, None, 0.0, None),
        (None, None, None, None, None)]


def test_attractiveness_ignores_missing_scores(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0), (None, 2.0, None, 4.0)],
                               T.StructType([T.StructField(n, T.DoubleType()) for n in "adst"]))
    out = [r[0] for r in df.select(indices.attractiveness(*[F.col(n) for n in "adst"])).collect()]
    assert out == pytest.approx([0.3 + 0.8 + 0.45 - 0.6, 0.8 - 0.6])

"""Rows that must differ, numbers that are none, and the order of areas over several files."""

from __future__ import annotations

import json
import math

from conftest import rows
from parvis.operators import validation as V
from parvis.operators.spatial import spatial_join
from parvis.plans import quality
from parvis.sources.readers import read_polygons


def test_different_rows_have_different_fingerprints(spark):
    def of(*values):
        return quality.table_fingerprint(
            spark.createDataFrame(list(values), "a string, b string"), "t").first()["digest"]

    pairs = [("x|=y", "z"), ("x", "y|=z"), ("x", None), ("x", ""), (None, "x"), ("", "x"),
             ("1=x", ""), ("", "1=x"), ("-", None), (None, "-")]
    assert len({of(p) for p in pairs}) == len(pairs)
    assert of(*pairs) == of(*pairs[::-1]) != of(*pairs, pairs[0])


def test_fingerprints_of_days_add_up(spark):
    df = spark.range(100).selectExpr("id", "id % 7 as day", "repeat('x', int(id % 5)) as text")
    parts = [quality.table_fingerprint(df.filter(f"day = {d}"), "t") for d in range(8)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.union(part)
    assert rows(quality.merge_fingerprints(merged)) == rows(quality.table_fingerprint(df, "t"))


def test_a_number_that_is_none_is_not_above_a_threshold(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,), (math.inf,), (0.0,)], "a double")
    assert rows(V.keep_valid(df, {"a": V.above("a", 0)})) == [(1.0,), (math.inf,)]
    assert V.validation_report(df, {"a": V.above("a", 0)}).first()["rejected"] == 3
    ints = spark.createDataFrame([(1,), (0,)], "a int")
    assert rows(V.keep_valid(ints, {"a": V.above("a", 0)})) == [(1,)]


def collection(*features):
    square = lambda w: [[[0, 0], [w, 0], [w, w], [0, w], [0, 0]]]
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"code_arrondissement": code},
         "geometry": {"type": "Polygon", "coordinates": square(width)}} for code, width in features]})


def test_areas_of_several_files_go_by_file_and_position(spark, tmp_path):
    files = {"b.geojson": [("3", 4.0), ("4", 8.0)], "a.geojson": [("1", 1.0), ("2", 2.0)],
             "c.geojson": [], "d.geojson": [("5", 9.0), ("6", 9.0)]}
    for name, features in files.items():
        (tmp_path / name).write_text(collection(*features))
    found = read_polygons(spark, str(tmp_path))
    got = sorted((r["ord"], r["properties"]["code_arrondissement"]) for r in found.collect())
    assert got == [(k, str(k + 1)) for k in range(6)]
    areas = found.selectExpr("ord", "properties['code_arrondissement'] as code", "parts")
    points = spark.createDataFrame([(.5,), (1.5,), (3.0,), (5.0,), (8.5,)], "lon double").selectExpr(
        "lon", "lon as lat")
    for shuffled in (areas, areas.repartition(5).orderBy("code")):
        got = {r["lon"]: r["code_arrondissement"] for r in spatial_join(points, shuffled).collect()}
        assert got == {.5: "1", 1.5: "2", 3.0: "3", 5.0: "4", 8.5: "5"}


def test_one_file_keeps_its_positions(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(collection(("x", 1.0), ("y", 2.0)))
    assert [(r["ord"], r["properties"]["code_arrondissement"])
            for r in read_polygons(spark, f"{tmp_path}/a.geojson").orderBy("ord").collect()] == [
        (0, "x"), (1, "y")]

"""Features as one document, and the manifest of a run."""

from __future__ import annotations

import json
from pathlib import Path

from conftest import rows
from parvis.plans import quality, serving
from parvis.sources import layout


def document(path: str) -> dict:
    return json.loads("".join(p.read_text() for p in sorted(Path(path).glob("part-*"))))


def test_features_are_one_document_in_order(spark, root):
    points = spark.range(1000).selectExpr(
        "id * 7919 % 1000 AS n", "CAST(n AS DOUBLE) AS lon", "48.5D AS lat",
        "'75101' AS code_arrondissement", "'bar' AS category", "CAST(NULL AS STRING) AS subcategory",
        """concat('[,"', n, '"]}') AS name""").repartition(9)
    features = serving.to_geojson_points(points)
    lines = features.withColumn(
        "n", serving.F.get_json_object("feature", "$.geometry.coordinates[0]").cast("double"))
    serving.write_feature_collection(lines, f"{root}/many", "n")
    got = document(f"{root}/many")
    assert got["type"] == "FeatureCollection"
    assert [f["geometry"]["coordinates"][0] for f in got["features"]] == list(map(float, range(1000)))
    assert got["features"][3]["properties"]["name"] == '[,"3"]}'


def test_a_document_of_none_and_of_one_feature(spark, root):
    one = spark.createDataFrame([("{}",), (None,)], "feature string")
    serving.write_feature_collection(one, f"{root}/one")
    assert document(f"{root}/one") == {"type": "FeatureCollection", "features": [{}]}
    serving.write_feature_collection(one.limit(0), f"{root}/none")
    assert document(f"{root}/none") == {"type": "FeatureCollection", "features": []}


def test_manifest_of_all_layers(spark, root):
    assert quality.run_manifest(spark, root).count() == 0
    df = spark.createDataFrame(
        [("2024-05-01", 1, None), ("2024-05-02", 2, "x")], "ingestion_date string, n int, s string")
    layout.write_partitioned(df, layout.table_path(root, "raw", "a"), "ingestion_date")
    layout.create_or_replace(df.select("n", "s").coalesce(1), layout.table_path(root, "gold", "b"))
    layout.create_or_replace(df.limit(0), layout.table_path(root, "gold", "c"))
    got = quality.run_manifest(spark, root)
    assert [r[:4] for r in rows(got)] == [
        ("gold", "b", 1, 2), ("gold", "c", 0, 0), ("raw", "a", 2, 2)]
    for layer, source, table in layout.tables(spark, root):
        want = quality.table_fingerprint(table, source).first()["digest"]
        assert got.filter(f"layer = '{layer}' AND source = '{source}'").first()["digest"] == want

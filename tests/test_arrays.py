"""Large JSON arrays are read in splits, with the rows that Spark's own reader gives."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from checks import landing
from parvis.sources import readers, schemas
from test_sources import put, rows


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def measure(k):
    """Texts with braces, quotes and backslashes, numbers as spelled, fields that are not asked for."""
    return {"date_heure": f'h{k} }}{{ "]\\' + "}" * (k % 5) + '\\"' * (k % 3), "no2": k * 1.5,
            "o3": None if k % 4 else 1e20, "pm10": "é},{" * (k % 7),
            "more": {"a": [{"b": "}" * 50}, {"c": k}], "d": {"e": {}}}}


def whole(spark, path):
    return spark.read.schema(schemas.AIR).option("multiLine", True).json(path)


@pytest.mark.parametrize("indent", [None, 2])
def test_a_large_array_is_read_by_many_tasks(spark, root, small_splits, indent):
    put(root, "day=1/a.json", json.dumps([measure(k) for k in range(500)], indent=indent))
    put(root, "day=2/b.json", json.dumps([measure(k) for k in range(300)], ensure_ascii=False) + "\n")
    put(root, "day=2/c.json", json.dumps([measure(1)]))
    got = readers.read_air(spark, root)
    assert got.columns == whole(spark, root).columns
    assert rows(got) == rows(whole(spark, root)) and len(rows(got)) == 801
    tasks = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in tasks) < 200


def test_an_element_longer_than_splits(spark, root, small_splits):
    long = [{"date_heure": "x}" * 9000, "no2": k} for k in range(3)]
    put(root, "a.json", json.dumps([measure(0), *long, measure(2), *long]))
    assert rows(readers.read_air(spark, root)) == rows(whole(spark, root))


@pytest.mark.parametrize("text", [
    "[" + '[{"no2": 1}],' * 900 + "[]]", '{"error": "' + "closed}" * 900 + '"}',
    '[{"no2": 1},' * 900, "[" + " " * 9000 + "]"])
def test_other_large_files_are_left_to_the_whole_reader(spark, root, small_splits, text):
    put(root, "a.json", text)
    assert len(rows(readers.read_air(spark, root))) == 4


def test_a_day_of_many_measures_lands_in_several_files(spark, root, monkeypatch):
    monkeypatch.setattr(landing, "_MEASURES_A_FILE", 100)
    paths, read = [], readers.read_air
    monkeypatch.setattr(readers, "read_air", lambda spark, path: paths.append(path) or read(spark, path))
    spark.range(2000).selectExpr(
        "id AS event_id", "if(id % 50 = 0, null, timestamp'2024-01-01 00:00:00' + make_dt_interval("
        "0, 0, 0, id % 7)) AS ts", "id % 3 AS user_id", "'view' AS event_type").write.parquet(
        f"{root}/events.parquet")
    got = landing.read_air_json(spark, root)
    assert got.count() == 2000 and got.where("date_heure is null").count() == 40
    files = spark.read.text(paths).select(F.json_array_length("value").alias("n")).collect()
    assert len(files) > 20 and max(r["n"] for r in files) < 200

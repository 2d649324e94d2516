"""Readers on small landed files, snapshots and writers."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import types as T

from conftest import rows
from parvis.constants import AREA_CODES
from parvis.sources import layout, readers, schemas

HEADER = "id_mutation,numero_disposition,date_mutation,valeur_fonciere,surface_reelle_bati," \
         "longitude,latitude,nombre_pieces_principales,type_local,code_departement"


def put(root, name, text):
    path = Path(root, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_transactions(spark, root):
    lines = [HEADER, "a,1,2024-01-02,100000,20,2.34,48.86,2,Appartement,75", "b,1,NA,,x,NA,,,Maison,75",
             "c,1,2024-01-02,1,1,1,1,1,Maison,92", "d,1,2024-01-02", "e,1,2024-01-02,1,1,1,1,1,Maison,"]
    with gzip.open(Path(root, "2024.csv.gz"), "wt") as f:
        f.write("\n".join(lines))
    got = rows(readers.read_transactions(spark, root))
    assert [r[0] for r in got] == ["a", "b"]
    assert got[0][2:8] == ("2024-01-02", 100000.0, 20.0, 2.34, 48.86, 2)
    assert got[1][2:7] == (None, None, None, None, None)


def test_short_rows_are_kept(spark, root):
    put(root, "t.csv", HEADER + "\nd,1,2024-01-02\n")
    df = readers._csv(spark, root, ["NA"], ",")
    assert rows(df) == [("d", "1", "2024-01-02") + (None,) * 7]


def test_sales_are_read_by_header_name(spark, root):
    put(root, "t.csv", "code_departement,nature,date_mutation,id_mutation,valeur_fonciere\n"
        "75,Vente,2024-01-02,m1,100000\n92,Vente,2024-01-02,m2,1\n")
    row = readers.read_transactions(spark, root).collect()
    assert [(r.id_mutation, r.nature, r.valeur_fonciere, r.longitude) for r in row] == \
        [("m1", "Vente", 100000.0, None)]


def test_sales_of_several_headers_are_joined_by_name(spark, root):
    put(f"{root}/a", "t.csv", "code_departement,id_mutation,lot\n75,m1,x\n")
    put(f"{root}/b", "t.csv", "id_mutation,code_departement\nm2,75\n")
    got = readers.read_transactions(spark, [f"{root}/a", f"{root}/b"])
    assert rows(got.select("id_mutation", "lot")) == [("m1", "x"), ("m2", None)]


def test_quoted_quotes_separators_and_line_breaks(spark, root):
    put(root, "m.csv", 'id;nom;REGION\n1;"Musee ""Le; Grand""";11\n2;"two\nlines";11\n3;x;93\n')
    got = readers.read_poi_csv(spark, root, "musees_france").select("id", "nom")
    assert rows(got) == [("1", 'Musee "Le; Grand"'), ("2", "two\nlines")]


@pytest.mark.parametrize("inferred", [False, True])
def test_all_landed_pages_count(spark, root, inferred):
    record = None if inferred else T.StructType([T.StructField("n", T.LongType())])
    pages = [{"page": p, "results": [{"n": 10 * p + i} for i in range(k)]}
             for p, k in [(0, 3), (1, 2), (2, 0), (3, 3)]]
    put(root, "p.json", "\n".join(map(json.dumps, pages)))
    got = [r[0] for r in rows(readers.read_paged_records(spark, root, record))]
    assert sorted(got) == [0, 1, 2, 10, 11, 30, 31, 32]


def test_pages_without_records_are_an_empty_table(spark, root):
    put(root, "p.json", '{"page":0,"results":[]}')
    got = readers.read_paged_records(spark, root)
    assert got.columns == ["no_records"] and got.count() == 0


def test_other_income_figures_are_numbers(spark, root):
    put(root, "i.csv", "CODGEO;MED20;PIMP20;LIB\n75056;100.5;ND;Paris\n")
    got = readers.read_income(spark, root)
    assert got.select("MED20", "PIMP20", "LIB").collect() == [(100.5, None, "Paris")]


@pytest.mark.parametrize("code", ["CODGEO", "code_insee", "Commune"])
def test_income(spark, root, code):
    put(root, "i.csv", f"{code};MED21;PIMP21\n75056;30000.5;ND\n01001;1;2\n")
    df = readers.read_income(spark, root)
    assert df.select("code_commune", "MED21", "PIMP21", "TP6021").collect() == \
        [("75056", 30000.5, None, None)]
    spread = readers.income_fan_out(df)
    assert sorted(r.code_arrondissement for r in spread.collect()) == AREA_CODES


def test_income_fallback(spark, root):
    put(root, "i.csv", "CODGEO;MED21\n01001;1\n")
    assert [r.asDict() for r in readers.read_income(spark, root).select(
        "code_commune", "MED21", "PIMP21", "TP6021", "RD21").collect()] == [
        {"code_commune": "75056", "MED21": 29110.0, "PIMP21": 80.6, "TP6021": 16.1, "RD21": 4.7}]


def test_air(spark, root):
    put(root, "a.json", json.dumps([
        {"date_heure": "h1", "no2": 1.5, "o3": None, "pm10": "bad"}, {"date_heure": "h2"}]))
    assert rows(readers.read_air(spark, root)) == [
        ("h1", "1.5", None, "bad", None), ("h2", None, None, None, None)]


def test_air_lines(spark, root):
    put(root, "a.json", '{"date_heure":"h1","no2":1}\n{"date_heure":"h2","no2":2}\n')
    assert [r[:2] for r in rows(readers.read_air(spark, root, lines=True))] == \
        [("h1", "1"), ("h2", "2")]


@pytest.mark.parametrize("text", ["[]", '{"error": "closed"}'])
def test_air_fallback(spark, root, text):
    put(root, "a.json", text)
    got = rows(readers.read_air(spark, root))
    assert len(got) == 4 and got[0] == ("2024-01-15T12:00:00Z", "38.2", "22.1", "19.4", "11.8")


def test_poi_csv_filter_only_where_the_column_exists(spark, root):
    put(root, "m/m.csv", "nom;REGION\nLouvre;11\nAutre;93\nRien;\n")
    assert rows(readers.read_poi_csv(spark, f"{root}/m", "musees_france")) == \
        [("Louvre", "11", "culture", "musee")]
    put(root, "n/m.csv", "nom\nLouvre\nND\n")
    assert rows(readers.read_poi_csv(spark, f"{root}/n", "musees_france")) == \
        [("Louvre", "culture", "musee"), (None, "culture", "musee")]
    with pytest.raises(KeyError):
        readers.tag_poi_source(spark.range(1), "unknown")


def test_badly_encoded_text_is_kept(spark, root):
    Path(root, "x.csv").write_bytes(b"nom\nCaf\xe9\n")
    assert readers.read_poi_csv(spark, root, "hopitaux_idf").count() == 1


FEATURES = {"type": "FeatureCollection", "features": [
    {"type": "Feature", "properties": {"c_ar": 8, "l_ar": "Elysee"},
     "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
    {"type": "Feature", "properties": {"code_arrondissement": "75101", "extra": {"a": 1}},
     "geometry": {"type": "MultiPolygon",
                  "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
]}


def test_polygons(spark, root):
    put(root, "a.geojson", json.dumps(FEATURES, indent=1))
    got = readers.read_polygons(spark, root).orderBy("ord").collect()
    assert [(r.ord, r.kind, len(r.parts)) for r in got] == [(0, "Polygon", 1), (1, "MultiPolygon", 2)]
    assert got[0].properties["c_ar"] == "8" and got[0].parts[0][0][1] == [1.0, 0.0]
    assert got[1].parts[1][0][2] == [6.0, 6.0]


def test_no_polygons_gives_the_boxes(spark, root):
    put(root, "a.geojson", '{"type":"FeatureCollection","features":[]}')
    got = readers.read_polygons(spark, root).orderBy("ord").collect()
    assert [r.properties["code_arrondissement"] for r in got] == AREA_CODES
    assert got[7].properties["l_ar"] == "8e arrondissement"


def test_snapshots(spark, root):
    """Business year and month survive; only the last snapshot, per year where asked."""
    df = spark.createDataFrame([
        ("2024-05-01", "2023", 1, 2), ("2024-05-01", "2024", 1, 3), ("2024-05-02", "2024", 1, 4)],
        "ingestion_date string, annee string, year int, month int")
    path = f"{root}/raw/dvf"
    layout.write_partitioned(df, path, "ingestion_date", "annee")
    table = layout.read_table(spark, path)
    pick = lambda d: rows(d.select("ingestion_date", "year", "month"))
    assert pick(table) == [
        ("2024-05-01", 1, 2), ("2024-05-01", 1, 3), ("2024-05-02", 1, 4)]
    assert pick(layout.read_latest(spark, path)) == [("2024-05-02", 1, 4)]
    latest = layout.read_latest(spark, path, "annee")
    assert pick(latest) == [("2024-05-01", 1, 2), ("2024-05-02", 1, 4)]
    assert "PartitionFilters: [((" in latest._jdf.queryExecution().toString()
    assert [tuple(r) for r in layout.inventory(spark, root).collect()] == [("raw", "dvf", 3, 3)]


def test_sales_without_a_date_are_one_partition(spark, root):
    df = spark.createDataFrame([("2024-05-01", None, 1), ("2024-05-02", None, 2),
                                ("2024-05-01", 2023, 3)], "ingestion_date string, annee int, n int")
    layout.write_partitioned(df, f"{root}/t", "ingestion_date", "annee")
    assert rows(layout.read_latest(spark, f"{root}/t", "annee").select("n")) == [(2,), (3,)]


def test_replaying_a_day_replaces_only_that_day(spark, root):
    path = f"{root}/t"
    frame = lambda day, n: spark.createDataFrame([(day, n)], "ingestion_date string, n int")
    for day, n in [("2024-05-01", 1), ("2024-05-02", 2), ("2024-05-02", 3)]:
        layout.write_partitioned(frame(day, n), path, "ingestion_date")
    assert rows(layout.read_table(spark, path)) == [(1, "2024-05-01"), (3, "2024-05-02")]
    inventory = layout.partition_inventory(spark.read.parquet(path), "t").first()
    assert tuple(inventory) == ("t", 2, 2)


def test_typed_empty_tables_can_be_written(spark, root):
    layout.create_or_replace(schemas.empty(spark, schemas.FACT_POI), f"{root}/e")
    back = layout.read_table(spark, f"{root}/e")
    assert back.count() == 0 and back.schema == schemas.FACT_POI


def test_inline_values(spark):
    df = schemas.inline(spark, "a string, b double, c bigint", [("o'k", 1.5, 2), (None, None, 3)])
    assert rows(df) == [("o'k", 1.5, 2), (None, None, 3)] or \
        rows(df) == [(None, None, 3), ("o'k", 1.5, 2)]
    assert df.schema["c"].dataType == T.LongType()
    assert schemas.inline(spark, "a string", []).count() == 0

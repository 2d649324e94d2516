"""Explicit schemas, so that reads can go without inference and no empty table lacks types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TRANSACTIONS = T.StructType([
    T.StructField(name, T.StringType()) for name in (
        "id_mutation", "numero_disposition", "date_mutation", "valeur_fonciere",
        "surface_reelle_bati", "longitude", "latitude", "nombre_pieces_principales",
        "type_local", "code_departement")
])

# Read leniently at landing, so that later filters on them reach the scan of the raw table.
TRANSACTION_NUMBERS = {
    "valeur_fonciere": "double", "surface_reelle_bati": "double", "longitude": "double",
    "latitude": "double", "nombre_pieces_principales": "long",
}

# Measures are landed as text: a portal may send a word where a number belongs.
AIR = T.StructType([
    T.StructField(name, T.StringType()) for name in ("date_heure", "no2", "o3", "pm10", "pm25")])

POI = T.StructType([
    T.StructField("code_arrondissement", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("ingestion_date", T.StringType()),
])

# What is left of a paged source whose pages hold no records.
NO_RECORDS = T.StructType([T.StructField("no_records", T.StringType())])

SOCIAL_UNITS = T.StructType([
    T.StructField("code_arrondissement", T.StringType()), T.StructField("year", T.LongType()),
    T.StructField("nb_logements_finances", T.LongType())])

FACT_POI = T.StructType([*POI.fields[:3], T.StructField("nb_poi", T.LongType())])
DIM_POI = T.StructType(POI.fields[:6])

AREAS = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),
        ])),
    ])))
])


def inline(spark: SparkSession, schema: T.StructType | str, rows: Sequence[tuple]) -> DataFrame:
    """A few constant rows as a VALUES list, whose exact size the planner knows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not rows:
        return empty(spark, schema)
    literal = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else \
        f"{v!r}D" if isinstance(v, float) else "NULL" if v is None else repr(v)
    listed = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    columns = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS {f.name}"
                        for i, f in enumerate(schema.fields))
    names = ", ".join(f"c{i}" for i in range(len(schema.fields)))
    return spark.sql(f"SELECT {columns} FROM VALUES {listed} AS t({names})")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed frame without rows, standing in for a source that was not landed."""
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
                        for f in schema.fields)
    return spark.sql(f"SELECT {columns} WHERE false")

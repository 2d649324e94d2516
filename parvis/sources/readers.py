"""Landed files to DataFrames: CSV, JSON pages, JSON arrays and GeoJSON."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parvis.constants import (
    AIR_FALLBACK, AREA_BOX, AREA_CENTRES, AREA_CODES, CITY_POI, COMMUNE, DEPARTMENT,
    INCOME_FALLBACK, INCOME_NULLS, NATIONAL_POI, NATIONAL_POI_FILTER, POI_NULLS,
    TRANSACTION_NULLS,
)
from parvis.functions.casts import lenient, null_out
from parvis.functions.geometry import PARTS_TYPE, box_parts
from parvis.operators.rows import column_named, fan_out
from parvis.sources import schemas
from parvis.sources.arrays import read_array
from parvis.sources.quoted import read_csv


def _csv(spark: SparkSession, path: str, tokens: Sequence[str], sep: str) -> DataFrame:
    """A headed CSV as text columns, in whatever order, with some texts read as nulls."""
    return null_out(read_csv(spark, path, sep), list(tokens))


def read_transactions(spark: SparkSession, path: str | Sequence[str],
                      department: str = DEPARTMENT, schema: T.StructType = schemas.TRANSACTIONS,
                      partitions: int | None = None) -> DataFrame:
    """Sales of one department from (gzipped) CSV files; unreadable numbers are null.

    Columns are found by the header and all of them are kept; those of ``schema`` that the
    files lack are null. Files under one path share their header; files of several headers are
    given as several paths, and joined by name. A gzip file is read by one task, so land one
    file per year or smaller; ``partitions`` spreads the rows of few large files.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                [_csv(spark, p, TRANSACTION_NULLS, ",") for p in paths])
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields
                         if f.name not in df.columns})
    df = df.filter(F.col("code_departement") == department)
    df = df.withColumns({c: lenient(df, c, t) for c, t in schemas.TRANSACTION_NUMBERS.items()
                         if c in df.columns})
    return df.repartition(partitions) if partitions else df


def read_paged_records(spark: SparkSession, path: str, record: T.StructType | None = None
                       ) -> DataFrame:
    """All records of landed API pages ``{"page": n, "results": [...]}``, one JSON per line.

    Where to stop asking for pages is the downloading client's affair: every landed record
    counts. Without ``record`` the fields are inferred, at the cost of reading the pages once
    more; pages that hold no record at all then give a table without rows or columns of their own.
    """
    reader = spark.read
    if record is not None:
        reader = reader.schema(T.StructType([T.StructField("page", T.LongType()),
                                             T.StructField("results", T.ArrayType(record))]))
    pages = reader.json(path)
    results = pages.schema["results"].dataType if "results" in pages.columns else None
    if not (isinstance(results, T.ArrayType) and isinstance(results.elementType, T.StructType)):
        return schemas.empty(spark, schemas.NO_RECORDS)
    return pages.select(F.inline("results"))


def or_fallback(df: DataFrame, fallback: DataFrame) -> DataFrame:
    """``df``, or ``fallback`` when ``df`` has no row; decided inside the plan."""
    some = df.select(F.lit(1).alias("one")).limit(1).agg(F.count("one")).scalar()
    return df.unionByName(fallback.filter(some == 0), allowMissingColumns=True)


def read_income(spark: SparkSession, path: str, commune: str = COMMUNE) -> DataFrame:
    """The commune's income row; medians, tax shares and the fallback's figures are numbers."""
    df = _csv(spark, path, INCOME_NULLS, ";")
    code = column_named(df.columns, "codgeo", "code_insee", "commune")
    if code:
        df = df.withColumn("code_commune", F.col(f"`{code}`").cast("string")).filter(
            F.col("code_commune") == commune)
    figures = [c for c in df.columns if c.startswith(("MED", "PIMP"))
               or isinstance(INCOME_FALLBACK.get(c), float)]
    df = df.withColumns({c: lenient(df, c, "double") for c in figures})
    return or_fallback(df, income_fallback(spark))


def income_fallback(spark: SparkSession) -> DataFrame:
    """The fixed income row, for a commune that was not landed."""
    fields = [T.StructField(n, T.StringType() if isinstance(v, str) else T.DoubleType())
              for n, v in INCOME_FALLBACK.items()]
    return schemas.inline(spark, T.StructType(fields), [tuple(INCOME_FALLBACK.values())])


def income_fan_out(income: DataFrame, codes: Sequence[str] = AREA_CODES) -> DataFrame:
    """The commune's row repeated for every area."""
    return fan_out(income, "code_arrondissement", codes)


def read_air(spark: SparkSession, path: str, schema: T.StructType = schemas.AIR,
             lines: bool = False) -> DataFrame:
    """Hourly measures as text from a JSON array; fixed values when there are none.

    Arrays are read in splits (:mod:`parvis.sources.arrays`); ``lines`` reads one measure per
    line instead, which Spark splits by itself.

    ``schema`` names the fields as the file spells them, in whatever letter case.
    """
    df = spark.read.schema(schema).json(path) if lines else read_array(spark, path, schema)
    landed = df.filter(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in df.columns]).isNotNull())
    return or_fallback(landed, air_fallback(spark))


def air_fallback(spark: SparkSession) -> DataFrame:
    """The fixed air measures, for a source that was not landed."""
    fixed = [tuple(str(v) for v in row) for row in AIR_FALLBACK]
    return schemas.inline(spark, schemas.AIR, fixed)


def read_poi_csv(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A national point-of-interest CSV, filtered as its registry entry asks, and tagged."""
    df = _csv(spark, path, POI_NULLS, ";")
    column, wanted = NATIONAL_POI_FILTER.get(key, (None, None))
    if column in df.columns:
        df = df.filter(F.col(column).cast("string") == wanted)
    return tag_poi_source(df, key)


def tag_poi_source(df: DataFrame, key: str) -> DataFrame:
    """Category and subcategory of a registered source, as literals."""
    registry = {**CITY_POI, **NATIONAL_POI}
    if key not in registry:
        raise KeyError(f"unknown point-of-interest source {key!r}")
    category, subcategory = registry[key]
    return df.withColumn("category", F.lit(category)).withColumn("subcategory", F.lit(subcategory))


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """(ord, properties, kind, parts) of GeoJSON FeatureCollections, in the order of the files' names.

    ``ord`` numbers the features of a file, and goes on from file to file: its first feature
    follows the last one of the file before it, however the files are read. A file is one record, read
    by one task. Files without features give the fixed boxes around the area centres instead.
    """
    files = spark.read.schema(schemas.AREAS).option("multiLine", True).json(path).select(
        "features", F.col("_metadata.file_path").alias("file"), F.size("features").alias("n"))
    # One narrow row a file: how many features lie before it.
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    starts = files.filter("n > 0").groupBy("file").agg(F.sum("n").alias("n")).select(
        F.col("file").alias("_file"), F.coalesce(before, F.lit(0)).alias("_start"))
    features = files.select("file", F.posexplode("features").alias("pos", "feature")).join(
        starts, F.expr("file = _file")).withColumn("ord", F.expr("cast(_start + pos as int)"))
    shape = F.col("feature.geometry.coordinates")
    single = F.from_json(shape, "array<array<array<double>>>")
    parts = F.when(F.col("feature.geometry.type") == "MultiPolygon",
                   F.from_json(shape, PARTS_TYPE)).otherwise(F.array(single))
    landed = features.select("ord", F.col("feature.properties").alias("properties"),
                             F.col("feature.geometry.type").alias("kind"), parts.alias("parts"))
    return or_fallback(landed, fallback_polygons(spark))


def fallback_polygons(spark: SparkSession) -> DataFrame:
    """One box per area; neighbouring boxes overlap, so the order decides."""
    rows = [(i, code, lon, lat) for i, (code, (lon, lat))
            in enumerate(zip(AREA_CODES, AREA_CENTRES, strict=True))]
    centres = schemas.inline(spark, "ord int, code string, lon double, lat double", rows)
    number = F.right("code", F.lit(2)).cast("int").cast("string")
    return centres.select(
        "ord",
        F.create_map(
            F.lit("c_ar"), number, F.lit("code_arrondissement"), F.col("code"),
            F.lit("l_ar"), F.concat(number, F.lit("e arrondissement"))).alias("properties"),
        F.lit("Polygon").alias("kind"),
        box_parts("lon", "lat", *AREA_BOX).alias("parts"),
    )

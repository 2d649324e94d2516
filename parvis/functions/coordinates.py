"""Longitude and latitude out of the column layouts open-data portals use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parvis.constants import COORDINATE_ALIASES
from parvis.functions.casts import to_double


def extract_lon_lat(schema: T.StructType) -> tuple[Column, Column]:
    """The (lon, lat) expressions for a schema, chosen from the schema alone.

    Order: a flat pair of columns, a ``geo_point_2d`` struct, a ``geo_point_2d`` text
    ``"lat,lon"``, the first coordinates of a ``geo_shape``; without any of them both are null.
    """
    by_lower = {f.name.lower(): f for f in schema.fields}

    for lon_alias, lat_alias in COORDINATE_ALIASES:
        if lon_alias in by_lower and lat_alias in by_lower:
            return tuple(
                to_double(F.col(f"`{by_lower[a].name}`")) for a in (lon_alias, lat_alias)
            )

    if "geo_point_2d" in by_lower:
        field = by_lower["geo_point_2d"]
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StructType):
            return c.getField("lon").try_cast("double"), c.getField("lat").try_cast("double")
        pieces = F.split(c.cast("string"), ",")
        return to_double(F.get(pieces, F.lit(1))), to_double(F.get(pieces, F.lit(0)))

    if "geo_shape" in by_lower:
        pair = F.col(f"`{by_lower['geo_shape'].name}`").getField("geometry").getField("coordinates")
        kind = by_lower["geo_shape"].dataType["geometry"].dataType["coordinates"].dataType
        # A line or a polygon is placed at its first point.
        while isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
            pair, kind = F.get(pair, F.lit(0)), kind.elementType
        if isinstance(kind, T.ArrayType):
            return (F.get(pair, F.lit(0)).try_cast("double"),
                    F.get(pair, F.lit(1)).try_cast("double"))

    nothing = F.lit(None).cast("double")
    return nothing, nothing

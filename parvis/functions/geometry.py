"""Polygon arithmetic on nested arrays: polygons > rings > points > (lon, lat).

The expressions are SQL text, as nested lambdas read best that way; each function takes
column names or SQL text and returns a Column, those ending in ``_sql`` text to embed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS_TYPE = "array<array<array<array<double>>>>"
KM_PER_DEGREE = 111.0


def box_parts(lon: str, lat: str, dx: float, dy: float) -> Column:
    """A closed box around a centre, as a one-part geometry."""
    corners = ["--", "+-", "++", "-+", "--"]
    points = ", ".join(
        f"array({lon} {sx} {dx!r}D, {lat} {sy} {dy!r}D)" for sx, sy in corners)
    return F.expr(f"array(array(array({points})))")


def _edges_sql(ring: str) -> str:
    """Consecutive point pairs of a ring."""
    length = f"greatest(size({ring}) - 1, 0)"
    return (
        f"zip_with(slice({ring}, 1, {length}), slice({ring}, 2, {length}), (a, b) -> "
        "named_struct('x1', a[0], 'y1', a[1], 'x2', b[0], 'y2', b[1]))")


def parts_edges(parts: str) -> Column:
    """Edges of all rings of all parts; even-odd counting over them handles holes."""
    return F.expr(f"flatten(transform(flatten({parts}), ring -> {_edges_sql('ring')}))")


ZERO = "named_struct('a', 0D, 'x', 0D, 'y', 0D)"


def _ring_moments_sql(ring: str) -> str:
    """Unsigned area and area-weighted centre of a ring, measured from its first point."""
    x0, y0 = f"{ring}[0][0]", f"{ring}[0][1]"
    cross = f"((e.x1 - {x0}) * (e.y2 - {y0}) - (e.x2 - {x0}) * (e.y1 - {y0}))"
    centre = lambda origin, axis: (
        f"if(t.a = 0D, 0D, abs(t.a) / 2D * ({origin} + t.{axis} / (t.a * 3D)))")
    return (
        f"aggregate({_edges_sql(ring)}, {ZERO}, (t, e) -> named_struct("
        f"'a', t.a + {cross}, "
        f"'x', t.x + (e.x1 - {x0} + e.x2 - {x0}) * {cross}, "
        f"'y', t.y + (e.y1 - {y0} + e.y2 - {y0}) * {cross}), "
        f"t -> named_struct('a', abs(t.a) / 2D, 'x', {centre(x0, 'x')}, 'y', {centre(y0, 'y')}))")


def parts_moments(parts: str) -> Column:
    """Area and first moments of a geometry: outer rings count positive, holes negative."""
    signed = (
        f"flatten(transform({parts}, polygon -> transform(polygon, (ring, i) -> "
        f"named_struct('sign', if(i = 0, 1D, -1D), 'm', {_ring_moments_sql('ring')}))))")
    return F.expr(
        f"aggregate({signed}, {ZERO}, (s, r) -> named_struct("
        "'a', s.a + r.sign * r.m.a, 'x', s.x + r.sign * r.m.x, 'y', s.y + r.sign * r.m.y))")


def centroid_lon(moments: Column) -> Column:
    return moments.x / F.nullif(moments.a, F.lit(0.0))


def centroid_lat(moments: Column) -> Column:
    return moments.y / F.nullif(moments.a, F.lit(0.0))


def area_km2(moments: Column) -> Column:
    """Square degrees times 111 x 111, without a latitude correction."""
    return moments.a * KM_PER_DEGREE * KM_PER_DEGREE


def inside_sql(edges: str, x: str, y: str) -> str:
    """Even-odd containment of (x, y); a point on the outline is outside.

    Counted are the edges met by the ray from the point towards growing x.
    """
    crossing = (
        f"(e.y1 > {y}) != (e.y2 > {y}) and "
        f"{x} < e.x1 + ({y} - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)")
    touching = (
        f"(e.x2 - e.x1) * ({y} - e.y1) = (e.y2 - e.y1) * ({x} - e.x1) "
        f"and {x} between least(e.x1, e.x2) and greatest(e.x1, e.x2) "
        f"and {y} between least(e.y1, e.y2) and greatest(e.y1, e.y2)")
    return (f"(size(filter({edges}, e -> {crossing})) % 2 = 1 "
            f"and not exists({edges}, e -> {touching}))")

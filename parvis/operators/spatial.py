"""Point-to-area assignment as an equi-join on grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parvis.functions.geometry import inside_sql, parts_edges
from parvis.staging import stage

# An area is cut into cells of its own size class: 16 to 64 of them along its longer side.
CELLS_PER_SIDE = 16
CLASS_FACTOR = 4.0
# A cell that lists more areas than this is cut again, into 4 by 4, at most so many times.
MOST_LISTED, CUT, DEPTHS = 16, 4, 4
SMALLEST_SIDE = 1e-6


def _levels(areas: DataFrame) -> tuple[DataFrame, list[int]]:
    """Outlines with the level of their size class, and the levels that occur."""
    side = "greatest(x1 - x0, y1 - y0, " + repr(SMALLEST_SIDE) + "D)"
    outlines = stage(_outlines(areas).selectExpr(
        "*", f"cast(floor(log({side}) / log({CLASS_FACTOR!r}D)) as int) as level"), "outlines")
    found = outlines.select("level").distinct().orderBy("level").collect()
    return outlines, [row["level"] for row in found]


def _outlines(areas: DataFrame) -> DataFrame:
    """Areas as edges with their bounding box; an area without edges holds no point.

    Of areas with the same edges only the first can be a point's area; the others go.
    """
    spread = areas.sparkSession.sparkContext.defaultParallelism  # testing cells is the work
    return areas.select("ord", "code", parts_edges("parts").alias("edges")).filter(
        "size(edges) > 0").repartition(spread, "edges").groupBy(
        "edges", F.isnull("ord").alias("unordered")).agg(
        F.min(F.struct("ord", "code")).alias("first")).select("first.*", "edges").selectExpr(
        "ord", "code", "edges",
        "array_min(transform(edges, e -> e.x1)) as x0",
        "array_max(transform(edges, e -> e.x1)) as x1",
        "array_min(transform(edges, e -> e.y1)) as y0",
        "array_max(transform(edges, e -> e.y1)) as y1")


def _clip(near: DataFrame, size: float) -> DataFrame:
    """Rows of (cx, cy, ord, code, full, edges) with only the edges that can matter to their cell.

    Rows whose area doesn't reach the cell go; ``full`` says that the area fills it.
    The rows are staged before any is dropped, so that each is tested once: a filter on them would
    move below and work out all its columns again.
    """
    margin = size * 1e-6
    return stage(near.selectExpr(
        "cx", "cy", "ord", "code", "edges",
        f"cx * {size!r}D - {margin!r}D as west", f"(cx + 1) * {size!r}D + {margin!r}D as east",
        f"cy * {size!r}D - {margin!r}D as south", f"(cy + 1) * {size!r}D + {margin!r}D as north",
    ).selectExpr(
        "cx", "cy", "ord", "code", "west", "east", "south", "north",
        "filter(edges, e -> greatest(e.y1, e.y2) >= south and least(e.y1, e.y2) <= north "
        "and greatest(e.x1, e.x2) >= west) as edges",
    ).selectExpr(
        "*", "exists(edges, e -> least(e.x1, e.x2) <= east) as border",
    ).selectExpr(
        "cx", "cy", "ord", "code", "edges", "border",
        "not border and "
        + inside_sql("edges", "((west + east) / 2D)", "((south + north) / 2D)") + " as full",
    ), "tested").filter("border or full").drop("border")


def _before_filled(near: DataFrame) -> DataFrame:
    """Rows of each cell up to the first area that fills it, found as a sum over all of them."""
    stops = near.filter("full").groupBy("cx", "cy").agg(F.min("ord").alias("stop"))
    return near.join(stops, ["cx", "cy"], "left").filter(
        "stop is null or ord is null or ord <= stop").drop("stop")


def _cells(near: DataFrame) -> DataFrame:
    """(cx, cy, whole, candidates): the areas of each cell up to the first that fills it."""
    return near.groupBy("cx", "cy").agg(
        F.expr("min(if(full, ord, null)) as stop"),
        F.expr("array_sort(collect_list(struct(ord, code, full, edges))) as listed"),
    ).selectExpr(
        "cx", "cy",
        "if(listed[0].full, struct(listed[0].ord as ord, listed[0].code as code), null) as whole",
        "if(listed[0].full, null, filter(listed, a -> stop is null or a.ord <= stop)) "
        "as candidates")


def area_cells(outlines: DataFrame, size: float, most: int = MOST_LISTED
               ) -> list[tuple[DataFrame, float]]:
    """(cx, cy, whole, candidates) for each cell that an area reaches, and the cells' width.

    ``whole`` is (ord, code) of a cell lying entirely in its first area: its points need no
    geometry at all. Other cells list the areas to test, in area order, each with only the
    edges that can matter to a point of the cell. A cell that would list more than ``most``
    areas lists none and is cut into 16 by itself, and they in turn; each depth is a table of
    its own, and a point's cell is the deepest one that holds it. Areas with the same edges within
    a cell are one there, the first. After ``DEPTHS`` cuts, cells around a place where
    that many outlines meet list them all.
    """
    near = outlines.selectExpr(
        "*", f"explode(sequence(floor(x0 / {size!r}D), floor(x1 / {size!r}D))) as cx"
    ).selectExpr(
        "ord", "code", "edges", "cx",
        f"explode(sequence(floor(y0 / {size!r}D), floor(y1 / {size!r}D))) as cy")
    cells, width = stage(_cells(_before_filled(_clip(near, size))), "area-cells"), size
    out = []
    for _ in range(DEPTHS):
        crowded = cells.filter(F.size("candidates") > most)
        if not crowded.limit(1).count():
            break
        out.append((cells.withColumn("candidates", F.expr(
            f"if(size(candidates) > {most}, null, candidates)")), width))
        width /= CUT
        within = "explode(sequence({0} * {1}, {0} * {1} + {1} - 1)) as {0}"
        inner = crowded.selectExpr("cx", "cy", "inline(candidates)").selectExpr(
            within.format("cx", CUT), "cy", "ord", "code", "edges").selectExpr(
            "cx", within.format("cy", CUT), "ord", "code", "edges")
        once = _before_filled(_clip(inner, width)).groupBy("cx", "cy", "edges", "full").agg(
            F.min(F.struct("ord", "code")).alias("first")).select(
            "cx", "cy", "first.*", "full", "edges")
        cells = stage(_cells(once), "area-cells")
    return [*out, (cells, width)]


def spatial_join(points: DataFrame, areas: DataFrame, lon: str = "lon", lat: str = "lat",
                 code: str = "code_arrondissement", size: float | None = None) -> DataFrame:
    """``points`` plus the code of the first area (by ``ord``) that strictly contains each.

    Every input row comes out once; a point in no area or without coordinates gets null.
    ``areas`` has (ord, code, parts). Each size class of areas has a grid of its own, so a large
    area does not fill the cells of small ones, and crowded cells are cut again by themselves; a
    point looks up its cell at each depth that occurs. The cell tables are staged, so that the
    planner knows their sizes and broadcasts them when small; the points are then never shuffled.
    When one is large, both sides shuffle on the cell and cells with many points are split by
    the adaptive skew join. With ``size`` all areas share one grid.
    """
    if size is None:
        outlines, levels = _levels(areas)
        grids = [(outlines.filter(F.col("level") == k), CLASS_FACTOR**k / CELLS_PER_SIDE)
                 for k in levels]
    else:
        grids = [(_outlines(areas), size)]
    inside = inside_sql("a.edges", f"`{lon}`", f"`{lat}`")
    located, n = points, 0
    for grid, (outlines, base) in enumerate(grids):
        for depth, (cells, width) in enumerate(area_cells(outlines, base)):
            cells = cells.selectExpr(f"cx as _cx{n}", f"cy as _cy{n}", f"whole as _whole{n}",
                                     f"candidates as _near{n}")
            at = [F.expr(f"if(isnan(`{c}`), null, floor(`{c}` / {width!r}D))") for c in (lon, lat)]
            located = located.withColumns({f"_px{n}": at[0], f"_py{n}": at[1]}).join(
                cells, F.expr(f"_px{n} = _cx{n} and _py{n} = _cy{n}"), "left").drop(
                f"_px{n}", f"_py{n}", f"_cx{n}", f"_cy{n}")
            hit = F.expr(
                f"case when _whole{n} is not null then _whole{n} when _near{n} is not null then "
                f"get(transform(filter(_near{n}, a -> a.full or {inside}), "
                "a -> struct(a.ord as ord, a.code as code)), 0) end")
            # Worked out before the next join, which would have to shuffle the cell's whole list.
            own = f"_hit{grid}"
            located = located.withColumn(own, F.coalesce(own, hit) if depth else hit).drop(
                f"_whole{n}", f"_near{n}")
            n += 1
        if grid:
            located = located.withColumn("_hit0", F.least("_hit0", own)).drop(own)
    found = F.col("_hit0.code") if grids else F.lit(None).cast(areas.schema["code"].dataType)
    return located.withColumn(code, found).drop("_hit0")

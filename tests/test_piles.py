"""Piles of areas in one grid cell are cut until no cell lists many."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from parvis.operators.spatial import (MOST_LISTED, _before_filled, _outlines, area_cells,
                                      spatial_join)
from test_operators import area_frame, contains


def square(x, y, half):
    return [[[[x - half, y - half], [x + half, y - half], [x + half, y + half],
              [x - half, y + half], [x - half, y - half]]]]


def expected(shapes, points):
    return {i: next((f"c{j}" for j, s in enumerate(shapes) if contains(s, x, y)), None)
            for i, x, y in points}


@pytest.mark.parametrize("size", [None, 2.0])
def test_a_thousand_areas_around_one_place(spark, size):
    shapes = [square(0.5 + k % 3 / 64, 0.5, (k + 1) / 2048) for k in range(1000)]
    rng = random.Random(1)
    points = [(i, rng.uniform(-.1, 1.1), rng.uniform(-.1, 1.1)) for i in range(300)]
    points += [(1000 + i, rng.gauss(.5, .02), rng.gauss(.5, .02)) for i in range(200)]
    df = spark.createDataFrame(points, "i int, lon double, lat double")
    out = spatial_join(df, area_frame(spark, shapes), size=size).collect()
    assert len(out) == len(points)
    assert {r.i: r.code_arrondissement for r in out} == expected(shapes, points)


def test_no_cell_lists_more_than_the_bound(spark):
    shapes = [square(0.5, 0.5, (k // 2 + 1) / 1024) for k in range(400)]  # each one twice
    tables = area_cells(_outlines(area_frame(spark, shapes)), 1.0)
    assert len(tables) > 1
    for cells, _ in tables:
        assert (cells.agg(F.max(F.size("candidates"))).first()[0] or 0) <= MOST_LISTED
    (first, width), (second, inner) = tables[:2]
    assert inner == width / 4
    crowded = first.filter("whole is null and candidates is null")
    assert second.join(crowded.selectExpr("cx as x", "cy as y"), F.expr(
        "floor(cx / 4) = x and floor(cy / 4) = y"), "left_anti").count() == 0


def test_outlines_that_meet_in_one_place_stay_right(spark):
    rng = random.Random(5)
    shapes = [[[[[0.0, 0.0], [1.0, k / 40], [1.0, (k + 2.5) / 40], [0.0, 0.0]]]] for k in range(0, 40, 2)]
    points = [(i, rng.uniform(0, 1), rng.uniform(0, 1)) for i in range(400)]
    points += [(900 + i, rng.uniform(0, .001), rng.uniform(0, .001)) for i in range(50)]
    df = spark.createDataFrame(points, "i int, lon double, lat double")
    out = spatial_join(df, area_frame(spark, shapes), size=1.0).collect()
    assert {r.i: r.code_arrondissement for r in out} == expected(shapes, points)


def test_areas_alike_are_cut_once_and_none_is_listed_behind_the_first_that_fills(spark):
    shapes = [square(0.5, 0.5, (k * 7 % 30 + 1) / 64) for k in range(600)]
    outlines = _outlines(area_frame(spark, shapes))
    assert sorted(r["ord"] for r in outlines.select("ord").collect()) == list(range(30))
    rows = [(0, 0, 3, "c3", False, []), (0, 0, 5, "c5", True, []), (0, 0, 9, "c9", True, []),
            (0, 0, 7, "c7", False, []), (0, 1, 9, "c9", False, []), (0, 1, None, "n", False, [])]
    near = spark.createDataFrame(rows, "cx long, cy long, ord int, code string, full boolean, "
                                 "edges array<struct<x1: double, y1: double, x2: double, y2: double>>")
    kept = {(r["cy"], r["ord"]) for r in _before_filled(near).collect()}
    assert kept == {(0, 3), (0, 5), (1, 9), (1, None)}
    rng = random.Random(8)
    points = [(i, rng.uniform(0, 1), rng.uniform(0, 1)) for i in range(300)]
    out = spatial_join(spark.createDataFrame(points, "i int, lon double, lat double"),
                       area_frame(spark, shapes)).collect()
    assert {r.i: r.code_arrondissement for r in out} == expected(shapes, points)

"""Operators against brute force and hand-checked frames."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from parvis.functions import geometry as G
from parvis.operators import paging as P
from parvis.operators import rows as R
from parvis.operators import validation as V
from parvis.operators.quantiles import grouped_quantiles
from parvis.operators.spatial import CELLS_PER_SIDE, _levels, area_cells, spatial_join
from parvis.plans.serving import kpi_order
from parvis.operators.windows import dense_rank_desc, lag_delta, lag_steps, median_over
from parvis.staging import new_scratch_path



def rules():
    return {"positive": V.above("a", 0), "small": V.within("a", (0, 10)),
            "kind": V.one_of("k", ["x"])}


def test_rules_and_report(spark):
    df = spark.createDataFrame(
        [(1, "x"), (None, "x"), (-1, "y"), (11, "x"), (11, "y"), (5, None), (10, "x")],
        "a int, k string")
    assert rows(V.keep_valid(df, rules())) == [(1, "x"), (10, "x")]
    # -1/y fails two rules and counts once, at the first.
    assert V.validation_report(df, rules()).collect() == [
        (1, "positive", 2, 5), (2, "small", 2, 3), (3, "kind", 1, 2)]


def test_report_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, k string")
    assert [tuple(r)[2:] for r in V.validation_report(empty, rules()).collect()] == [(0, 0)] * 3


def quantile_cases():
    rng = random.Random(3)
    wide = [("wide", rng.uniform(-1e6, 1e6)) for _ in range(400)]
    close = [("close", 1000 + i * 1e-9) for i in range(300)]
    hot = [("hot", 7.0)] * 500 + [("hot", float(i)) for i in range(20)]
    tiny = [("one", 3.5), ("two", 1.0), ("two", 2.0), (None, 4.0), (None, 5.0), (None, 9.0)]
    nulls = [("gone", None), ("gone", None), ("part", None), ("part", 6.0)]
    return wide + close + hot + tiny + nulls


@pytest.mark.parametrize("partitions", [1, 30, 1_000_000])
def test_quantiles_equal_numpy(spark, partitions):
    """However narrow the buckets are forced to be, the result is exact."""
    data = quantile_cases()
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    out = {r.k: r for r in grouped_quantiles(
        df, ["k"], "v", {"low": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.9, "high": 1.0},
        sums={"total": "v"}, count="n", partitions=partitions).collect()}
    assert set(out) == {k for k, _ in data}
    for key in out:
        values = [v for k, v in data if k == key and v is not None]
        assert out[key].n == sum(k == key for k, _ in data)
        if not values:
            assert out[key].mid is None and out[key].total is None
            continue
        for name, q in {"low": 0, "q1": 0.25, "mid": 0.5, "q9": 0.9, "high": 1}.items():
            assert out[key][name] == pytest.approx(np.quantile(values, q), rel=1e-14, abs=1e-300)
        assert out[key].total == pytest.approx(sum(values))


def test_quantiles_over_several_keys(spark):
    df = spark.range(5000).selectExpr("id % 3 AS a", "id % 2 AS b", "CAST(id * 37 % 1009 AS DOUBLE) AS v")
    mine = grouped_quantiles(df, ["a", "b"], "v", {"m": 0.5}, partitions=500)
    theirs = df.groupBy("a", "b").agg(F.median("v").alias("m"))
    assert rows(mine) == rows(theirs)


def sales(spark, n=3000):
    # A third of all rows share group, day and price.
    return spark.range(n).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'a' ELSE concat('g', id % 5) END AS area",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id * 7 % 11 END AS day",
        "CASE WHEN id % 3 = 0 THEN 500D ELSE CAST(id * 31 % 97 AS DOUBLE) END AS price")


def test_median_over(spark):
    df = sales(spark)
    mine = median_over(df, ["area"], "price", "m")
    theirs = df.withColumn("m", F.median("price").over(Window.partitionBy("area")))
    assert rows(mine) == rows(theirs)


def test_lag_over_parts(spark):
    df = sales(spark)
    order = ["day", "id"]
    mine = lag_delta(df, ["area"], "price", order, "d")
    w = Window.partitionBy("area").orderBy(*order)
    theirs = df.withColumn("d", F.col("price") - F.lag("price").over(w))
    assert rows(mine) == rows(theirs)


def test_lag_over_many_copies(spark):
    """A third of all rows are copies of one sale; exactly one of them has a step."""
    df = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'a', concat('g', id % 2)) AS area", "if(id % 3 = 0, 4, id % 9) AS day",
        "if(id % 3 = 0, 77, id % 50) AS sale", "if(id % 3 = 0, 5D, id % 7) AS price")
    df = df.unionByName(spark.createDataFrame(
        [("a", 3, 1, 2.0), ("a", 4, 78, 9.0), ("a", 5, 1, None), ("a", 5, 1, None)],
        df.schema)).repartition(6)
    order = ["day", "sale", "price"]
    mine = lag_delta(df, ["area"], "price", order, "d")
    w = Window.partitionBy("area").orderBy(*order)
    theirs = df.withColumn("d", F.col("price") - F.lag("price").over(w))
    assert rows(mine) == rows(theirs)


def test_lag_of_rows_that_tie_but_differ_follows_the_other_columns(spark):
    df = spark.createDataFrame([("k", 1, "b", 7.0), ("k", 1, "a", 5.0), ("k", 0, "z", 4.0)],
                               "k string, day int, note string, price double")
    out = {r.note: r.d for r in lag_delta(df, ["k"], "price", ["day"], "d").collect()}
    assert out == {"z": None, "a": 1.0, "b": 2.0}


def test_narrow_lag_reads_keys_and_order_only(spark):
    """Ties with other columns, copies of the least tie, nulls and NaN, against the wide way."""
    df = spark.range(2000).selectExpr(
        "if(id % 5 = 0, null, id % 3) AS k", "id % 7 AS day",
        "CASE id % 11 WHEN 0 THEN null WHEN 1 THEN double('NaN') ELSE double(id % 4) END AS price",
        "if(id % 13 = 0, null, concat('n', id % 6)) AS note", "id % 2 AS lot").repartition(5)
    narrow = lag_delta(df, ["k"], "price", ["day", "price"], "d")
    w = Window.partitionBy("k").orderBy("day", "price", "note", "lot")
    want = df.withColumn("d", F.col("price") - F.lag("price").over(w))
    assert sorted(map(str, narrow.collect())) == sorted(map(str, want.collect()))
    assert narrow.columns == want.columns
    steps = lag_steps(df, ["k"], "price", ["day", "price"], "d")
    assert steps.columns == ["k", "day", "price", "_ties", "d"]


def test_lag_of_an_empty_table(spark):
    df = sales(spark).filter("id < 0")
    assert lag_delta(df, ["area"], "price", ["day", "id"], "d").count() == 0


def test_lag_with_text_ids_and_null_groups(spark):
    df = spark.range(500).selectExpr(
        "if(id % 3 = 0, null, id % 2) AS k", "id % 4 AS day",
        "concat('2024-', id * 7919 % 1000) AS sale", "CAST(id % 13 AS DOUBLE) AS price")
    order = ["day", "sale", "price"]
    mine = lag_delta(df, ["k"], "price", order, "d")
    w = Window.partitionBy("k").orderBy(*order)
    theirs = df.withColumn("d", F.col("price") - F.lag("price").over(w))
    assert rows(mine) == rows(theirs)


def test_lag_keeps_null_prices_apart_from_group_starts(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (2, 3, 9.0), (3, 4, 10.0)],
                               "day int, id int, price double").withColumn("k", F.lit("k"))
    out = lag_delta(df, ["k"], "price", ["day", "id"], "d").orderBy("id")
    assert [r.d for r in out.collect()] == [None, None, None, 1.0]


def test_nan_is_the_largest_value(spark):
    nan = float("nan")
    df = spark.createDataFrame([("g", v) for v in (1000.0, 2000.0, 3000.0, nan, nan)]
                               + [("h", v) for v in (1e-300, -1e-300, 1e-305, nan)],
                               "g string, v double")
    got = {r.g: r.m for r in grouped_quantiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got["g"] == 3000.0 and got["h"] == (1e-300 + 1e-305) / 2
    ranks = rows(dense_rank_desc(df.filter("g = 'g'"), ["g"], "v", "r").select("r"))
    assert ranks == [(1,), (1,), (2,), (3,), (4,)]


def test_dense_rank(spark):
    df = sales(spark).withColumn("price", F.when(F.col("id") % 50 != 0, F.col("price")))
    mine = dense_rank_desc(df, ["day"], "price", "r")
    w = Window.partitionBy("day").orderBy(F.col("price").desc_nulls_last())
    theirs = df.withColumn("r", F.when(F.col("price").isNotNull(), F.dense_rank().over(w)))
    assert rows(mine) == rows(theirs)


def ring(cx, cy, r, n, rng):
    points = [[cx + r * (0.6 + 0.4 * rng.random()) * np.cos(2 * np.pi * i / n),
               cy + r * (0.6 + 0.4 * rng.random()) * np.sin(2 * np.pi * i / n)] for i in range(n)]
    points = [[float(x), float(y)] for x, y in points]
    return [*points, points[0]]


def contains(parts, x, y):
    """Even-odd test over all rings, edge by edge; points on an edge are outside."""
    inside = False
    for polygon in parts:
        for r in polygon:
            for (x1, y1), (x2, y2) in zip(r, r[1:], strict=False):
                if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and \
                        min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                    return False
                if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                    inside = not inside
    return inside


def area_frame(spark, geometries):
    return spark.createDataFrame(
        [(i, f"c{i}", g) for i, g in enumerate(geometries)],
        f"ord int, code string, parts {G.PARTS_TYPE}")


@pytest.mark.parametrize("size", [None, 0.05, 0.7, 5.0])
def test_spatial_join_equals_brute_force(spark, size):
    rng = random.Random(11)
    shapes = []
    for i in range(12):
        cx, cy = rng.uniform(0, 3), rng.uniform(-1, 2)
        outer = ring(cx, cy, 0.6, 9, rng)
        shapes.append([[outer, ring(cx, cy, 0.15, 5, rng)]] if i % 3 else
                      [[outer], [ring(cx + 1, cy, 0.3, 6, rng)]])
    points = [(i, rng.uniform(-0.5, 4), rng.uniform(-2, 3)) for i in range(3000)]
    points += [(10_000 + i, x, y) for i, s in enumerate(shapes) for x, y in s[0][0][:3]]
    points += [(-1, None, 1.0), (-2, 1.0, None), (-3, float("nan"), 0.0), (-4, 1e6, 1e6)]
    expected = {i: next((f"c{j}" for j, s in enumerate(shapes)
                         if x is not None and y is not None and contains(s, x, y)), None)
                for i, x, y in points}
    df = spark.createDataFrame(points, "i int, lon double, lat double")
    out = spatial_join(df, area_frame(spark, shapes), size=size).collect()
    assert len(out) == len(points)
    assert {r.i: r.code_arrondissement for r in out} == expected


def test_spatial_join_without_broadcast(spark):
    """The same answers when both sides have to shuffle."""
    shapes = [[[[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]]]] * 2
    points = spark.range(1000).selectExpr("id", "id % 40 / 10D AS lon", "id % 37 / 10D AS lat")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = spatial_join(points, area_frame(spark, shapes), size=0.3)
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().toString()
        got = {r.id: r.code_arrondissement for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {i: "c0" if 0 < i % 40 < 20 and 0 < i % 37 < 20 else None for i in range(1000)}


def test_hand_set_points(spark):
    sq = lambda x, y, w: [[x, y], [x + w, y], [x + w, y + w], [x, y + w], [x, y]]
    shapes = [[[sq(0.0, 0.0, 4.0), sq(1.0, 1.0, 1.0)]], [[sq(3.0, 3.0, 3.0)]],
              [[sq(8.0, 0.0, 1.0)], [sq(10.0, 0.0, 1.0)]]]
    cases = {(0.5, 0.5): "c0", (1.5, 1.5): None, (1.0, 1.5): None, (0.0, 2.0): None,
             (4.0, 4.0): "c1", (3.5, 3.5): "c0", (5.0, 5.0): "c1", (8.5, 0.5): "c2",
             (9.5, 0.5): None, (10.5, 0.5): "c2", (0.0, 0.0): None, (50.0, 50.0): None}
    df = spark.createDataFrame(list(cases), "lon double, lat double")
    for size in (None, 0.25, 3.0):
        out = spatial_join(df, area_frame(spark, shapes), size=size).collect()
        assert {(r.lon, r.lat): r.code_arrondissement for r in out} == cases


def test_a_large_area_does_not_fill_the_cells_of_small_ones(spark):
    square = lambda x, y, w: [[[[x, y], [x + w, y], [x + w, y + w], [x, y + w], [x, y]]]]
    small = [square(float(i % 25), float(i // 25), 0.5) for i in range(500)]
    shapes = [*small, square(-1.0, -1.0, 40.0)]
    areas = area_frame(spark, shapes)
    outlines, levels = _levels(areas)
    most = max(cells.agg(F.max(F.size("candidates"))).first()[0] for k in levels for cells, _ in
               area_cells(outlines.filter(F.col("level") == k), 4.0**k / CELLS_PER_SIDE))
    assert len(levels) == 2 and most <= 4
    rng = random.Random(3)
    points = [(rng.uniform(-2, 42), rng.uniform(-2, 42)) for _ in range(400)] + \
        [(i % 25 + 0.25, i // 25 + 0.25) for i in range(0, 500, 7)]
    df = spark.createDataFrame(points, "lon double, lat double")
    got = {(r.lon, r.lat): r.code_arrondissement for r in spatial_join(df, areas).collect()}
    for (x, y), code in got.items():
        assert code == next((f"c{j}" for j, s in enumerate(shapes) if contains(s, x, y)), None)
    assert spatial_join(df, areas.filter("false")).filter("code_arrondissement IS NULL").count() \
        == len(points)


def test_inner_cells_need_no_geometry(spark):
    shapes = [[[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]]]
    areas = area_frame(spark, shapes)
    outlines, levels = _levels(areas)
    assert levels == [0]
    [(cells, _)] = area_cells(outlines, 1 / CELLS_PER_SIDE)
    whole = cells.filter("whole IS NOT NULL").count()
    assert whole / cells.count() > 0.6
    assert cells.filter("(whole IS NULL) = (candidates IS NULL)").count() == 0


def test_row_folds_and_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 4.0)], "a double, b double")
    assert rows(df.select(R.row_sum(["a", "b"]), R.row_mean(["a", "b"]))) == [(1.0, 0.5), (6.0, 3.0)]
    names = ["Id", "Code_Arrondissement", "Nombre total", "ANNEE"]
    assert R.column_containing(names, "arrond") == "Code_Arrondissement"
    assert R.column_containing(names, "nombre", "logements") == "Nombre total"
    assert R.column_named(names, "annee", "year") == "ANNEE"
    assert R.name_column(["x", "Libelle", "nom"]) == "Libelle"
    assert R.name_column(["x"]) is None


def test_zscore(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 5.0)],
                               "v double, same double")
    out = df.select(R.zscore(df, "v"), R.zscore(df, "same")).collect()
    assert [r[0] for r in out] == [-1.0, 0.0, 1.0, None]
    assert [r[1] for r in out] == [None] * 4


def test_paging(spark):
    df = spark.range(23).withColumnRenamed("id", "n")
    page = P.page_slice(df, [F.col("n")], 3, 10)
    assert [r.n for r in page.collect()] == [20, 21, 22]
    assert tuple(P.page_meta(df, 3, 10).first()) == (3, 10, 23, 3, None, 2)
    assert tuple(P.page_meta(df, 1, 10).first()) == (1, 10, 23, 3, 2, None)
    assert tuple(P.page_meta(df.filter("n < 0"), 1, 10).first()) == (1, 10, 0, 0, None, None)
    assert P.page_size(None) == 50
    assert P.page_slice(spark.range(3000), [F.col("id")], 2, 1000).count() == 1000
    assert P.page_after(spark.range(3000), ["id"], [5], 1000).count() == 1000
    with pytest.raises(ValueError):
        P.page_slice(df, [F.col("n")], 1, 0)
    with pytest.raises(ValueError):
        P.page_slice(df, [F.col("n")], 0)


def test_deep_pages_read_few_slices(spark):
    df = spark.range(5000).selectExpr(
        "if(id % 3 = 0, 'hot', if(id % 50 = 1, null, concat('k', id % 90))) AS k", "id * 7 % 5000 AS v")
    path = new_scratch_path(spark, "pages")
    P.write_pages(df, ["k"], path, slices=20)
    whole = [tuple(r) for r in df.orderBy("k", "v").collect()]
    for page, size in [(1, 30), (50, 37), (100, 50), (101, 50), (2, 4000)]:
        got = P.read_page(spark, path, page, size)
        assert [tuple(r) for r in got.collect()] == whole[(page - 1) * size:page * size]
    plan = P.read_page(spark, path, 90, 50)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_slice", plan)
    with pytest.raises(ValueError):
        P.read_page(spark, path, 0)


def test_pages_of_an_empty_table(spark):
    path = new_scratch_path(spark, "pages")
    P.write_pages(spark.range(0), ["id"], path, slices=3)
    assert P.read_page(spark, path, 1, 10).count() == 0


@pytest.mark.parametrize("descending", [False, True])
def test_nulls_sort_last_and_ties_by_code(spark, descending):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("d", None), ("c", 2.0)],
                               "code_arrondissement string, prix_m2 double")
    got = [r[0] for r in df.orderBy(*kpi_order("prix_m2", descending)).collect()]
    assert got == (["c", "a", "b", "d"] if descending else ["a", "b", "c", "d"])


def test_keyset_pages_cover_everything_once(spark):
    df = spark.range(57).selectExpr("id % 5 AS a", "id AS b")
    seen, last = [], [-1, -1]
    while page := [tuple(r) for r in P.page_after(df, ["a", "b"], last, 10).collect()]:
        seen += page
        last = list(page[-1])
    assert seen == sorted(rows(df))

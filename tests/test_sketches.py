"""Stored sketches: merged days against exact ranks, and days added later."""

from __future__ import annotations

import bisect
import random

import pytest

from parvis.plans import gold, sketches


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["75101", "75101", "75101", "75102"]), "2024-01-%02d" % (1 + k % 28),
             round(rng.lognormvariate(9, .5), 2), float(k)) for k in range(40_000)]
    df = spark.createDataFrame(rows, "code_arrondissement string, day string, prix_m2 double, "
                               "valeur_fonciere double").selectExpr(
        "code_arrondissement", "year(to_date(day)) as year", "month(to_date(day)) as month",
        "to_date(day) as date_mutation", "prix_m2", "valeur_fonciere")
    return df.cache(), [r for r in rows if 1000 <= r[2] <= 40_000]


def test_ranks_of_groups_far_above_the_size_of_a_sketch(spark, sales):
    df, rows = sales
    daily = sketches.daily_sketches(df)
    assert daily.count() == 56
    got = {r["code_arrondissement"]: r for r in sketches.stats_from_sketches(daily).collect()}
    exact = {r["code_arrondissement"]: r for r in gold.monthly_area_stats(df).collect()}
    for area, r in got.items():
        prices = sorted(p for a, _, p, _ in rows if a == area)
        assert r["nb_transactions"] == len(prices) > 40 * sketches.SIZE
        for q, c in zip(sketches.QUARTILES, ("prix_m2_p25", "prix_m2_median", "prix_m2_p75"),
                        strict=True):
            rank = bisect.bisect_left(prices, r[c]) / len(prices)
            assert abs(rank - q) < .02 and r[c] in set(prices)
        for c in ("prix_m2_moyen", "volume_eur"):
            assert r[c] == pytest.approx(exact[area][c])


def test_days_are_added_and_replaced_without_reading_the_others(spark, sales, root):
    df, _ = sales
    path = f"{root}/sketches"
    sketches.store_days(df.filter("day(date_mutation) < 20"), path)
    before = {str(p) for p in spark.read.parquet(path).inputFiles()}
    sketches.store_days(df.filter("day(date_mutation) >= 20"), path)
    sketches.store_days(df.filter("day(date_mutation) = 28"), path)
    stored = spark.read.parquet(path)
    assert before <= set(stored.inputFiles())
    assert stored.count() == 56
    whole = sketches.stats_from_sketches(sketches.daily_sketches(df))
    counts = lambda d: {tuple(r) for r in d.select(
        "code_arrondissement", "year", "month", "nb_transactions").collect()}
    assert counts(sketches.stats_from_sketches(stored)) == counts(whole)


def test_small_groups_are_exact_and_none_give_none(spark, sales):
    df, _ = sales
    few = df.limit(0)
    assert sketches.stats_from_sketches(sketches.daily_sketches(few)).count() == 0
    one = df.limit(1).selectExpr("*").withColumn("prix_m2", df.prix_m2 * 0 + 5000.0)
    r = sketches.stats_from_sketches(sketches.daily_sketches(one)).first()
    assert (r["prix_m2_p25"], r["prix_m2_median"], r["prix_m2_p75"]) == (5000.0,) * 3

"""Facts and timeline refreshed by year equal a full build and leave other files alone."""

from __future__ import annotations

from pathlib import Path

import pytest

from conftest import rows
from parvis.plans import gold, refresh
from parvis.plans.build import FACTS, TIMELINE, Build, build_layers
from parvis.sources import layout, versions
from test_build import land

SALES = "code_arrondissement string, year long, month long, prix_m2 double, valeur_fonciere double"


def files(spark, path):
    return {str(p): p.stat().st_mtime_ns for folder in versions.current(spark, path)
            for p in Path(folder).glob("*.parquet")}


def sales_of(spark, months, factor=1.0):
    return spark.createDataFrame(
        [(a, y, m, factor * (5000 + 100 * m + 10 * i), 1e5) for a, y, m in months for i in range(3)],
        SALES)


ALL = [("75101", y, m) for y in range(2018, 2024) for m in (1, 2, 12)] + [
    ("75102", y, 6) for y in range(2018, 2024)]


@pytest.mark.parametrize("years, gone, reached", [
    ([2020], [], [2020, 2021, 2022]),               # the sparse area's two next months
    ([2023], [], [2023]),
    ([2018, 2022], [], [2018, 2019, 2020, 2022, 2023]),
    ([2020], [2020], [2020, 2021, 2022]),           # a year lands without plausible sales
    ([2024], [], [2024]),
    ([], [], []),
])
def test_years_equal_the_full_build(spark, root, years, gone, reached):
    facts, series = f"{root}/facts", f"{root}/series"
    refresh.refresh_facts(sales_of(spark, ALL), facts)
    refresh.refresh_timeline(spark, facts, series)
    before = files(spark, facts), files(spark, series)

    now = [k for k in ALL if k[1] not in gone] + [("75103", y, 3) for y in years if y not in gone]
    if 2024 in years:
        now.append(("75101", 2024, 1))
    new = sales_of(spark, [k for k in now if k[1] in years], 1.5).unionByName(
        sales_of(spark, [k for k in now if k[1] not in years]))
    if years:
        refresh.refresh_facts(new, facts, years)
    assert refresh.refresh_timeline(spark, facts, series, years) == reached
    whole = gold.monthly_area_stats(new)
    assert rows(layout.read_table(spark, facts)) == rows(whole)
    assert rows(layout.read_table(spark, series)) == rows(gold.timeline_area(whole))
    for path, old, changed in ((facts, before[0], years), (series, before[1], reached)):
        kept = {f: t for f, t in old.items() if not any(f"part={y}/" in f for y in changed)}
        assert kept.items() <= files(spark, path).items()


def test_parts_of_a_whole_table_are_refused(spark, root):
    layout.create_or_replace(spark.range(3), f"{root}/t")
    with pytest.raises(ValueError):
        versions.replace_parts(spark.range(3), f"{root}/t", "id", [1])
    versions.replace_parts(spark.range(3), f"{root}/t", "id")
    versions.replace_parts(spark.range(0), f"{root}/t", "id", [0, 1])
    assert rows(layout.read_table(spark, f"{root}/t")) == [(2,)]


def test_a_table_may_lose_its_last_part_and_get_one_again(spark, root):
    path = f"{root}/t"
    versions.replace_parts(spark.range(1), path, "id")
    versions.replace_parts(spark.range(0), path, "id", [0])
    assert layout.read_table(spark, path).columns == ["id"] and rows(
        layout.read_table(spark, path)) == []
    versions.replace_parts(spark.range(7), path, "id", [5])
    assert rows(layout.read_table(spark, path)) == [(5,)]
    for _ in range(3):
        versions.replace_parts(spark.range(7), path, "id", [5])
    left = [p for p in Path(path).glob("version-*/part=*")]
    assert len(left) == 2  # of the last two states


@pytest.mark.parametrize("step", ["_write_parts", "_prepare", "_publish", "_clean"])
def test_a_writer_of_parts_that_fails_leaves_old_or_new(spark, root, monkeypatch, step):
    path = f"{root}/t"
    versions.replace_parts(spark.range(3), path, "id")

    def fail(*args):
        raise RuntimeError(step)

    monkeypatch.setattr(versions, step, fail)
    with pytest.raises(RuntimeError):
        versions.replace_parts(spark.range(0), path, "id", [1])
    assert rows(layout.read_table(spark, path)) == (
        [(0,), (2,)] if step == "_clean" else [(0,), (1,), (2,)])


def test_a_landed_year_in_the_build(spark, root, tmp_path):
    land(tmp_path, range(2019, 2022))
    build_layers(spark, root, "2024-05-03", with_poi=False)
    land(tmp_path, [2021], rows_per_month=3)
    for year in (2019, 2020):
        (tmp_path / "landing" / "dvf" / f"{year}.csv.gz").unlink()
    day = "2024-06-01"
    build_layers(spark, root, day, layers=["raw"], sources=["dvf"])
    build = Build(spark, root, day)
    facts = layout.table_path(root, "gold", FACTS)
    before = files(spark, facts)
    assert build.refresh("2024-05-03") == [2021]
    after = files(spark, facts)
    assert sum(f in after for f in before) == sum("part=2021" not in f for f in before) > 0
    refreshed = [rows(build.gold(n)) for n in (FACTS, TIMELINE)]
    assert refreshed[0]
    build_layers(spark, root, day, layers=["silver", "gold"], with_poi=False, sources=["dvf"],
                 tables=[FACTS, TIMELINE])
    for mine, name in zip(refreshed, (FACTS, TIMELINE), strict=True):
        for a, b in zip(mine, rows(build.gold(name)), strict=True):
            assert a == pytest.approx(b)
    assert build.refresh(day) == []

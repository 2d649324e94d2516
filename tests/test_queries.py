"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import pytest

from checks import standin
from checks.registry import QUERIES
from parvis.staging import stage

SF = "/root/testdata/sf0.001"


def once(fn):
    """Keep the rows of an expensive stand-in table for the other queries of this run."""
    kept = {}

    def get(spark, sf, *built):
        if sf not in kept:
            kept[sf] = stage(fn(spark, sf), fn.__name__)
        return kept[sf]

    return get


for _name in ("monthly", "poi", "units", "air", "kpi", "timeline"):
    setattr(standin, _name, once(getattr(standin, _name)))

import __spark_entry__ as entry  # noqa: E402
from compare import connect, difference  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    mine = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(mine) > 0
        return
    assert difference(mine, con.execute(sql).df()) is None


@pytest.mark.parametrize("name", ["spatial_join", "silver_transactions", "kpi_area"])
def test_same_answers_when_nothing_is_small_enough_to_broadcast(spark, con, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        mine = entry.queries()[name](spark, SF).toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert difference(mine, con.execute(entry.oracle_sql()[name]).df()) is None


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_pairs_everything_or_runs_python_rows(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEvalType", "ArrowEval",
                     "BatchEvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def test_filters_and_columns_reach_the_scan(spark):
    from parvis.operators import validation as V
    from parvis.plans import silver

    kept = V.keep_valid(silver.typed_transactions(standin.sales_raw(spark, SF)),
                        silver.transaction_rules()).select("valeur_fonciere")
    text = plan(kept)
    assert "GreaterThanOrEqual(l_extendedprice,50000.0)" in text
    assert "GreaterThan(l_quantity,9.0)" in text
    assert "l_discount" not in text and "l_tax" not in text


def test_points_are_not_shuffled_by_the_spatial_join(spark):
    text = plan(entry.queries()["spatial_join"](spark, SF))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_latest_snapshot_reads_one_partition(spark):
    text = entry.queries()["scan_latest_snapshot"](spark, SF)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(" in text and "= 2024-05-03)" in text
    assert "Subquery" not in text

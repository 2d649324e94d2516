"""The report counted while the kept rows are written."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import rows
from parvis.operators import validation as V

def rules():
    return {"a": V.above("id", 9), "b": V.within("id", (0, 60)), "even": F.col("id") % 2 == 0}


@pytest.mark.parametrize("many", [0, 100])
def test_same_report_from_one_scan(spark, root, many):
    spark.range(many).write.parquet(f"{root}/in")
    df, seen = spark.read.parquet(f"{root}/in"), Observation()
    kept = V.keep_valid_observed(df, rules(), seen)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "CollectMetrics" in plan
    kept.write.parquet(f"{root}/out")
    assert rows(spark.read.parquet(f"{root}/out")) == rows(V.keep_valid(df, rules()))
    assert rows(V.observed_report(spark, seen, rules()), 1) == rows(V.validation_report(df, rules()), 1)


def test_undecided_rules_reject(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (12.0,), (-1.0,)], "id double")
    one, seen = {"a": V.above("id", 9)}, Observation()
    assert V.keep_valid_observed(df, one, seen).count() == 1
    assert V.observed_report(spark, seen, one).first().rejected == 3

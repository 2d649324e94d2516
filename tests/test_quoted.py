"""CSV with line breaks in values, read in splits, against one task a file."""

from __future__ import annotations

import csv
import random
from contextlib import contextmanager

import pytest

from parvis.sources import quoted
from parvis.sources.readers import read_transactions

WORDS = ["a", "b c", 'say ""x""', "1,2", "line\nbreak", "two\n\nbreaks", "\r\n", "é", "", "NA",
         "x" * 300, '"\n"', "\n", "\n" * 40]


@contextmanager
def small_splits(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in keys:
            spark.conf.unset(key)


def one_task(spark, path, sep=","):
    return spark.read.options(header=True, sep=sep, multiLine=True, **quoted.FORMAT).csv(path)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def land(path, rows, names=("k", "one", "two"), sep=",", end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, delimiter=sep, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
        out.writerow(names)
        out.writerows(rows)


@pytest.mark.parametrize(("size", "sep", "end"), [(300, ",", "\n"), (997, ";", "\r\n")])
def test_splits_give_the_rows_of_one_task(spark, root, size, sep, end):
    rng = random.Random(size)
    rows = [(k, rng.choice(WORDS), rng.choice(WORDS)) for k in range(400)]
    for n in range(2):
        land(f"{root}/{n}.csv", rows[n::2], sep=sep, end=end)
    with small_splits(spark, size):
        df = quoted.read_csv(spark, root, sep)
        assert df.rdd.getNumPartitions() > 4
        assert listed(df) == listed(one_task(spark, root, sep))
        assert df.columns == ["k", "one", "two"] and df.count() == len(rows)


def test_one_value_over_many_splits_and_one_at_each_end(spark, root):
    rows = [(1, "long\n" * 900, "x"), (2, "y", "z\n" * 500), (3, "", "q")]
    land(f"{root}/a.csv", rows)
    with small_splits(spark, 128):
        assert listed(quoted.read_csv(spark, root)) == listed(one_task(spark, root))


def test_plain_files_use_the_own_reader_of_spark(spark, root):
    land(f"{root}/a.csv", [(k, "u,v", 'w "q"') for k in range(500)])
    with small_splits(spark, 512):
        df = quoted.read_csv(spark, root)
        assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.rdd.getNumPartitions() > 4 and listed(df) == listed(one_task(spark, root))


@pytest.mark.parametrize("text", ['k,one\n1,5" wide\n2,"a\nb"\n', 'k,one\n1,"open\n2,b\n'])
def test_quotes_out_of_place_are_left_to_one_task(spark, root, text):
    with open(f"{root}/a.csv", "w", encoding="utf-8") as file:
        file.write(text)
    with small_splits(spark, 8):
        assert listed(quoted.read_csv(spark, root)) == listed(one_task(spark, root))


def test_short_rows_blank_lines_and_no_rows(spark, root):
    with open(f"{root}/a.csv", "w", encoding="utf-8") as file:
        file.write('﻿k,one,two\n1\n\n2,"p\nq"\n3,,"",extra\n')
    with small_splits(spark, 8):
        assert listed(quoted.read_csv(spark, f"{root}/a.csv")) == listed(
            one_task(spark, f"{root}/a.csv"))
    land(f"{root}/b.csv", [])
    assert quoted.read_csv(spark, f"{root}/b.csv").count() == 0


def test_sales_with_line_breaks(spark, root):
    names = ["code_departement", "valeur_fonciere", "adresse"]
    land(f"{root}/a.csv", [("75", k, f"{k} rue\nA") for k in range(400)], names)
    with small_splits(spark, 300):
        got = read_transactions(spark, f"{root}/a.csv")
        assert got.rdd.getNumPartitions() > 4
        assert {r["adresse"]: r["valeur_fonciere"] for r in got.collect()} == {
            f"{k} rue\nA": float(k) for k in range(400)}

"""Where a query meets its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
CTES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use any named part of :data:`CTES`."""
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_parts(sql)
        return fn
    return keep


def part(name: str, sql: str) -> None:
    CTES[name] = sql


def with_parts(sql: str) -> str:
    """``sql`` preceded by the parts it uses, directly or through other parts."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(sql)
    chain = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {chain}\n{sql}" if chain else sql


# Both engines cut results to a grid with the same arithmetic. Its boundaries are shifted off
# the halves, on which quotients of cents by small numbers often lie exactly: there, the last
# bit of two equally good sums would decide.
SHIFT = 0.3


def rnd_sql(expr: str, digits: int) -> str:
    return f"floor(({expr}) * 1e{digits} + {SHIFT}e0) / 1e{digits}"


def rnd(column: str | Column, digits: int) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.floor(c * F.lit(10.0**digits) + F.lit(SHIFT)) / F.lit(10.0**digits)


# Sums of money are whole cents, but large; the given digits would exceed a double.
MONEY = {"volume_eur": 2}


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: rnd(n, MONEY.get(n, digits)) for n in names})


def rounded_sql(digits: int, *names: str) -> str:
    return ", ".join(f"{rnd_sql(n, MONEY.get(n, digits))} AS {n}" for n in names)

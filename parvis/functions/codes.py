"""Area codes, labels and month keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from parvis.constants import AREA_PREFIX

# Three callers rank the code fields differently; each order is kept.
JOIN_PRECEDENCE = ("code_arrondissement", "c_arinsee", "c_ar")
DIM_PRECEDENCE = ("code_arrondissement", "c_ar")
SERVING_PRECEDENCE = ("code_arrondissement", "c_ar", "c_arinsee")


def normalize_area_code(number: Column) -> Column:
    """Area number to code: at least two digits behind the prefix, unreadable is null."""
    n = number.try_cast("bigint")
    return F.when(n.isNotNull(), F.format_string(f"{AREA_PREFIX}%02d", n))


def resolve_area_code(precedence: Sequence[str], available: Sequence[str]) -> Column:
    """First non-empty code field of ``precedence``; ``c_ar`` is a number and gets its prefix."""
    picks = []
    for name in precedence:
        if name not in available:
            continue
        text = F.nullif(F.col(name).cast("string"), F.lit(""))
        picks.append(normalize_area_code(text) if name == "c_ar" else text)
    return F.coalesce(*picks) if picks else F.lit(None).cast("string")


def extract_area_number(text: Column) -> Column:
    """First run of digits, zero-padded to two and prefixed; longer runs are kept whole."""
    digits = F.nullif(F.regexp_extract(text.cast("string"), r"(\d+)", 1), F.lit(""))
    padded = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    return F.concat(F.lit(AREA_PREFIX), padded)


def area_label(name: Column, code: Column) -> Column:
    """The given name, else the area number followed by ``e``."""
    number = F.right(code, F.lit(2)).try_cast("int")
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(number.cast("string"), F.lit("e")))


def year_month_key(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))

"""Casts that turn what they cannot read into null, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_double(c: Column) -> Column:
    """Decimal number or null.

    Java also reads suffixes (1d, 1f), hexadecimal numbers (0x1p3), NaN and Infinity; their
    letters are made unreadable first.
    """
    return F.translate(c.cast("string"), "dDfFxXpPnN", "??????????").try_cast("double")


def to_long(c: Column) -> Column:
    """Whole number or null; a text with a decimal point is null."""
    return c.try_cast("bigint")


def to_iso_date(c: Column) -> Column:
    """``yyyy-MM-dd`` or null."""
    return F.try_to_date(c, "yyyy-MM-dd")


def lenient(df: DataFrame, name: str, as_type: str) -> Column:
    """Lenient cast of column ``name``, skipping the text route where it is numeric already."""
    c = F.col(name)
    numeric = isinstance(df.schema[name].dataType, T.NumericType)
    if as_type == "double":
        return c.cast("double") if numeric else to_double(c)
    if as_type == "long":
        return to_long(c)
    if as_type == "date":
        return c if isinstance(df.schema[name].dataType, T.DateType) else to_iso_date(c)
    raise ValueError(f"unknown lenient type {as_type!r}")


def null_out(df: DataFrame, tokens: list[str]) -> DataFrame:
    """Text columns with every value found in ``tokens`` set to null."""
    return df.select([
        F.when(~F.col(f"`{f.name}`").isin(tokens), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])

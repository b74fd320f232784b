"""Numeric conversions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trunc_int(column: str | Column) -> Column:
    """Number to 32-bit int, cut toward zero; NaN and out of range give null."""
    value = F.col(column) if isinstance(column, str) else column
    # A range test costs less than a failing cast. NaN is above every number.
    return F.when((value > -(2.0**31) - 1) & (value < 2.0**31), value.cast("int"))

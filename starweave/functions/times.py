"""Time stamps from text, and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The accepted text, date 'T' time '+' fraction of a second.
STAMP = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\+\d{1,6}$"


def parse_timestamp(text: str | Column, strict: bool = False) -> Column:
    """``2017-11-26T20:59:40+0900`` to a zone-free time stamp.

    The digits after ``+`` are a fraction of a second, not a zone: the example
    is 20:59:40.09. Unreadable text gives null, or an error with ``strict``.
    The result does not depend on the session zone.
    """
    value = F.col(text) if isinstance(text, str) else text
    parsed = F.when(value.rlike(STAMP), F.replace(value, F.lit("+"), F.lit("."))).try_cast(
        "timestamp_ntz"
    )
    if not strict:
        return parsed
    message = F.concat(F.lit("unreadable time stamp: "), value)
    return F.when(value.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(message).cast("timestamp_ntz")
    )


def has_fraction(text: str | Column) -> Column:
    """True where the suffix is not zero, so perhaps meant as a zone offset."""
    value = F.col(text) if isinstance(text, str) else text
    return F.substring_index(value, "+", -1).rlike("[1-9]")


def date_parts(column: str | Column) -> dict[str, Column]:
    """Calendar year, month, hour, ISO week and weekday (Sunday is 1).

    The ISO week of early January can belong to the year before: 2017-01-01 is
    year 2017, week 52.
    """
    value = F.col(column) if isinstance(column, str) else column
    return {
        "year": F.year(value),
        "month": F.month(value),
        "hour": F.hour(value),
        "week": F.weekofyear(value),
        "weekday": F.dayofweek(value),
    }

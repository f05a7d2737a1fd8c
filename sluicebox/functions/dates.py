"""Date parsing and calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_date(name: str) -> Column:
    return F.col(name).try_cast("date")


def to_timestamp(name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def today_or(as_of: date | str | None) -> Column:
    """The reporting date: a fixed day for repeatable runs, else the current date."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def month_start(name: str) -> Column:
    return F.trunc(F.col(name), "month")


def calendar(name: str) -> dict[str, Column]:
    """Day of week counted from Monday = 0, month, ISO week."""
    day = F.col(name)
    return {
        "day_of_week": F.weekday(day),
        "month": F.month(day),
        "week_of_year": F.weekofyear(day),
    }

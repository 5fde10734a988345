"""Week bounds (ISO weeks, Monday start)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_start(c) -> Column:
    """Monday 00:00 of the week holding ``c``, as TIMESTAMP_NTZ.

    Built from the date, so the session time zone plays no part (``date_trunc``
    would return a zoned TIMESTAMP).
    """
    d = F.to_date(_c(c))
    return F.date_sub(d, F.weekday(d)).cast("timestamp_ntz")


def week_end(c) -> Column:
    """Week start plus six days (the Sunday, at 00:00)."""
    return week_start(c) + F.expr("INTERVAL 6 DAYS")


def iso_week(c) -> Column:
    """ISO-8601 week number of ``c`` (1..53)."""
    return F.weekofyear(F.to_date(_c(c)))

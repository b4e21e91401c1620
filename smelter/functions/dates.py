"""Dates kept as yyyymmdd integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted span of yyyymmdd integers.
FIRST_DAY, LAST_DAY = 19000101, 20500101
FIRST_YEAR_DAY, LAST_YEAR_DAY = 10000101, 99991231  # eight digits


def int_to_date(c: Column) -> Column:
    """DATE of a yyyymmdd integer; NULL for 0 and whatever is no eight-digit calendar day.

    Plain arithmetic rather than text parsing: it stays in generated code and is several times as fast. A day past
    the end of its month runs over into the next one, which the month comparison finds.
    """
    year, month, day = F.floor(c / 10000), F.floor(c / 100) % 100, c % 100
    in_range = c.between(FIRST_YEAR_DAY, LAST_YEAR_DAY) & month.between(1, 12) & day.between(1, 31)
    first = F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
    candidate = F.when(in_range, F.date_add(first, (day - 1).cast("int")))
    return F.when(F.month(candidate) == month, candidate)


def is_invalid_day(c: Column) -> Column:
    """True for an integer that is not positive, not eight digits long or outside the accepted span."""
    return (c <= 0) | (F.length(c.cast("string")) != 8) | (c > LAST_DAY) | (c < FIRST_DAY)

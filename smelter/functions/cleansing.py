"""Column rules for cleansing. Every function takes and returns a Column."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source codes and their labels.
UNKNOWN = "n/a"
MARITAL_STATUS = {"M": "Married", "S": "Single"}
GENDER = {"M": "Male", "F": "Female"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}


def today(as_of: dt.date | None) -> Column:
    """The day the run counts as "now"; the current date unless one is given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def normalised(c: Column) -> Column:
    return F.upper(F.trim(c))


def code_label(c: Column, labels: dict[str, str], default: str | None = None) -> Column:
    """Label of a code, whatever its case and outer blanks.

    Unlisted codes and NULL become ``default``; without a default they pass through trimmed.
    """
    code = normalised(c)
    label = F
    for value, text in labels.items():
        label = label.when(code == value, F.lit(text))
    return label.otherwise(F.trim(c) if default is None else F.lit(default))


def future_flag(c: Column, as_of: dt.date | None = None) -> Column:
    """1 for a date after ``as_of``, else 0, also for NULL."""
    return F.when(c > today(as_of), 1).otherwise(0)


def number_or_default(c: Column, lowest: int, default: int) -> Column:
    """``default`` for NULL and for values under the lowest valid one."""
    return F.when(c.isNull() | (c < lowest), F.lit(default)).otherwise(c)


def end_or_null(start: Column, end: Column) -> Column:
    """NULL for an end before its start."""
    return F.when(end < start, F.lit(None)).otherwise(end)


def known_or(c: Column, fallback: Column, sentinel: str = UNKNOWN) -> Column:
    """The preferred source's value, or the fallback's where it is NULL or the sentinel."""
    return F.coalesce(F.nullif(c, F.lit(sentinel)), fallback)


def is_untrimmed(c: Column) -> Column:
    """True for text with outer blanks, leading or trailing."""
    return c != F.trim(c)

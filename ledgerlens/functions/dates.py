"""Date parsing and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col
from .text import strip_ws

# Accepted date layouts, tried in this order (month-first wins).
DATE_FORMATS = ("M/d/yyyy", "d/M/yyyy", "yyyy-M-d", "M-d-yyyy", "d.M.yyyy")
# One- or two-digit day and month, exactly four-digit year.
DATE_SHAPE = r"^(\d{1,2}[/.\-]\d{1,2}[/.\-]\d{4}|\d{4}-\d{1,2}-\d{1,2})$"


def _try_format(s: Column, fmt: str) -> Column:
    """The date, tried only where the text holds the layout's separator: each failed attempt costs an exception."""
    sep = next((ch for ch in fmt if not ch.isalpha()), "")
    return F.when(s.contains(sep), F.try_to_date(s, fmt))


def parse_date(c, formats=DATE_FORMATS) -> Column:
    """Strip, then the first layout that parses; else null."""
    s = strip_ws(as_col(c).cast("string"))
    parsed = F.coalesce(*[_try_format(s, f) for f in formats])
    return F.when(s.rlike(DATE_SHAPE), parsed)


def date_parts(d) -> dict[str, Column]:
    """Year, month, day, weekday (Monday = 0), quarter; all 0 when there is no date."""
    d = as_col(d)
    z = F.lit(0)
    return {
        "year": F.coalesce(F.year(d), z),
        "month": F.coalesce(F.month(d), z),
        "day": F.coalesce(F.dayofmonth(d), z),
        "weekday": F.coalesce(F.weekday(d), z),
        "quarter": F.coalesce(F.quarter(d), z),
    }


def days_between(due, issued) -> Column:
    """Due - issued in days; 0 if either is missing; may be negative."""
    return F.coalesce(F.datediff(as_col(due), as_col(issued)), F.lit(0))

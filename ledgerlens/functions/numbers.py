"""Number parsing and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def parse_number(c) -> Column:
    """B2: text -> double.

    null/empty -> 0.0; keep only digits, '.', ',' and '-'; ',' -> '.'; anything
    that is then not a plain number (two dots, a stray '-') -> 0.0. ``try_cast``
    never raises under ANSI mode.
    """
    s = as_col(c).cast("string")
    kept = F.regexp_replace(s, r"[^0-9.,\-]", "")
    dotted = F.replace(kept, F.lit(","), F.lit("."))
    return F.coalesce(dotted.try_cast("double"), F.lit(0.0))


def safe_ratio(a, b) -> Column:
    """A / b when b > 0, else 0.0."""
    a, b = as_col(a), as_col(b)
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))

"""Date text, month keys and day differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts tried in order for free-format dates.
DATE_LAYOUTS = ("M/d/yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm", "M-d-yyyy", "MMM d, yyyy")


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_us_date(col: str | Column) -> Column:
    """Month/day/year text; anything else is null."""
    return F.try_to_date(F.trim(_col(col)), "M/d/yyyy")


def parse_any_date(col: str | Column) -> Column:
    """First layout of :data:`DATE_LAYOUTS` that fits, else null."""
    text = F.trim(_col(col))
    return F.coalesce(*[F.try_to_date(text, layout) for layout in DATE_LAYOUTS])


def as_date(value: str | dt.date | Column) -> Column:
    """A date literal from ISO text or a date; columns pass through."""
    if isinstance(value, Column):
        return value
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def month_key(col: str | Column) -> Column:
    """``2025-09``: sorts in time order."""
    return F.date_format(_col(col), "yyyy-MM")


def month_label(col: str | Column) -> Column:
    """``September 2025``: a label, never a sort key."""
    return F.date_format(_col(col), "MMMM yyyy")


def month_bounds(month: str) -> tuple[dt.date, dt.date]:
    """First day of ``YYYY-MM`` and of the month after it."""
    first = dt.date.fromisoformat(f"{month}-01")
    after = dt.date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return first, after


def in_month(col: str | Column, month: str) -> Column:
    """Half-open range on the bare column, so the test reaches the scan as a pushed filter."""
    first, after = month_bounds(month)
    value = _col(col)
    return (value >= F.lit(first)) & (value < F.lit(after))


def days_since(as_of: str | dt.date | Column, col: str | Column) -> Column:
    return F.datediff(as_date(as_of), _col(col))

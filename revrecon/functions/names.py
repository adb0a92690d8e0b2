"""Person names and birth dates as match keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def name_upper(col: str | Column) -> Column:
    """Trimmed and upper-cased; null and blank become ''."""
    return F.upper(F.trim(F.coalesce(_col(col), F.lit(""))))


def name_collapsed(col: str | Column) -> Column:
    """As :func:`name_upper`, with runs of white space collapsed to one blank; text ``nan`` is blank."""
    raw = F.coalesce(_col(col), F.lit(""))
    return F.trim(F.regexp_replace(F.upper(F.when(raw == "nan", "").otherwise(raw)), r"\s+", " "))


def name_flipped(col: str | Column) -> Column:
    """``Last, First`` -> ``FIRST LAST``; a name without a comma is only upper-cased."""
    upper = name_upper(col)
    parts = F.split(upper, ",", 2)
    flipped = F.trim(F.concat_ws(" ", F.trim(F.get(parts, F.lit(1))), F.trim(F.get(parts, F.lit(0)))))
    return F.when(upper.contains(","), flipped).otherwise(upper)


def first_last(name: str | Column) -> Column:
    """First and last token of a normalised name; null when it has fewer than two tokens."""
    tokens = F.split(_col(name), r"\s+")
    return F.when(
        F.size(tokens) >= 2,
        F.concat_ws(" ", F.get(tokens, F.lit(0)), F.get(tokens, F.size(tokens) - 1)),
    )


def dob_text(col: str | Column) -> Column:
    """``09/01/2025`` -> ``9/1/2025``; other text is only trimmed; null and ``nan`` become ''."""
    raw = F.coalesce(_col(col), F.lit(""))
    text = F.trim(F.when(raw == "nan", "").otherwise(raw))
    pattern = r"^(\d{1,2})/(\d{1,2})/(\d{2,4})"
    pieces = F.concat_ws(
        "/",
        F.regexp_extract(text, pattern, 1).try_cast("int").cast("string"),
        F.regexp_extract(text, pattern, 2).try_cast("int").cast("string"),
        F.regexp_extract(text, pattern, 3),
    )
    return F.when(text.rlike(pattern), pieces).otherwise(text)

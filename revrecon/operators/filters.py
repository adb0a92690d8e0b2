"""Row filters, derived columns and table descriptions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrecon.functions import labels
from revrecon.functions.dates import as_date, in_month


def filter_date_range(
    df: DataFrame,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    column: str = "dos",
) -> DataFrame:
    """start <= date <= end; null dates are out as soon as one end is given."""
    if start is not None:
        df = df.filter(F.col(column) >= as_date(start))
    if end is not None:
        df = df.filter(F.col(column) <= as_date(end))
    return df


def filter_month(df: DataFrame, month: str, column: str = "dos") -> DataFrame:
    """Rows of one calendar month given as ``YYYY-MM``."""
    return df.filter(in_month(column, month))


def claims_facility_filter(claims: DataFrame, offices: Sequence[str]) -> DataFrame:
    """Only claims of the listed offices; third-party offices are dropped at the scan."""
    return claims.filter(F.col("office").isin(*offices))


def commercial_filter(visits: DataFrame) -> DataFrame:
    """Commercial visits (visit type contains COM) in a billing stage."""
    return visits.filter(labels.is_commercial() & labels.is_billing())


def allowed_identity_check(visits: DataFrame) -> DataFrame:
    """Visits where allowed + not allowed differs from the billed amount."""
    return visits.filter(
        F.col("primary_allowed") + F.col("primary_not_allowed") != F.col("last_billed")
    )


def head_sample(df: DataFrame, n: int = 5, order: str = "row_no") -> DataFrame:
    """First n rows in file order (a top-n per task, then of the tasks' winners)."""
    return df.orderBy(order).limit(n)


def table_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, with the table's row and column counts."""
    fields = df.schema.fields
    described = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return (
        df.agg(F.count("*").alias("row_count"))
        .select("row_count", F.lit(len(fields)).cast("long").alias("column_count"), F.explode(described).alias("f"))
        .select("f.position", "f.column_name", "f.data_type", "row_count", "column_count")
    )

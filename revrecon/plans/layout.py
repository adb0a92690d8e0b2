"""How the fact tables are stored, so that the month filters of the reports skip files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def store_by_date(df: DataFrame, path: str, date_column: str, tie_column: str = "row_no", mode: str = "error") -> None:
    """Parquet files that each cover a narrow range of dates.

    Range partitioning on (date, tie) lets one busy day spread over several files, and sorted files
    carry tight min/max statistics: a filter on one month reads that month's files only.
    """
    ranged = df.repartitionByRange(F.col(date_column), F.col(tie_column))
    ranged.sortWithinPartitions(date_column, tie_column).write.mode(mode).parquet(path)

"""Removal of identifying columns from matched claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrecon import rules

ID_COLUMN = "Patient Account Number"


def deid_split(matched: DataFrame, id_column: str = "match_id") -> DataFrame:
    """Claims with needs_follow_up: true for UNMATCHED and CLOSE_MATCH."""
    return matched.withColumn(
        "needs_follow_up", F.col(f"`{id_column}`").isin(rules.UNMATCHED, rules.CLOSE_MATCH)
    )


def deid_counts(matched: DataFrame, id_column: str = "match_id") -> DataFrame:
    """One row: total, matched, follow-up."""
    return deid_split(matched, id_column).agg(
        F.count("*").alias("total_records"),
        F.count_if(~F.col("needs_follow_up")).alias("matched_records"),
        F.count_if(F.col("needs_follow_up")).alias("follow_up_records"),
    )


def follow_up(matched: DataFrame, id_column: str = "match_id") -> DataFrame:
    """Rows for manual research; names stay in."""
    return deid_split(matched, id_column).filter("needs_follow_up").drop("needs_follow_up")


def phi_columns(columns: list[str]) -> list[str]:
    """Columns to drop: an identifying pattern in the lower-case name, the id and service date never."""
    def identifying(name: str) -> bool:
        lower = name.lower()
        kept = any(k in lower for k in rules.PHI_KEEP)
        return not kept and any(p in lower for p in rules.PHI_PATTERNS)

    return [c for c in columns if identifying(c)]


def deidentify(matched: DataFrame, id_column: str = "match_id") -> DataFrame:
    """All rows without identifying columns; the id column gets its common name.

    A plain projection: the dropped columns are never read from a columnar source.
    """
    renamed = matched.withColumnRenamed(id_column, ID_COLUMN)
    return renamed.drop(*phi_columns(renamed.columns))


def phi_leak_check(df: DataFrame) -> DataFrame:
    """Problems left in a de-identified table: (problem, column_name, n_rows); empty when it is clean.

    ``n_rows`` counts the rows that carry a value in the offending column, or all rows when the id
    column is missing; every column is counted in one pass.
    """
    names = [(c, c.lower()) for c in df.columns]
    problems = [("patient name column", c, F.count(F.col(f"`{c}`"))) for c, low in names if "patient" in low and "name" in low]
    problems += [
        ("birth date column", c, F.count(F.col(f"`{c}`")))
        for c, low in names
        if ("birth" in low or "dob" in low) and "account" not in low
    ]
    if ID_COLUMN not in df.columns:
        problems.append(("id column missing", ID_COLUMN, F.count("*")))
    if not problems:
        return df.sparkSession.createDataFrame([], "problem string, column_name string, n_rows bigint")
    counts = df.agg(*[n.alias(f"n{i}") for i, (_, _, n) in enumerate(problems)])
    rows = [
        F.struct(F.lit(p).alias("problem"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_rows"))
        for i, (p, c, _) in enumerate(problems)
    ]
    return counts.select(F.inline(F.array(*rows)))

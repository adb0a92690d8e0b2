"""Profit-and-loss sheets: wide text with section labels -> long rows.

A sheet becomes cells (facility, sheet, row_no, label, month, text) without any step on the driver:
every file brings its own header line and its own months, and all files are read in one scan. A
facility may have many sheets, one per year for instance.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revrecon import rules
from revrecon.functions.money import ledger_amount, parse_money
from revrecon.operators.lookups import lookup
from revrecon.sources.files import file_of_row, numbered

MONTH_CELL = (
    r"^(January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{4}$"
)
# a comma with an even number of quotes behind it
_SEPARATOR = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _cells(line: str) -> Column:
    parts = F.split(F.regexp_replace(line, r"\r$", ""), _SEPARATOR, -1)
    return F.transform(parts, lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r'^"|"$', ""), '""', '"')))


def read_pl_cells(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """P&L files by facility -> cells below the header line, one per row and month column.

    The header line of a file is its first line with three or more ``Month YYYY`` cells; a file
    without one is an error. ``sheet`` is the file's number.
    """
    raw = spark.read.text(list(paths.values()))
    lines = numbered(raw, _cells("value").alias("cells"), facilities=paths).withColumn("sheet", file_of_row())
    months = F.filter(
        F.transform(
            "cells",
            lambda c, i: F.struct(
                i.alias("at"),
                F.when(c.rlike(MONTH_CELL), F.date_format(F.try_to_date(c, "MMMM yyyy"), "yyyy-MM")).alias("month"),
            ),
        ),
        lambda m: m["month"].isNotNull(),
    )
    headers = (
        lines.withColumn("months", months)
        .filter(F.size("months") >= 3)
        .groupBy("sheet")
        .agg(F.min("row_no").alias("header_row"), F.min_by("months", "row_no").alias("months"))
    )
    missing = F.raise_error(F.concat(F.lit("no line of months in a sheet of "), F.col("facility"))).cast("long")
    keys = ["facility", "sheet", "row_no"]
    return (
        lookup(lines, headers, ["sheet"])
        .filter(F.col("row_no") > F.coalesce("header_row", missing))
        .select(*keys, F.get("cells", F.lit(0)).alias("label"), "cells", F.explode_outer("months").alias("m"))
        .select(*keys, "label", "m.month", F.get("cells", F.col("m.at")).alias("text"))
    )


def pl_cells(sheets: DataFrame, months: Mapping[str, str], year: str | None = None) -> DataFrame:
    """A wide table (facility, row_no, label, one text column per key of ``months``) as cells.

    With ``year``, a column of that name tells the sheets of a facility apart, and ``months`` gives the
    month within it (``01`` to ``12``).
    """
    keys = F.create_map(*[F.lit(x) for pair in months.items() for x in pair])
    month = F.try_element_at(keys, F.col("cell"))
    if year:
        month = F.concat(F.col(year).cast("string"), F.lit("-"), month)
    numbered_sheets = sheets.withColumn("sheet", (F.col(year) if year else F.lit(0)).cast("long"))
    ids = list(dict.fromkeys(["facility", "sheet", "row_no", "label", *([year] if year else [])]))
    return numbered_sheets.unpivot(ids, list(months), "cell", "text").select(
        "facility", "sheet", "row_no", "label", month.alias("month"), "text"
    )


def pl_long(cells: DataFrame, patient_categories: Sequence[str]) -> DataFrame:
    """Cells -> one row per category and month with an amount other than 0.

    The open section is carried down the sheet by a window. Its partition is one sheet of one facility,
    that is the length of a chart of accounts, and does not grow with the number of transactions.
    """
    label = F.trim(F.coalesce("label", F.lit("")))
    marker = F.when(label.isin(*rules.PL_CLOSING_LABELS), F.lit("")).when(label.isin(*rules.PL_SECTIONS), label)
    down = Window.partitionBy("facility", "sheet").orderBy("row_no")
    kinds = F.create_map(*[F.lit(x) for pair in rules.PL_SECTIONS.items() for x in pair])
    rows = (
        cells.select("facility", "sheet", "row_no", label.alias("category"), marker.alias("marker"), "month", "text")
        .withColumn("type", F.try_element_at(kinds, F.last("marker", ignorenulls=True).over(down)))
        .filter(
            F.col("marker").isNull()
            & F.col("type").isNotNull()
            & (F.col("category") != "")
            & ~F.col("category").startswith("Total ")
        )
    )
    patient = (F.col("type") == "Income") & F.col("category").isin(*patient_categories)
    return rows.select(
        "month", "category", ledger_amount("text").alias("amount"), "facility", patient.alias("is_patient_revenue"), "type"
    ).filter(F.col("amount") != 0)


def read_pl_long(
    spark: SparkSession,
    paths: Mapping[str, str],
    patient_categories: Sequence[str],
) -> DataFrame:
    """P&L files by facility -> the long ledger table."""
    return pl_long(read_pl_cells(spark, paths), patient_categories)


def pl_key_lines(cells: DataFrame, key_lines: Sequence[str] = rules.PL_KEY_LINES) -> DataFrame:
    """Amounts of the labelled total lines by month; the first row with a label counts."""
    return (
        cells.withColumn("line_item", F.trim("label"))
        .filter(F.col("line_item").isin(*key_lines))
        .groupBy("facility", "line_item", "month")
        .agg(F.min_by(ledger_amount("text"), F.col("row_no")).alias("amount"))
    )


def pl_cell_lookup(cells: DataFrame, label: str, month: str) -> DataFrame:
    """One labelled cell for one month, per facility; null where the text is no number."""
    return (
        cells.filter((F.trim("label") == label) & (F.col("month") == month))
        .groupBy("facility")
        .agg(F.min_by(parse_money("text"), F.col("row_no")).alias("amount"))
    )

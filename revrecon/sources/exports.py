"""The four business exports: visits, claims, deposits, patients."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon import schemas
from revrecon.functions.dates import parse_us_date
from revrecon.functions.money import parse_money
from revrecon.operators.lookups import lookup
from revrecon.sources.files import BROADCAST_FILES, FILE_BITS, file_of_row, files_with_open_cells, numbered, read_delimited, typed, whole_and_split


def read_visits(
    spark: SparkSession,
    path: str | list[str],
    missing_money_is_zero: bool = False,
    any_date_layout: bool = False,
    allow_empty: bool = False,
    quoted_newlines: bool | None = None,
) -> DataFrame:
    """Visit exports (CSV with header) -> typed visits. A listed export without a data row is rejected."""
    raw = read_delimited(spark, path, quoted_newlines=quoted_newlines, allow_empty=allow_empty)
    return typed(raw, schemas.VISIT_FIELDS, missing_money_is_zero, any_date_layout)


def read_claims(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "UTF-16",
    any_date_layout: bool = True,
    quoted_newlines: bool | None = None,
) -> DataFrame:
    """Claim export (tab-separated, UTF-16, header) -> typed claims; missing amounts are 0."""
    raw = read_delimited(spark, path, sep="\t", encoding=encoding, quoted_newlines=quoted_newlines)
    return typed(raw, schemas.CLAIM_FIELDS, True, any_date_layout)


def read_deposits(spark: SparkSession, paths: Mapping[str, str], quoted_newlines: bool | None = None) -> DataFrame:
    """Deposit details, one or more files per facility -> typed transactions.

    Files with line breaks in quoted cells are found and read whole, as :func:`read_delimited` does. Rows count only after the line of their own file that names the columns, only with a date-shaped
    second cell and only with a readable amount. A file with dated rows and no such line is an error.
    The header positions are one row per file.
    """
    ddl = ", ".join(f"{name} string" for name in schemas.DEPOSIT_FIELDS)
    files = list(paths.values())
    open_files = files_with_open_cells(spark, files) if quoted_newlines is None else None if quoted_newlines else []

    def read(whole: bool) -> DataFrame:
        return spark.read.schema(ddl).options(header=False, escape='"', multiLine=whole).csv(files)

    fields = [F.col(c) for c in schemas.DEPOSIT_FIELDS]
    scans = [numbered(raw, *fields, facilities=paths) for raw in whole_and_split(read, open_files)]
    lines = reduce(DataFrame.unionByName, scans).withColumn("file_no", file_of_row())
    title = "Transaction date"
    named = reduce(or_, [F.contains(c, F.lit(title)) & (F.trim(c) == title) for c in fields])
    headers = lines.filter(named).groupBy("file_no").agg(F.min("row_no").alias("header_row"))
    dated = lines.filter(F.col("txn_date").rlike(r"\d{2}/\d{2}/\d{4}"))
    missing = F.raise_error(F.concat(F.lit("no header line in a deposit file of "), F.col("facility"))).cast("long")
    if len(read(False).inputFiles()) <= BROADCAST_FILES:  # one row per file: the lines stay where they are read
        placed = dated.join(F.broadcast(headers), "file_no", "left")
    else:
        placed = lookup(dated, headers, ["file_no"])
    return (
        placed.filter(F.col("row_no") > F.coalesce("header_row", missing))
        .select(*schemas.DEPOSIT_FIELDS, "row_no", "facility")
        .withColumns({"txn_date": parse_us_date("txn_date"), "amount": parse_money("amount")})
        .filter(F.col("amount").isNotNull())
    )


def read_patients(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Patient master (JSON) -> master_id, patient_name, date_of_birth, row_no.

    Two document shapes are read: ``{"patients": [{...}]}`` and a flat ``{"NAME": "id"}`` object. Of
    several documents the names are in order of the files, numbers in names by value, and within a
    document in its own order: ``row_no`` grows along both, so "last name wins" holds over all of them.
    """
    entry = "struct<master_id:string,patient_name:string,date_of_birth:string>"
    document = numbered(spark.read.text(path, wholetext=True), F.col("value")).select("value", file_of_row().alias("file_no"))
    listed = document.select(
        "file_no",
        F.posexplode(F.from_json("value", f"struct<patients:array<{entry}>>")["patients"]).alias("place", "p"),
    ).select("p.master_id", "p.patient_name", "p.date_of_birth", "file_no", "place")
    flat = (
        document.filter(F.get_json_object("value", "$.patients").isNull())
        .select("file_no", F.posexplode(F.from_json("value", "map<string,string>")).alias("place", "name", "id"))
        .select(
            F.col("id").alias("master_id"),
            F.col("name").alias("patient_name"),
            F.lit(None).cast("string").alias("date_of_birth"),
            "file_no",
            "place",
        )
    )
    row_no = F.shiftleft("file_no", FILE_BITS) + F.col("place")
    return listed.unionByName(flat).withColumn("row_no", row_no).drop("file_no", "place")


def read_patient_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The patient master as JSON lines, one patient each: the splittable form for a large master."""
    ddl = "master_id string, patient_name string, date_of_birth string"
    rows = spark.read.schema(ddl).json(path)
    return numbered(rows, *[F.col(c) for c in ("master_id", "patient_name", "date_of_birth")])

"""Delimited exports as all-string tables that remember the order of their lines."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrecon import schemas
from revrecon.functions.dates import parse_any_date, parse_us_date
from revrecon.functions.money import parse_money, parse_money_or_zero

FILE_BITS = 42
#: Local paths come as file:/x in one place and as file:///x in another.
_LOCAL = "^file:/+"
_LOCAL_FORMS = ("/", "file:/", "file:///")
#: File lists up to this length (some 25 MB of paths) are sent to every task, longer ones are joined by shuffle.
BROADCAST_FILES = 100_000


def by_name(path: str) -> str:
    """Sort key of a path in which numbers count by value: month 2 stands before month 10."""
    return re.sub(r"\d+", lambda digits: digits[0].zfill(20), path)


def numbered(lines: DataFrame, *columns: Column, first_file: int = 0, facilities: Mapping[str, str] | None = None) -> DataFrame:
    """``columns`` of freshly read files and ``row_no``, the place of each row in the order of files and lines.

    Files are ranked by path, numbers by value, which does not depend on when a file was copied or
    which task wrote it first. A line takes at least one byte, so within one file ``block start +
    index inside the task`` grows with the line's position and never repeats, however the file is
    split: full blocks have a task of their own, and files packed into one task stay within one block
    in total. The number needs no shuffle of the rows. With ``facilities``, paths by facility, rows also
    get ``facility`` (see :func:`facility_of_path`); a file that belongs to none is an error, not a lost
    row. What depends on the file alone is worked out once per file.
    """
    index_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    path = F.col("_metadata.file_path")
    rows = lines.select(*columns, path.alias("_file"), (F.col("_metadata.file_block_start") + index_in_task).alias("_at"))
    paths = sorted(lines.inputFiles(), key=by_name)
    nowhere = F.raise_error(F.concat(F.lit("no facility for "), _decoded("_file"))).cast("string")
    if len(paths) <= 1:
        if facilities is not None:
            rows = rows.withColumn("facility", F.coalesce(facility_of_path(facilities, "_file"), nowhere))
        return rows.withColumn("row_no", F.lit(first_file << FILE_BITS) + F.col("_at")).drop("_file", "_at")
    # a local file is listed in every form its name may have in a row, so rows need no rewriting of theirs
    forms = {
        form: rank
        for rank, path in enumerate(paths, first_file)
        for form in [path, *[re.sub("^(file:)?/+", start, path) for start in _LOCAL_FORMS if re.match("(file:)?/", path)]]
    }
    ranks = lines.sparkSession.createDataFrame(list(forms.items()), "_file string, _rank long")
    if facilities is not None:
        ranks = ranks.withColumn("facility", facility_of_path(facilities, "_file"))
    if len(paths) <= BROADCAST_FILES:
        ranks = F.broadcast(ranks)
    rank = F.coalesce("_rank", F.raise_error(F.concat(F.lit("file not listed: "), F.col("_file"))).cast("long"))
    number = F.shiftleft(rank, FILE_BITS) + F.col("_at")
    rows = rows.join(ranks, "_file", "left")
    if facilities is not None:
        rows = rows.withColumn("facility", F.coalesce("facility", nowhere))
    return rows.withColumn("row_no", number).drop("_file", "_at", "_rank")


def file_of_row() -> Column:
    """The file's rank, from a row number that :func:`numbered` gave."""
    return F.shiftright("row_no", FILE_BITS)


def facility_of_path(paths: Mapping[str, str], file: str) -> Column:
    """Facility of the file named in a column; the longest matching path wins, null if none does.

    A path may end in a pattern (``/landing/north/*.csv``): what stands before it decides.
    """
    stems = {facility: re.split(r"[*?\[{]", path)[0] for facility, path in paths.items()}
    result = F.when(F.lit(False), F.lit(None).cast("string"))
    for facility, stem in sorted(stems.items(), key=lambda item: -len(item[1])):
        result = result.when(_decoded(file).contains(stem), facility)
    return result


def _decoded(file: str) -> Column:
    return F.url_decode(F.replace(F.col(file), F.lit("+"), F.lit("%2B")))


def _open_cell(sep: str) -> str:
    """Pattern of a line that ends inside a quoted cell, if it began outside one.

    The first line of a record that goes on does begin outside, so a file holds such a record exactly if one of its
    lines matches. Quotes inside a plain cell (5" pipe) open nothing.
    """
    other, rest = f"[^{re.escape(sep)}]*+", r'[^"]*+(?:""[^"]*+)*+'
    cell = f'"{rest}"{other}|[^"{re.escape(sep)}]{other}|'
    return rf'\A(?:(?:{cell}){re.escape(sep)})*+"{rest}\z'


def _ends_open(sep: str) -> Column:
    """If the line in ``value`` fits :func:`_open_cell`. Its last quote then opens the cell or is one of two: few other lines need the pattern."""
    value = F.col("value")
    last = F.concat(F.lit('"'), F.substring_index(value, '"', -1))
    may = value.endswith(F.concat(F.lit(sep), last)) | value.endswith(F.concat(F.lit('"'), last)) | (value == last)
    return value.contains('"') & may & value.rlike(_open_cell(sep))


def files_with_open_cells(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> list[str]:
    """The files (as ``_metadata.file_path`` names them) in which a quoted cell holds a line break.

    One pass over the lines, in splits of any size. What comes back is a list of files, never of lines.
    """
    if encoding.upper() == "UTF-16":
        # one column per line: no text holds the non-character that is set as separator
        options = {"encoding": "UTF-16LE", "lineSep": "\n", "sep": "\uffff", "quote": "", "header": False}
        lines = spark.read.options(**options).schema("value string").csv(path)
    else:
        lines = spark.read.text(path)
    found = lines.filter(_ends_open(sep))
    return [r[0] for r in found.select("_metadata.file_path").distinct().collect()]


def whole_and_split(read: Callable[[bool], DataFrame], open_files: Sequence[str] | None) -> list[DataFrame]:
    """The files of ``read(whole)`` in two scans: those of the list one by one as wholes, the others in splits.

    Files are chosen by their path before they are opened, so each is read once. ``None`` reads all as wholes.
    """
    if open_files is None:
        return [read(True)]
    if not open_files:
        return [read(False)]
    path = F.col("_metadata.file_path")
    return [read(False).filter(~path.isin(*open_files)), read(True).filter(path.isin(*open_files))]


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    quoted_newlines: bool | None = None,
    allow_empty: bool = True,
) -> DataFrame:
    """Header file -> one string column per header cell, plus ``row_no``.

    Each listed path is an export with a header of its own: columns are put together by name, and
    what an export lacks is null. Its files must agree; one with other columns or another order is
    an error of the read. Only header lines are read ahead. ``UTF-16`` exports are read as
    little-endian with an explicit line separator, which keeps a large file splittable; the
    byte-order mark and carriage returns are taken off. Cells may hold line breaks: a pass over the
    lines finds the files with such cells, which are then read whole, each by one task, while all
    others stay splittable. ``quoted_newlines`` saves that pass: True reads all files whole, False
    promises that there are none. Without ``allow_empty`` every listed export needs a data row.
    Rows are numbered in the order of the list.
    """
    wide = encoding.upper() == "UTF-16"
    options = {"header": True, "sep": sep, "escape": '"', "encoding": "UTF-16LE" if wide else encoding}
    split, whole = options | ({"lineSep": "\n"} if wide else {}), options | {"multiLine": True}
    paths = [path] if isinstance(path, str) else path
    open_files = files_with_open_cells(spark, paths, sep, encoding) if quoted_newlines is None else None if quoted_newlines else []
    exports, n_files = [], 0
    for one in paths:
        first = spark.read.options(**(whole if open_files is None else split)).csv(one)
        here = {re.sub(_LOCAL, "/", name) for name in first.inputFiles()}
        if not allow_empty and first.isEmpty():
            raise ValueError(f"no data rows in {one}")

        names = first.columns

        def read(as_whole: bool) -> DataFrame:
            # line by line, the carriage return of a wide file is part of its last header cell
            header = [*names[:-1], names[-1].rstrip("\r")] if as_whole else names  # noqa: B023 - called in this turn only
            reader = spark.read.options(**(whole if as_whole else split)).options(enforceSchema=len(here) < 2)  # noqa: B023
            return reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).csv(one)  # noqa: B023

        def cells(raw: DataFrame) -> list[Column]:
            ends = [F.col(f"`{c}`") for c in raw.columns]
            if wide:
                ends[-1] = F.regexp_replace(ends[-1], r"\r$", "")
            return [value.alias(name.strip("\ufeff\r\n ")) for value, name in zip(ends, raw.columns)]

        own = None if open_files is None else [name for name in open_files if re.sub(_LOCAL, "/", name) in here]
        exports += [numbered(raw, *cells(raw), first_file=n_files) for raw in whole_and_split(read, own)]
        n_files += len(here)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), exports)


def typed(
    raw: DataFrame,
    fields: Sequence[tuple[str, str, str]],
    missing_money_is_zero: bool = False,
    any_date_layout: bool = False,
) -> DataFrame:
    """Named and typed columns of an all-string table; header cells it lacks are left out."""
    to_money = parse_money_or_zero if missing_money_is_zero else parse_money
    to_date = parse_any_date if any_date_layout else parse_us_date
    present = set(raw.columns)
    columns = []
    for header, name, kind in fields:
        if header not in present:
            continue
        source = F.col(f"`{header}`")
        value = {
            schemas.MONEY: lambda c: to_money(c),
            schemas.DATE: lambda c: to_date(c),
            schemas.TEXT: lambda c: c,
        }[kind](source)
        columns.append(value.alias(name))
    if "row_no" in present:
        columns.append(F.col("row_no"))
    return raw.select(*columns)


def typed_currency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Currency text to decimal over the listed columns the table has, in one projection."""
    return df.withColumns({c: parse_money(f"`{c}`") for c in columns if c in df.columns})


def typed_currency_zero(df: DataFrame, columns: Sequence[str], negative_parens: bool = False) -> DataFrame:
    """As :func:`typed_currency`; parentheses are stripped, bad or missing amounts are 0."""
    return df.withColumns(
        {c: parse_money_or_zero(f"`{c}`", negative_parens) for c in columns if c in df.columns}
    )


def typed_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Month/day/year text to date over the listed columns the table has."""
    return df.withColumns({c: parse_us_date(f"`{c}`") for c in columns if c in df.columns})

"""Validation and profiling. Every profile is one pass over the table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrecon import rules, schemas
from revrecon.functions.dates import as_date, days_since, parse_any_date
from revrecon.session import settle


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _is_blank(df: DataFrame, column: str) -> Column:
    blank = F.col(column).isNull()
    return blank | (F.col(column) == "") if _is_text(df, column) else blank


def _stacked(df: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One input row -> one row per entry of ``rows``."""
    structs = F.array(*[F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows])
    return df.select(F.explode(structs).alias("r")).select(*[f"r.{n}" for n in names])


def check_columns(
    df: DataFrame,
    required: Sequence[str] = schemas.REQUIRED_VISIT_COLUMNS,
    optional: Sequence[str] = schemas.OPTIONAL_VISIT_COLUMNS,
) -> DataFrame:
    """Missing columns: required ones are errors, optional ones warnings. Looks at the schema only."""
    missing = [(c, "error") for c in required if c not in df.columns]
    missing += [(c, "warning") for c in optional if c not in df.columns]
    spark = df.sparkSession
    return spark.createDataFrame(missing, "column_name string, severity string")


def _date_measures(df: DataFrame, as_of: str | dt.date, column: str) -> list[Column]:
    parsed = parse_any_date(column) if _is_text(df, column) else F.col(column).cast("date")
    blank = _is_blank(df, column)
    return [
        F.count("*").alias("total_records"),
        F.count_if(blank).alias("null_dates"),
        F.count_if(parsed.isNull() & ~blank).alias("invalid_dates"),
        F.count_if(parsed > as_date(as_of)).alias("future_dates"),
        F.min(parsed).alias("min_date"),
        F.max(parsed).alias("max_date"),
    ]


def profile_dates(df: DataFrame, as_of: str | dt.date, column: str = "dos") -> DataFrame:
    """Counts of all, null, unreadable and future dates, and the date range."""
    return df.agg(*_date_measures(df, as_of, column))


def profile_ids(df: DataFrame, id_column: str = "patient_id", date_column: str = "dos") -> DataFrame:
    """Null ids, distinct ids, and rows in groups that share id and date.

    Counting per (id, date) first combines inside each task, so a hot key arrives as one row per
    task; distinct ids are then counted over groups, not over rows.
    """
    blank = _is_blank(df, id_column)
    groups = df.groupBy(id_column, date_column).agg(F.count("*").alias("n"), F.count_if(blank).alias("blank"))
    per_id = groups.groupBy(id_column).agg(
        F.sum("n").alias("n"),
        F.sum("blank").alias("blank"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("dup"),
    )
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("blank"), F.lit(0)).alias("null_ids"),
        F.count(id_column).alias("unique_patients"),
        F.coalesce(F.sum("dup"), F.lit(0)).alias("duplicate_visits"),
    )


_NUMERIC_MEASURES = {
    "null_count": lambda c: F.count_if(c.isNull()),
    "negative_count": lambda c: F.count_if(c < 0),
    "zero_count": lambda c: F.count_if(c == 0),
    "min_value": F.min,
    "max_value": F.max,
    "sum_value": F.sum,
}


def profile_numeric(df: DataFrame, columns: Sequence[str] = schemas.PROFILED_MONEY) -> DataFrame:
    """Per money column: null, negative and zero counts, min, max, sum.

    All columns are aggregated side by side and turned into rows afterwards: unpivoting first would
    multiply the rows of the table.
    """
    present = [c for c in columns if c in df.columns]
    wide = df.agg(*[fn(F.col(c)).alias(f"{c}__{m}") for c in present for m, fn in _NUMERIC_MEASURES.items()])
    rows = [
        [F.lit(c)]
        + [
            F.col(f"{c}__{m}") if m.endswith("count") else F.col(f"{c}__{m}").cast("double")
            for m in _NUMERIC_MEASURES
        ]
        for c in present
    ]
    return _stacked(wide, rows, ["column_name", *_NUMERIC_MEASURES])


def profile_stages(df: DataFrame, valid: Sequence[str] = rules.VALID_STAGES) -> DataFrame:
    """Count per stage (null and blank as one row) with a status: valid, unknown or null."""
    stage = F.when(F.col("visit_stage") == "", None).otherwise(F.col("visit_stage"))
    status = (
        F.when(F.col("stage").isNull(), "null").when(F.col("stage").isin(*valid), "valid").otherwise("unknown")
    )
    return df.groupBy(stage.alias("stage")).agg(F.count("*").alias("n")).withColumn("status", status)


_RULES = (
    ("Total Paid exceeds Primary Allowed", "warning", "Records where payment exceeds allowed amount"),
    ("Closed visits with $0 billed", "warning", "Closed visits that have no billing amount"),
    ("Open visits older than 90 days", "high", "Open visits that may need follow-up"),
)


def _rule_measures(as_of: str | dt.date, old_open_days: int) -> list[Column]:
    stage = F.col("visit_stage")
    allowed = F.col("primary_allowed")
    tests = (
        (F.col("total_paid") > allowed) & (allowed > 0),
        (stage == "Closed") & (allowed == 0),
        (stage == "Open") & (days_since(as_of, "dos") > old_open_days),
    )
    return [F.count_if(test).alias(f"broken_{i}") for i, test in enumerate(tests)]


def business_rule_violations(
    visits: DataFrame, as_of: str | dt.date, old_open_days: int = rules.OLD_OPEN_DAYS
) -> DataFrame:
    """Broken business rules with their counts; rules nobody breaks are left out."""
    rows = [
        [F.lit(rule), F.col(f"broken_{i}"), F.lit(severity), F.lit(text)]
        for i, (rule, severity, text) in enumerate(_RULES)
    ]
    counts = visits.agg(*_rule_measures(as_of, old_open_days))
    return _stacked(counts, rows, ["rule", "n", "severity", "description"]).filter("n > 0")


def validation_summary(
    visits: DataFrame, as_of: str | dt.date, old_open_days: int = rules.OLD_OPEN_DAYS
) -> DataFrame:
    """Every check as rows (check_name, field, measure, value, severity: error, warning or info).

    The row ``overall / table / is_valid`` is 1 without errors. Dates, amounts and rules share one
    pass over the visits; ids and stages are one small-result aggregate each. The overall row is a
    second grouping set over the finished checks, so no check is computed twice.
    """
    names = ["check_name", "field", "measure", "value", "severity"]

    def row(check: str, field: str, measure: str, value: Column, bad: str | None = None) -> list[Column]:
        level = F.when(value > 0, F.lit(bad)).otherwise("info") if bad else F.lit("info")
        return [F.lit(check), F.lit(field), F.lit(measure), value.cast("double"), level]

    money = [c for c in schemas.PROFILED_MONEY if c in visits.columns]
    one_pass = visits.agg(
        *_date_measures(visits, as_of, "dos"),
        *[F.count_if(F.col(c) < 0).alias(f"{c}__negative") for c in money],
        *_rule_measures(as_of, old_open_days),
    )
    scan_rows = [
        row("dates", "dos", "total_records", F.col("total_records")),
        row("dates", "dos", "null_dates", F.col("null_dates"), "error"),
        row("dates", "dos", "invalid_dates", F.col("invalid_dates"), "error"),
        row("dates", "dos", "future_dates", F.col("future_dates"), "warning"),
    ]
    scan_rows += [row("numeric", c, "negative_count", F.col(f"{c}__negative"), "warning") for c in money]
    scan_rows += [
        row("rules", rule, "violations", F.col(f"broken_{i}"), "error" if severity == "high" else "warning")
        for i, (rule, severity, _) in enumerate(_RULES)
    ]
    id_rows = [
        row("ids", "patient_id", "null_ids", F.col("null_ids"), "error"),
        row("ids", "patient_id", "unique_patients", F.col("unique_patients")),
        row("ids", "patient_id", "duplicate_visits", F.col("duplicate_visits"), "warning"),
    ]
    column_rows = check_columns(visits).select(
        F.lit("columns").alias("check_name"),
        F.col("column_name").alias("field"),
        F.lit("missing").alias("measure"),
        F.lit(1.0).alias("value"),
        "severity",
    )
    stage_rows = profile_stages(visits).select(
        F.lit("stages").alias("check_name"),
        F.coalesce("stage", F.lit("")).alias("field"),
        F.concat(F.col("status"), F.lit("_count")).alias("measure"),
        F.col("n").cast("double").alias("value"),
        F.when(F.col("status") == "valid", "info").otherwise("warning").alias("severity"),
    )
    parts = [
        column_rows,
        _stacked(one_pass, scan_rows, names),
        _stacked(profile_ids(visits), id_rows, names),
        stage_rows,
    ]
    checks = reduce(DataFrame.unionByName, parts)
    keys = [F.col(c) for c in names]
    graded = checks.withColumn("bad", F.col("severity") == "error").groupingSets(
        [keys, []], *keys
    ).agg(F.bool_and(~F.col("bad")).alias("ok"), F.grouping_id().alias("level"))
    total = F.col("level") > 0
    return graded.select(
        F.when(total, "overall").otherwise(F.col("check_name")).alias("check_name"),
        F.when(total, "table").otherwise(F.col("field")).alias("field"),
        F.when(total, "is_valid").otherwise(F.col("measure")).alias("measure"),
        F.when(total, F.col("ok").cast("double")).otherwise(F.col("value")).alias("value"),
        F.when(total, F.when(F.col("ok"), "info").otherwise("error")).otherwise(F.col("severity")).alias("severity"),
    )


_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
_QUARTILE_ROW = "column_name string, " + ", ".join(f"{q} double" for q in _QUARTILES)
_BUCKETS_PER_DOUBLING = 256
#: Parts that a bucket with several values is cut into by one more pass.
_PARTS = 4096
#: Columns that one pass describes.
_DESCRIBED = 3


def _narrowed(totals: DataFrame, wanted: list[tuple[str, float, int]]) -> list:
    """The buckets that hold the wanted ranks: (column_name, within, rank, before, n, lo, hi), one row per rank.

    ``totals`` has one row per column, range and bucket, however long the table is; only these are put in order.
    """
    spark = totals.sparkSession
    down = Window.partitionBy("column_name", "within").orderBy("bucket")
    placed = totals.withColumn("before", F.sum("n").over(down) - F.col("n"))
    ranks = spark.createDataFrame(wanted, "column_name string, within double, rank long")
    hit = placed.join(F.broadcast(ranks), ["column_name", "within"])  # at most six ranks of each column
    inside = (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n"))
    return hit.filter(inside).select("column_name", "within", "rank", "before", "n", "lo", "hi").collect()


def _values(df: DataFrame, columns: Sequence[str], bucketed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Counts, least and greatest value per column, range and bucket; null, NaN and values without a bucket are left out.

    ``bucketed`` adds ``within`` and ``bucket`` to rows of (column_name, value). One expression for all columns keeps the
    generated code short enough to be compiled.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column_name", "value")
    rows = bucketed(rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))).filter(F.col("bucket").isNotNull())
    return rows.groupBy("column_name", "within", "bucket").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )


def exact_quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact quartiles with linear interpolation, (column_name, p25, p50, p75), by selection.

    A first pass counts the values of order-preserving buckets of about 0.3 % width; only the buckets that hold a wanted
    rank are looked at again. Each further pass cuts those into ``_PARTS`` parts and counts these, until every rank
    lies in a bucket of one value: one more pass for amounts in cents, at most six for any doubles. No pass shuffles
    more than its buckets, no values are ranked, and six numbers a column reach the driver. The columns are written once, so
    a pass never derives the table again. Null and NaN do not count; a column without values has no row.
    """
    columns = list(columns)
    names = {f"c{i}": name for i, name in enumerate(columns)}
    if not columns:
        return df.sparkSession.createDataFrame([], _QUARTILE_ROW)
    values = df.select(*[F.col(f"`{name}`").cast("double").alias(c) for c, name in names.items()])
    return _selected_quartiles(settle(df.sparkSession, values, "quartile_values"), names)


def _selected_quartiles(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The quartiles of a written table's columns, named as ``names`` says: every pass reads the table, none derives it."""
    spark = df.sparkSession
    if not names:
        return spark.createDataFrame([], _QUARTILE_ROW)
    value = F.col("value")

    def by_magnitude(rows: DataFrame) -> DataFrame:
        magnitude = F.floor(F.log2(F.lit(1.0) + F.abs(value)) * _BUCKETS_PER_DOUBLING)
        return rows.withColumns({"within": F.lit(0.0), "bucket": F.when(value < 0, -magnitude - 1).otherwise(magnitude)})

    # read twice: for the sizes and for the ranks
    totals = settle(spark, _values(df, list(names), by_magnitude), "bucket_totals")
    sizes = {r[0]: r[1] for r in totals.groupBy("column_name").agg(F.sum("n")).collect()}
    ends = {c: {q: (share * (n - 1) // 1, -(-share * (n - 1) // 1)) for q, share in _QUARTILES.items()} for c, n in sizes.items()}
    wanted = sorted({(c, 0.0, int(rank)) for c, qs in ends.items() for pair in qs.values() for rank in pair})
    found, base = {}, {(c, 0.0): 0 for c in sizes}
    while wanted:
        hits, wanted, ranges = _narrowed(totals, wanted), [], {}
        for r in hits:
            rank = base[r.column_name, r.within] + r.rank
            if r.lo == r.hi:
                found[r.column_name, rank] = r.lo
            else:
                wanted.append((r.column_name, r.lo, r.rank - r.before))
                ranges.setdefault(r.column_name, {})[r.lo] = (r.hi, base[r.column_name, r.within] + r.before)
        if wanted:
            base = {(c, lo): before for c, own in ranges.items() for lo, (_, before) in own.items()}
            cuts = spark.createDataFrame(
                [(c, lo, hi) for c, own in ranges.items() for lo, (hi, _) in own.items()], "in_column string, within double, up_to double"
            )

            def by_part(rows: DataFrame) -> DataFrame:
                within, up_to = F.col("within"), F.col("up_to")
                # at most six ranges of each column, which do not overlap
                inside = (F.col("column_name") == F.col("in_column")) & (value >= within) & (value <= up_to)
                part = F.least(F.floor((value - within) / (up_to - within) * _PARTS), F.lit(_PARTS - 1))
                return rows.join(F.broadcast(cuts), inside).withColumn("bucket", part)  # noqa: B023 - used up in this turn

            totals = _values(df, list(ranges), by_part)
            wanted = sorted(set(wanted))
    rows = []
    for c, n in sizes.items():
        row = [names[c]]
        for q, (low, high) in ends[c].items():
            a, b = found[c, int(low)], found[c, int(high)]
            row.append(a + (b - a) * (_QUARTILES[q] * (n - 1) - low) if a != b else a)
        rows.append(tuple(row))
    return spark.createDataFrame(rows, _QUARTILE_ROW)


def summary_stats(df: DataFrame) -> DataFrame:
    """Per column: null count; for columns of numbers also count, mean, std, min, quartiles, max."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    measures = {
        "n": lambda c: F.count(c),
        "mean": lambda c: F.try_divide(F.sum(c).cast("double"), F.count(c)),
        "std": lambda c: F.stddev_samp(c.cast("double")),
        "min_value": lambda c: F.min(c).cast("double"),
        "max_value": lambda c: F.max(c).cast("double"),
    }
    # written once: numbers as they are, of other columns only whether they are null
    places = {name: f"c{i}" for i, name in enumerate(df.columns)}
    columns = [(F.col(n) if n in numeric else F.when(F.col(n).isNotNull(), True)).alias(c) for n, c in places.items()]
    table = settle(df.sparkSession, df.select(*columns), "summary_columns")

    def described(group: Sequence[str]) -> DataFrame:
        exprs, rows = [F.count("*").alias("total_rows")], []
        for name in group:
            c = places[name]
            row = [F.lit(name), F.col("total_rows"), F.col(f"{c}__nulls")]
            exprs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"))
            for m, fn in measures.items():
                if name in numeric:
                    exprs.append(fn(F.col(c)).alias(f"{c}__{m}"))
                empty = F.lit(None).cast("long" if m == "n" else "double")
                row.append(F.col(f"{c}__{m}") if name in numeric else empty)
            rows.append(row)
        return _stacked(table.agg(*exprs), rows, ["column_name", "total_rows", "null_count", *measures])

    # a pass over few columns reads only these, and its code is short enough to be compiled
    names = list(places)
    parts = [described(names[i : i + _DESCRIBED]) for i in range(0, len(names), _DESCRIBED)]
    quartiles = _selected_quartiles(table, {places[name]: name for name in numeric})
    return reduce(DataFrame.unionByName, parts).join(quartiles, "column_name", "left").select(
        "column_name", "total_rows", "null_count", "n", "mean", "std", "min_value", *_QUARTILES, "max_value"
    )

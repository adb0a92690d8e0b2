"""Registered queries: names of the operator inventory -> calls on the derived tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from revrecon.functions import dates, labels, money, names
from revrecon.operators import (
    actions,
    combined,
    commercial,
    dashboard,
    deidentify,
    filters,
    identity,
    ledger,
    matching,
    metrics,
    monthly,
    patient,
    quality,
)
from revrecon.plans import incremental, reconcile, report
from revrecon.session import scratch_dir
from revrecon.sinks import runs
from revrecon.sinks import tables as sinks
from revrecon.sources import catalog, exports, files, ledger_sheet
from revrecon.sources.versions import FileTable

AS_OF = "2001-09-01"
MONTH = "1997-06"
PL_MONTH = "1997-03"
FACILITY = "ASIA"
PATIENT = 42
KNOWN_REGIONS = fx.REGIONS[:4]
FACILITY_MAP = {r: r for r in KNOWN_REGIONS}
OFFICE_RULES = tuple(((r,), r) for r in KNOWN_REGIONS)
INCLUDED_OFFICES = ("100000 - CLINIC AFRICA", "100002 - CLINIC ASIA")
KEYWORDS = ("plate",)
DEPOSIT_ORDER = ("row_no", "cleared", "account")
PATIENT_CATEGORIES = ("STANDARD", "SMALL", "LARGE")
SNAPSHOT_PREFIXES = ("src1_", "src2_", "src3_", "src14_")

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Result columns in types every engine shares: double, bigint, boolean and text."""
    columns = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind == "decimal" or kind == "float":
            c = c.cast("double")
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "array":
            c = F.array_join(c.cast("array<string>"), " | ")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a module's name."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(spark, sf_dir))

    REGISTRY[fn.__name__.rstrip("_")] = run
    return run


# --- shared inputs ----------------------------------------------------------------------------

def known_claims(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.prepare_claims(fx.claims(spark, sf), fx.patients(spark, sf))


def last_claims(spark: SparkSession, sf: str) -> DataFrame:
    return actions.claims_last_by_key(known_claims(spark, sf))


def both(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return fx.visits(spark, sf), known_claims(spark, sf)


def office_facility(col: str) -> Column:
    return labels.facility_from_office(col, OFFICE_RULES)


def merged(spark: SparkSession, sf: str) -> DataFrame:
    return combined.combined_dedup(*both(spark, sf), office_facility)


def matched_claims(spark: SparkSession, sf: str) -> DataFrame:
    return identity.name_dob_match(fx.claims(spark, sf), fx.patients(spark, sf))


def decided_claims(spark: SparkSession, sf: str) -> DataFrame:
    return identity.apply_match_decisions(matched_claims(spark, sf), fx.decisions(spark, sf))


def clean_deposits(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.deposits_dedup(fx.deposits(spark, sf), DEPOSIT_ORDER)


def kept_deposits(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.patient_deposits(clean_deposits(spark, sf), KEYWORDS)


def pl_cells(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_sheet.pl_cells(fx.pl_wide(spark, sf), fx.PL_MONTHS, "yr")


def pl(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_sheet.pl_long(pl_cells(spark, sf), PATIENT_CATEGORIES)


def key_lines(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_sheet.pl_key_lines(pl_cells(spark, sf))


def _broken(col: str) -> Column:
    """The text of some rows as a cell with line breaks, quotes and the separators."""
    return F.when(F.col("row_no") % 7 == 0, F.concat(F.lit('first, "line"\n\tand\n'), F.col(col))).otherwise(F.col(col))


def _dollars(col: str) -> Column:
    return F.concat(F.lit("$"), F.format_number(col, 2))


def _us_date(col: str) -> Column:
    return F.date_format(col, "MM/dd/yyyy")


# --- sources ----------------------------------------------------------------------------------

@query
def read_visits(spark, sf):
    """Visits written as two exports with currency text, another order of columns and cells with line breaks, read back."""
    v = fx.visits(spark, sf).withColumn("referral_source", _broken("referral_source"))
    headers = {name: header for header, name, _ in files.schemas.VISIT_FIELDS}
    cells = []
    for f in v.schema.fields:
        if f.name in headers:
            kind = f.dataType.typeName()
            cell = _dollars(f.name) if kind == "decimal" else _us_date(f.name) if kind == "date" else F.col(f.name)
            cells.append(cell.cast("string").alias(headers[f.name]))
    old, new = scratch_dir(spark, "visits_csv"), scratch_dir(spark, "visits_csv")
    # the older export keeps to one line per record
    plain = v.withColumn("referral_source", F.regexp_replace("referral_source", r"(?s)^.*\n", ""))
    plain.filter("year(dos) < 1998").select(*cells).write.options(header=True, escape='"').csv(old)
    v.filter("year(dos) >= 1998").select(*reversed(cells)).write.options(header=True, escape='"').csv(new)
    return exports.read_visits(spark, [old, new]).drop("row_no")


@query
def typed_currency(spark, sf):
    t = fx.fixture(spark, sf, "fx_text").select("row_no", F.col("money_text").alias("amount"))
    return files.typed_currency(t, ["amount", "absent"])


@query
def typed_dates(spark, sf):
    t = fx.fixture(spark, sf, "fx_text").select("row_no", F.col("date_text").alias("dos"))
    return files.typed_dates(t, ["dos"])


@query
def typed_currency_zero(spark, sf):
    t = fx.fixture(spark, sf, "fx_text").select("row_no", F.col("money_text").alias("amount"))
    signed = money.parse_money_or_zero("amount", negative_parens=True)
    return files.typed_currency_zero(t.withColumn("signed", signed), ["amount"])


@query
def read_claims(spark, sf):
    """Claims written as UTF-16 tab-separated text with line breaks in cells, in two exports with another order of columns, read back."""
    c = fx.claims(spark, sf).withColumn("office", _broken("office"))
    cells = []
    for header, name, kind in files.schemas.CLAIM_FIELDS:
        cell = _dollars(name) if kind == "money" else _us_date(name) if kind == "date" else F.col(name)
        cells.append(cell.cast("string").alias(header))
    options = {"header": True, "sep": "\t", "encoding": "UTF-16LE", "lineSep": "\n", "escape": '"'}
    old, new = scratch_dir(spark, "claims_tsv"), scratch_dir(spark, "claims_tsv")
    c.filter("year(service_date) < 1998").select(*cells).write.options(**options).csv(old)
    c.filter("year(service_date) >= 1998").select(*reversed(cells)).write.options(**options).csv(new)
    return exports.read_claims(spark, [old, new]).drop("row_no")


@query
def read_deposits(spark, sf):
    """One deposit file per facility and year, each with preamble, header and subtotal lines, some memos over several lines, read back."""
    root = scratch_dir(spark, "deposits_csv")
    cols = files.schemas.DEPOSIT_FIELDS
    d = fx.deposits(spark, sf).withColumn("yr", F.year("txn_date")).withColumn("memo", F.when(F.col("yr") % 2 == 0, _broken("memo")).otherwise(F.col("memo")))
    keys = [F.col("facility").alias("file"), F.col("yr")]
    none = F.lit(None).cast("string")
    header = ("Transaction date", "Transaction type", "Num", "Customer", "Vendor", "Memo", "Cleared", "Amount")
    preamble = [("Some Clinic LLC",) + (None,) * 8, (None, "01/01/1990 preamble") + (None,) * 6 + ("1.00",), (None, *header)]
    lines = d.select(
        "account", _us_date("txn_date").alias("txn_date"), F.lit("Deposit").alias("txn_type"),
        F.col("row_no").cast("string").alias("num"), none.alias("customer"), none.alias("vendor"), "memo", "cleared",
        F.format_number("amount", 2).alias("amount"), *keys, F.lit(3).alias("at"),
    )
    # the lines around the transactions: preamble and subtotals, from one pass over the deposits
    totals = d.groupBy("facility", "yr", "account").agg(F.format_number(F.sum("amount"), 2).alias("amount"))

    def line(at: int, *cells: Column) -> Column:
        return F.struct(*[c.cast("string").alias(name) for c, name in zip(cells, cols)], F.lit(at).alias("at"))

    tops = [line(at, *[F.lit(v) for v in cells]) for at, cells in enumerate(preamble)]
    subtotal = line(4, F.concat(F.lit("Total for "), "account"), *[none] * (len(cols) - 2), F.col("amount"))
    frame = totals.groupBy("facility", "yr").agg(F.collect_list(subtotal).alias("totals")).select(
        F.inline(F.concat(F.array(*tops), "totals")), *keys,
    )
    # a deposit export is one file by nature: the transactions of one facility in one year
    rows = frame.unionByName(lines).repartition("file", "yr")
    rows.sortWithinPartitions("file", "yr", "at").drop("at").write.option("escape", '"').partitionBy("file", "yr").csv(root)
    paths = {region: f"{root}/file={region}/*" for region in fx.REGIONS}
    return exports.read_deposits(spark, paths).select(
        F.col("num").cast("long").alias("row_no"), "txn_date", "amount", "memo", "cleared", "account", "facility"
    )


@query
def read_pl_long(spark, sf):
    """One P&L sheet per facility and year, with preamble; even years list their months backwards. Read back."""
    root = scratch_dir(spark, "pl_csv")
    wide = fx.pl_wide(spark, sf)
    keys, cells = ["facility", "yr"], [f"c{i:02d}" for i in range(1, 13)]

    def placed(value: Callable[[int], Column]) -> list[Column]:
        even = F.col("yr") % 2 == 0
        return [F.when(even, value(13 - i)).otherwise(value(i)).alias(c) for i, c in enumerate(cells, 1)]

    sheet = wide.select(*keys).distinct()
    title = sheet.select(
        *keys, F.lit(-2).alias("row_no"), F.lit("Some Clinic LLC").alias("label"),
        *[F.lit(None).cast("string").alias(c) for c in cells],
    )
    months = sheet.select(
        *keys, F.lit(-1).alias("row_no"), F.lit("Distribution account").alias("label"),
        *placed(lambda m: F.date_format(F.make_date("yr", F.lit(m), F.lit(1)), "MMMM yyyy")),
    )
    body = wide.select(*keys, "row_no", "label", *placed(lambda m: F.col(f"m{m:02d}")))
    # a sheet is one small file by nature: some hundred lines whatever the scale
    rows = title.unionByName(months).unionByName(body).repartition(*keys).sortWithinPartitions(*keys, "row_no")
    rows.drop("row_no").write.partitionBy(*keys).csv(root)
    paths = {region: f"{root}/facility={region}/*" for region in fx.REGIONS}
    return ledger_sheet.read_pl_long(spark, paths, PATIENT_CATEGORIES)


@query
def pl_key_lines(spark, sf):
    return key_lines(spark, sf)


@query
def pl_cell_lookup(spark, sf):
    return ledger_sheet.pl_cell_lookup(pl_cells(spark, sf), "Total for Income", PL_MONTH)


@query
def read_patients(spark, sf):
    """The master written as JSON lines, read back."""
    path = scratch_dir(spark, "patients_json")
    fx.patients(spark, sf).select(
        F.col("patient_id").cast("string").alias("master_id"), "patient_name", _us_date("dob").alias("date_of_birth")
    ).write.json(path)
    return exports.read_patient_lines(spark, path).select(
        "master_id", "patient_name", dates.parse_us_date("date_of_birth").alias("date_of_birth")
    )


def _sources(spark, sf):
    m = fx.manifest(spark, sf)
    return m.select(
        F.col("file_name").alias("table_name"), F.col("prefix").alias("source_id"),
        F.col("modified").cast("timestamp").alias("modified"), "size",
    )


def _load_log(spark, sf):
    """Two thirds of the files were loaded before, half of these in an older state; some twice."""
    s = _sources(spark, sf).filter("size % 3 <> 0")
    older = F.col("modified") - F.make_dt_interval(F.lit(1))
    first = s.select("table_name", "source_id", older.alias("modified"), older.alias("loaded_at"))
    second = s.filter("size % 2 = 0").select("table_name", "source_id", "modified", F.col("modified").alias("loaded_at"))
    return first.unionByName(second)


@query
def changed_sources(spark, sf):
    return catalog.changed_sources(_sources(spark, sf), _load_log(spark, sf)).select("table_name", "source_id", "modified")


@query
def refresh_table(spark, sf):
    """Loaded once; the second call finds the source unchanged and leaves the table alone."""
    warehouse = scratch_dir(spark, "warehouse")
    v = fx.visits(spark, sf)
    stamp = dt.datetime(2001, 8, 31)
    first = catalog.refresh_table(spark, v, "visits", "visits.csv", stamp, warehouse)
    second = catalog.refresh_table(spark, v.limit(0), "visits", "visits.csv", stamp, warehouse)
    if not first or second:
        raise AssertionError("a current table must not be loaded again")
    return catalog.read_table(spark, warehouse, "visits").select("row_no", "patient_id", "dos", "total_paid")


def _deliver(rows: DataFrame, landing: str) -> None:
    """Visits as exports, two files a year; the files of the years that ``rows`` has are replaced."""
    headers = {name: header for header, name, _ in files.schemas.VISIT_FIELDS}
    cells = {c: F.col(c) for c in ("patient_id", "visit_stage", "provider", "facility")}
    cells |= {"dos": _us_date("dos")} | {c: _dollars(c) for c in ("last_billed", "primary_allowed", "total_paid")}
    named = [c.cast("string").alias(headers[n]) for n, c in cells.items()]
    halves = rows.select(*named, F.year("dos").alias("yr"), (F.col("row_no") % 2).alias("half"))
    dealt = halves.repartition("yr", "half").drop("half")
    dealt.write.mode("overwrite").options(header=True, escape='"', partitionOverwriteMode="dynamic").partitionBy("yr").csv(landing)


def _delivered(spark: SparkSession, landing: str) -> DataFrame:
    return catalog.list_files(spark, landing).filter("file_name like '%.csv'")


@query
def refresh_changed_files(spark, sf):
    """Yearly exports in files, loaded; then one year is delivered anew and only its files are loaded again."""
    landing, table = scratch_dir(spark, "landing"), FileTable(spark, scratch_dir(spark, "file_table"))
    v = fx.visits(spark, sf)

    def load(names: list[str]) -> DataFrame:
        return exports.read_visits(spark, names, allow_empty=True)

    _deliver(v, landing)
    first = table.refresh(_delivered(spark, landing), load)
    _deliver(v.filter("year(dos) = 1997").withColumn("total_paid", F.col("total_paid") + 1), landing)
    listing = _delivered(spark, landing)
    second = table.refresh(listing, load, drop_missing=True)
    year = listing.filter(F.col("source_id").contains("yr=1997")).count()
    if (first.version, second.version, second.loaded, second.kept) != (1, 2, year, listing.count() - year):
        raise AssertionError(f"only the files of 1997 have changed: {first}, {second}")
    return table.read().select("patient_id", "dos", "visit_stage", "provider", "total_paid", F.regexp_extract("source_id", r"yr=(\d+)", 1).alias("yr"))


@query
def cache_status(spark, sf):
    return catalog.cache_status(_load_log(spark, sf))


@query
def latest_snapshot(spark, sf):
    return catalog.latest_snapshot(fx.manifest(spark, sf))


@query
def snapshot_retention_plan(spark, sf):
    return catalog.snapshot_retention_plan(fx.manifest(spark, sf), SNAPSHOT_PREFIXES, dt.datetime(2001, 12, 31))


@query
def register_sql(spark, sf):
    return catalog.register_sql(
        spark,
        {"visits": fx.visits(spark, sf), "patients": fx.patients(spark, sf)},
        """select facility, count(*) filter (where visit_stage in ('Open','Closed','Review')) as checked_in,
                  sum(total_paid) as collected, count(distinct v.patient_id) as patients
           from visits v join patients p on v.patient_id = p.patient_id group by facility""",
    )


# --- sinks ------------------------------------------------------------------------------------

@query
def export_csv(spark, sf):
    path = sinks.export_csv(present(metrics.provider_performance(fx.visits(spark, sf))), scratch_dir(spark, "csv"))
    return spark.read.schema(
        "provider string, visits bigint, billed double, collected double, collection_rate double, "
        "avg_per_visit double, pct_of_revenue double, written_off double"
    ).csv(path, header=True)


@query
def export_json(spark, sf):
    path = sinks.export_json(metrics.facility_comparison(fx.visits(spark, sf)), scratch_dir(spark, "json"))
    return spark.read.schema(
        "facility string, visits bigint, billed double, collected double, collection_rate double, "
        "avg_per_visit double, pct_of_visits double"
    ).json(path)


@query
def export_metrics_bundle(spark, sf):
    """The bundle of a run, read back through its manifest, every measure of every output."""
    folder = scratch_dir(spark, "bundle")
    bundle = report.all_metrics(fx.visits(spark, sf))
    sinks.export_metrics_bundle(bundle.tables, folder, "20010901_000000")
    back = sinks.read_metrics_bundle(spark, folder)
    return report.report_table(report.RevenueMetrics(back, bundle.cube), list(back)).drop("date_range")


@query
def report_table(spark, sf):
    in_range = filters.filter_date_range(fx.visits(spark, sf), "1997-01-01", "1998-12-31")
    return report.report_table(report.all_metrics(in_range, 5), date_range="1997-01-01 to 1998-12-31")


@query
def save_result_sets(spark, sf):
    """Two action lists of a run, saved by run and read back with their rows; an empty list leaves no folder."""
    folder = scratch_dir(spark, "run")
    v = fx.visits(spark, sf)
    results = {
        "needs_attention": actions.needs_attention(v, AS_OF),
        "unbilled": patient.unbilled_visits(v, MONTH),
        "mismatched": v.limit(0),
    }
    sinks.save_result_sets(results, folder, "20010901_000000", skip_empty=["mismatched"])
    run = runs.complete_runs(spark, folder)[-1]
    back = runs.read_run(spark, folder, run)
    if "mismatched" in back:
        raise AssertionError("an empty list is not saved")
    shared = ["patient_id", "dos", "provider", "facility"]
    rows = [df.select(F.lit(name).alias("result"), F.lit(run).alias("run_ts"), *shared) for name, df in sorted(back.items())]
    return reduce(DataFrame.unionByName, rows)


# --- filters and derived columns --------------------------------------------------------------

@query
def filter_date_range(spark, sf):
    v = filters.filter_date_range(fx.visits(spark, sf), "1996-02-01", "1997-02-28")
    return v.select("row_no", "patient_id", "dos", "total_paid")


@query
def filter_month(spark, sf):
    return filters.filter_month(fx.visits(spark, sf), MONTH).select("row_no", "patient_id", "dos")


@query
def stage_class(spark, sf):
    return fx.visits(spark, sf).select("row_no", "visit_stage", labels.stage_class().alias("stage_class"))


@query
def facility_normalized(spark, sf):
    return fx.visits(spark, sf).select(
        "row_no", labels.facility_normalized("facility", FACILITY_MAP).alias("facility_normalized")
    )


@query
def facility_from_office(spark, sf):
    return fx.claims(spark, sf).select("row_no", "office", office_facility("office").alias("facility"))


@query
def claims_facility_filter(spark, sf):
    return filters.claims_facility_filter(fx.claims(spark, sf), INCLUDED_OFFICES).select("row_no", "office", "charges")


@query
def commercial_filter(spark, sf):
    return filters.commercial_filter(fx.visits(spark, sf)).select("row_no", "visit_type", "visit_stage")


@query
def days_since_service(spark, sf):
    return fx.visits(spark, sf).select("row_no", "dos", dates.days_since(AS_OF, "dos").alias("days_since_dos"))


@query
def name_normalized(spark, sf):
    return fx.fixture(spark, sf, "fx_text").select(
        "row_no",
        names.name_upper("name_text").alias("name_upper"),
        names.name_collapsed("name_text").alias("name_collapsed"),
        names.name_flipped("name_text").alias("name_flipped"),
        names.first_last(names.name_upper("name_text")).alias("first_last"),
    )


@query
def dob_normalized(spark, sf):
    return fx.fixture(spark, sf, "fx_text").select("row_no", names.dob_text("date_text").alias("dob"))


@query
def allowed_identity_check(spark, sf):
    v = fx.visits(spark, sf)
    off = F.when(F.col("row_no") % 23 == 0, F.lit("0.01").cast("decimal(18,2)")).otherwise(F.lit(0))
    shifted = v.withColumn("primary_not_allowed", F.col("primary_not_allowed") + off)
    return filters.allowed_identity_check(shifted).select("row_no", "last_billed", "primary_allowed", "primary_not_allowed")


@query
def head_sample(spark, sf):
    return filters.head_sample(fx.visits(spark, sf), 5).select("row_no", "patient_id", "dos", "visit_stage")


@query
def table_info(spark, sf):
    return filters.table_info(fx.fixture(spark, sf, "fx_patients"))


# --- validation -------------------------------------------------------------------------------

@query
def check_columns(spark, sf):
    """Missing columns, with the number of rows that lack them."""
    v = fx.visits(spark, sf).drop("provider", "referral_source", "payer")
    return quality.check_columns(v).withColumn("n_rows", v.agg(F.count("*").alias("n")).scalar())


@query
def profile_dates(spark, sf):
    text = fx.fixture(spark, sf, "fx_text").select(F.col("date_text").alias("dos"))
    return quality.profile_dates(text, "2000-06-30")


def _with_gaps(v: DataFrame) -> DataFrame:
    """Visits with missing ids, shifted dates that collide, and stages nobody knows."""
    return v.withColumns(
        {
            "patient_id": F.when(F.col("row_no") % 29 != 0, F.col("patient_id")),
            "dos": F.trunc("dos", "month"),
            "visit_stage": F.when(F.col("row_no") % 31 == 0, "Lost").when(F.col("row_no") % 37 != 0, F.col("visit_stage")),
            "total_paid": F.when(F.col("row_no") % 41 == 0, -F.col("total_paid")).otherwise(F.col("total_paid")),
        }
    )


@query
def profile_ids(spark, sf):
    return quality.profile_ids(_with_gaps(fx.visits(spark, sf)))


@query
def profile_numeric(spark, sf):
    return quality.profile_numeric(_with_gaps(fx.visits(spark, sf)))


@query
def profile_stages(spark, sf):
    return quality.profile_stages(_with_gaps(fx.visits(spark, sf)))


@query
def business_rule_violations(spark, sf):
    return quality.business_rule_violations(fx.visits(spark, sf), AS_OF)


@query
def validation_summary(spark, sf):
    v = _with_gaps(fx.visits(spark, sf)).drop("referral_source")
    return quality.validation_summary(v, "2000-06-30")


@query
def summary_stats(spark, sf):
    stats = quality.summary_stats(fx.visits(spark, sf))
    rounded = [money.round_half_away(F.col(c)).alias(c) for c in ("mean", "std", "p25", "p50", "p75")]
    return stats.select("column_name", "total_rows", "null_count", "n", "min_value", "max_value", *rounded)


# --- metrics ----------------------------------------------------------------------------------

@query
def executive_summary(spark, sf):
    return metrics.executive_summary(fx.visits(spark, sf))


@query
def provider_performance(spark, sf):
    return metrics.provider_performance(fx.visits(spark, sf))


@query
def insurance_analysis(spark, sf):
    return metrics.insurance_analysis(fx.visits(spark, sf))


@query
def facility_comparison(spark, sf):
    return metrics.facility_comparison(fx.visits(spark, sf))


@query
def collection_pipeline(spark, sf):
    return metrics.collection_pipeline(fx.visits(spark, sf))


@query
def visit_stage_breakdown(spark, sf):
    return metrics.visit_stage_breakdown(_with_gaps(fx.visits(spark, sf)))


@query
def red_flags(spark, sf):
    return metrics.red_flags(fx.visits(spark, sf), 55.0, 2.0)


@query
def all_metrics(spark, sf):
    return report.report_table(report.all_metrics(fx.visits(spark, sf)))


@query
def top_providers(spark, sf):
    return metrics.top_providers(fx.visits(spark, sf), 5)


@query
def overview_kpis(spark, sf):
    return metrics.overview_kpis(fx.visits(spark, sf))


@query
def zero_allowed_visits(spark, sf):
    return metrics.zero_allowed_visits(fx.visits(spark, sf))


@query
def facility_amounts_long(spark, sf):
    return metrics.facility_amounts_long(fx.visits(spark, sf))


@query
def billing_stage_counts(spark, sf):
    return metrics.billing_stage_counts(fx.visits(spark, sf))


@query
def operational_rates(spark, sf):
    return metrics.operational_rates(fx.visits(spark, sf))


@query
def visit_monthly_summary(spark, sf):
    return monthly.visit_monthly_summary(fx.visits(spark, sf))


@query
def monthly_after_change(spark, sf):
    """The monthly summary of yearly exports, brought up to date after one year was delivered anew."""
    landing = scratch_dir(spark, "landing")
    facts, summary = FileTable(spark, scratch_dir(spark, "facts")), FileTable(spark, scratch_dir(spark, "monthly"))
    v, done = fx.visits(spark, sf), []
    changed = v.filter("year(dos) = 1997").withColumn("total_paid", F.col("total_paid") + 1)
    for rows in (v, changed):
        _deliver(rows, landing)
        facts.refresh(_delivered(spark, landing), lambda names: exports.read_visits(spark, names, allow_empty=True), drop_missing=True)
        done.append(incremental.refresh_months(facts, summary, monthly.visit_monthly_summary))
    if any(m[:4] != "1997" for m in done[1].months) or len(done[0].months) <= len(done[1].months):
        raise AssertionError(f"only months of 1997 are derived again: {done[1]}")
    return summary.read().drop("source_id")


@query
def visits_by_period(spark, sf):
    return monthly.visits_by_period(fx.visits(spark, sf), FACILITY)


@query
def facility_month_pivot(spark, sf):
    return monthly.facility_month_pivot(fx.visits(spark, sf), key_lines(spark, sf), FACILITY)


@query
def combined_month_pivot(spark, sf):
    return monthly.combined_month_pivot(fx.visits(spark, sf), key_lines(spark, sf))


@query
def pl_month_table(spark, sf):
    return monthly.pl_month_table(key_lines(spark, sf))


@query
def month_drilldown(spark, sf):
    return monthly.month_drilldown(fx.visits(spark, sf), MONTH)


@query
def other_stage_counts(spark, sf):
    return monthly.other_stage_counts(fx.visits(spark, sf), MONTH)


@query
def billing_summary_by(spark, sf):
    """Both dimensions of the report, one after the other."""
    v = fx.visits(spark, sf)
    parts = [
        monthly.billing_summary_by(v, d, MONTH).withColumnRenamed(d, "value").select(F.lit(d).alias("dimension"), "*")
        for d in ("provider", "payer")
    ]
    return parts[0].unionByName(parts[1])


@query
def billing_totals(spark, sf):
    return monthly.billing_totals(fx.visits(spark, sf), MONTH)


# --- identity ---------------------------------------------------------------------------------

def _master(spark, sf):
    p = fx.patients(spark, sf).filter("patient_id % 2 = 0")
    return p.select(
        F.col("patient_id").cast("string").alias("master_id"),
        F.concat(F.lit("customer "), F.substring("patient_name", 1, 10)).alias("patient_name"),
        F.col("dob").cast("string").alias("date_of_birth"),
    )


def _batch(spark, sf):
    c = fx.claims(spark, sf)
    return c.select(
        F.when(F.col("row_no") % 11 != 0, F.col("row_no").cast("string")).alias("master_id"),
        F.when(F.col("row_no") % 17 == 0, " ").otherwise(F.col("patient_name")).alias("patient_name"),
        F.col("dob").cast("string").alias("date_of_birth"),
        "row_no",
    )


@query
def patients_upsert(spark, sf):
    return identity.patients_upsert(_master(spark, sf), _batch(spark, sf))


@query
def patients_upsert_stats(spark, sf):
    return identity.patients_upsert_stats(_master(spark, sf), _batch(spark, sf))


@query
def patients_from_visits(spark, sf):
    known = identity.patient_names(fx.patients(spark, sf).filter("patient_id % 3 = 0"))
    v = fx.visits(spark, sf).withColumn("patient_id", F.col("patient_id") * 10 + F.col("row_no") % 10)
    return identity.patients_from_visits(known, v)


@query
def claims_patient_match(spark, sf):
    return known_claims(spark, sf).select("row_no", "patient_id", "match_level")


@query
def name_dob_match(spark, sf):
    return matched_claims(spark, sf).select("row_no", "match_id", "candidate_count")


@query
def close_match_candidates(spark, sf):
    return identity.close_match_candidates(matched_claims(spark, sf), fx.patients(spark, sf))


@query
def apply_match_decisions(spark, sf):
    return decided_claims(spark, sf).select("row_no", "match_id")


@query
def match_stats(spark, sf):
    return identity.match_stats(decided_claims(spark, sf))


@query
def unmatched_patients(spark, sf):
    return identity.unmatched_patients(matched_claims(spark, sf), include_close=True)


@query
def id_to_name(spark, sf):
    return identity.id_to_name(fx.patients(spark, sf))


def _headed(spark, sf):
    """Matched claims under the headers of the export."""
    return matched_claims(spark, sf).select(
        F.col("patient_name").alias("Patient Name (First Last)"),
        F.col("match_id").alias("Record_ID"),
        F.col("dob").alias("Patient Birth Date"),
        F.col("office").alias("Office Key and Practice Name"),
        F.col("row_no").alias("Claim Number"),
        F.col("service_date").alias("Service Date"),
        F.col("charges").alias("Charges"),
    )


@query
def deid_split(spark, sf):
    return deidentify.deid_split(matched_claims(spark, sf)).select("row_no", "match_id", "needs_follow_up")


@query
def deid_counts(spark, sf):
    return deidentify.deid_counts(matched_claims(spark, sf))


@query
def deid_follow_up(spark, sf):
    return deidentify.follow_up(matched_claims(spark, sf)).select("row_no", "patient_name", "dob", "match_id")


@query
def deidentify_(spark, sf):
    return deidentify.deidentify(_headed(spark, sf), "Record_ID")


@query
def phi_leak_check(spark, sf):
    return deidentify.phi_leak_check(_headed(spark, sf))


# --- record-level reconciliation --------------------------------------------------------------

@query
def claims_last_by_key(spark, sf):
    return last_claims(spark, sf).select("patient_id", "dos", "row_no", "charges", "office")


@query
def operational_summary(spark, sf):
    return actions.operational_summary(fx.visits(spark, sf))


@query
def needs_attention(spark, sf):
    return actions.needs_attention(fx.visits(spark, sf), AS_OF)


@query
def outstanding_ar(spark, sf):
    return actions.outstanding_ar(fx.visits(spark, sf), last_claims(spark, sf), AS_OF)


@query
def needs_posting(spark, sf):
    return actions.needs_posting(fx.visits(spark, sf), last_claims(spark, sf), AS_OF)


@query
def mismatched_payments(spark, sf):
    return actions.mismatched_payments(fx.visits(spark, sf), last_claims(spark, sf), AS_OF)


@query
def reconciliation_overview(spark, sf):
    v = fx.visits(spark, sf)
    flagged = actions.action_flags(v, last_claims(spark, sf), AS_OF)
    return actions.reconciliation_overview(flagged, v, fx.claims(spark, sf))


@query
def match_status(spark, sf):
    return matching.match_status(*both(spark, sf))


@query
def compare_matched(spark, sf):
    return matching.compare_matched(*both(spark, sf))


@query
def comparison_stats(spark, sf):
    return matching.comparison_stats(*both(spark, sf))


@query
def visits_only(spark, sf):
    return matching.visits_only(*both(spark, sf))


@query
def claims_only(spark, sf):
    return matching.claims_only(*both(spark, sf))


@query
def expected_match_by_stage(spark, sf):
    return matching.expected_match_by_stage(*both(spark, sf))


@query
def billing_master(spark, sf):
    return matching.billing_master(*both(spark, sf))


@query
def billing_master_summary(spark, sf):
    return matching.billing_master_summary(matching.billing_master(*both(spark, sf)))


@query
def combined_dedup(spark, sf):
    return merged(spark, sf)


@query
def combined_stats(spark, sf):
    return combined.combined_stats(*both(spark, sf), office_facility)


@query
def combined_monthly(spark, sf):
    return combined.combined_monthly(merged(spark, sf))


@query
def commercial_detail(spark, sf):
    names_by_id = identity.id_to_name(fx.patients(spark, sf).filter("patient_id % 4 <> 0"))
    return commercial.commercial_detail(fx.visits(spark, sf), last_claims(spark, sf), names_by_id)


@query
def commercial_overview(spark, sf):
    return commercial.commercial_overview(fx.visits(spark, sf), last_claims(spark, sf))


@query
def commercial_rollups(spark, sf):
    return commercial.commercial_rollups(fx.visits(spark, sf), last_claims(spark, sf))


@query
def top_payers(spark, sf):
    return commercial.top_payers(fx.visits(spark, sf), last_claims(spark, sf))


@query
def patient_history(spark, sf):
    return patient.patient_history(
        fx.visits(spark, sf), known_claims(spark, sf), identity.id_to_name(fx.patients(spark, sf)), PATIENT
    )


@query
def patient_header(spark, sf):
    return patient.patient_header(fx.visits(spark, sf))


@query
def unbilled_visits(spark, sf):
    return patient.unbilled_visits(fx.visits(spark, sf), MONTH)


def _tracked(v: DataFrame) -> DataFrame:
    return v.filter("row_no % 2 = 0").select("patient_id", "dos")


@query
def append_new_unbilled(spark, sf):
    v = fx.visits(spark, sf)
    return patient.append_new_unbilled(_tracked(v), patient.unbilled_visits(v, MONTH), AS_OF)


@query
def unbilled_tracker(spark, sf):
    """The tracking table after runs of two months, one of them started twice."""
    v = fx.visits(spark, sf)
    tracker = FileTable(spark, scratch_dir(spark, "tracker"))
    known = v.filter("row_no % 2 = 0").select("patient_id", "dos", "visit_stage", "provider", "facility")
    patient.append_unbilled(tracker, known.filter(F.year("dos") == 1997), "2001-08-01", "start")
    for month, day in ((MONTH, AS_OF), (MONTH, AS_OF), ("1997-07", "2001-10-01")):
        patient.append_unbilled(tracker, patient.unbilled_visits(v, month), day)
    return tracker.read().drop("source_id")


@query
def unbilled_append_counts(spark, sf):
    v = fx.visits(spark, sf)
    return patient.unbilled_append_counts(_tracked(v), patient.unbilled_visits(v, MONTH))


# --- ledger -----------------------------------------------------------------------------------

@query
def deposits_clean(spark, sf):
    return ledger.deposits_clean(fx.deposits(spark, sf), DEPOSIT_ORDER)


@query
def deposits_dedup(spark, sf):
    return clean_deposits(spark, sf)


@query
def deposit_stats(spark, sf):
    return ledger.deposit_stats(clean_deposits(spark, sf))


@query
def patient_deposits(spark, sf):
    return kept_deposits(spark, sf)


@query
def excluded_deposit_stats(spark, sf):
    return ledger.excluded_deposit_stats(clean_deposits(spark, sf), KEYWORDS)


@query
def deposits_by_facility(spark, sf):
    return ledger.deposits_by_facility(clean_deposits(spark, sf), FACILITY)


@query
def deposits_daily(spark, sf):
    return ledger.deposits_daily(clean_deposits(spark, sf), KNOWN_REGIONS)


@query
def deposits_monthly(spark, sf):
    return ledger.deposits_monthly(clean_deposits(spark, sf), KNOWN_REGIONS)


@query
def pl_stats(spark, sf):
    return ledger.pl_stats(pl(spark, sf))


@query
def pl_monthly_revenue(spark, sf):
    return ledger.pl_monthly_revenue(pl(spark, sf), KNOWN_REGIONS)


@query
def pl_monthly_expenses(spark, sf):
    return ledger.pl_monthly_expenses(pl(spark, sf), KNOWN_REGIONS)


@query
def pl_by_category(spark, sf):
    return ledger.pl_by_category(pl(spark, sf), patient_only=False)


@query
def recon_deposits_monthly(spark, sf):
    return ledger.recon_deposits_monthly(fx.visits(spark, sf), kept_deposits(spark, sf), FACILITY_MAP)


@query
def recon_deposits_totals(spark, sf):
    return ledger.recon_deposits_totals(fx.visits(spark, sf), kept_deposits(spark, sf), FACILITY_MAP)


@query
def recon_deposits_flags(spark, sf):
    return ledger.recon_deposits_flags(fx.visits(spark, sf), kept_deposits(spark, sf), FACILITY_MAP)


@query
def recon_pl_monthly(spark, sf):
    return ledger.recon_pl_monthly(merged(spark, sf), pl(spark, sf), FACILITY_MAP)


@query
def recon_pl_totals(spark, sf):
    return ledger.recon_pl_totals(merged(spark, sf), pl(spark, sf), FACILITY_MAP)


@query
def recon_pl_flags(spark, sf):
    return ledger.recon_pl_flags(merged(spark, sf), pl(spark, sf), FACILITY_MAP)


# --- dashboard --------------------------------------------------------------------------------

@query
def monthly_collections(spark, sf):
    return dashboard.monthly_collections(fx.visits(spark, sf), last_claims(spark, sf))


@query
def collections_by_provider(spark, sf):
    return dashboard.collections_by_provider(fx.visits(spark, sf), last_claims(spark, sf), MONTH)


@query
def ar_aging(spark, sf):
    """As-of inside the data range, so that every bucket is reached."""
    return dashboard.ar_aging_of(fx.visits(spark, sf), last_claims(spark, sf), AS_OF)


@query
def available_months(spark, sf):
    return dashboard.available_months(pl(spark, sf), fx.visits(spark, sf))


@query
def pl_month_summary(spark, sf):
    return dashboard.pl_month_summary(pl(spark, sf), PL_MONTH)


@query
def pl_month_categories(spark, sf):
    return dashboard.pl_month_categories(pl(spark, sf), PL_MONTH)


@query
def pl_month_facility_net(spark, sf):
    return dashboard.pl_month_facility_net(pl(spark, sf), PL_MONTH)


@query
def ehr_vs_ledger_gap(spark, sf):
    return dashboard.ehr_vs_ledger_gap(fx.visits(spark, sf), last_claims(spark, sf), pl(spark, sf))


@query
def ar_detail_month(spark, sf):
    return dashboard.ar_detail_month(fx.visits(spark, sf), MONTH)


@query
def ar_detail_totals(spark, sf):
    return dashboard.ar_detail_totals(fx.visits(spark, sf), MONTH)

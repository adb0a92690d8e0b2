"""One patient's visits, and the unbilled-visit tracker."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrecon.functions import labels
from revrecon.functions.dates import as_date, in_month, month_label
from revrecon.functions.money import money_sum
from revrecon.operators.actions import claims_last_by_key, with_claim
from revrecon.operators.lookups import lookup
from revrecon.sources.versions import Appended, FileTable


def patient_history(visits: DataFrame, claims: DataFrame, names_by_id: DataFrame, patient_id) -> DataFrame:
    """Visits of one patient by date with claim payments, first bill date and days to first bill.

    ``claims`` carry patient_id. The patient filter is applied on every input, so it reaches the scans.
    """
    mine = F.col("patient_id") == F.lit(patient_id)
    last = claims_last_by_key(claims.filter(mine))
    joined = with_claim(visits.filter(mine), last, ["insurance_payments", "patient_payments", "first_bill_date"])
    name = names_by_id.filter(mine).select("patient_name").scalar()
    days = F.datediff("claim_first_bill_date", "dos")
    return joined.select(
        "row_no",
        "patient_id",
        F.coalesce(name, F.lit("Unknown")).alias("patient_name"),
        "payer",
        "dos",
        "visit_stage",
        "provider",
        "facility",
        "last_billed",
        "primary_paid",
        "patient_paid",
        "total_paid",
        "claim_insurance_payments",
        "claim_patient_payments",
        "claim_first_bill_date",
        F.when(days >= 0, days).alias("days_to_first_bill"),
    ).orderBy("dos", "row_no")


def patient_header(visits: DataFrame, patient_id=None) -> DataFrame:
    """Per patient: first payer by date, most frequent facility, visits and totals.

    The mode comes from counts per (patient, facility), which combine before the shuffle.
    """
    mine = visits if patient_id is None else visits.filter(F.col("patient_id") == F.lit(patient_id))
    per_facility = (
        mine.filter(F.col("patient_id").isNotNull())
        .groupBy("patient_id", "facility")
        .agg(
            F.count("*").alias("n"),
            F.min(F.struct(F.col("dos").isNull().alias("undated"), "dos", "row_no", "payer")).alias("first"),
            money_sum("last_billed").alias("billed"),
            money_sum("total_paid").alias("paid"),
        )
    )
    return per_facility.groupBy("patient_id").agg(
        F.min("first")["payer"].alias("payer"),
        F.min_by("facility", F.when(F.col("facility").isNotNull(), F.struct(-F.col("n"), "facility"))).alias("facility"),
        F.sum("n").alias("visits"),
        F.sum("billed").alias("total_billed"),
        F.sum("paid").alias("total_paid"),
    )


def unbilled_visits(visits: DataFrame, month: str) -> DataFrame:
    """Checked-in visits of a month that were never billed."""
    return visits.filter(
        in_month("dos", month) & labels.is_billing() & F.col("last_billed").isNull()
    ).select("patient_id", "dos", "visit_stage", "provider", "facility")


def append_new_unbilled(tracked: DataFrame, unbilled: DataFrame, run_date: str | dt.date) -> DataFrame:
    """Unbilled rows whose (patient, date) the tracking table lacks, stamped with run date and month."""
    seen = tracked.select("patient_id", "dos").distinct()
    return lookup(unbilled, seen, ["patient_id", "dos"], "left_anti", spread_by="provider").select(
        as_date(run_date).alias("run_date"), month_label("dos").alias("month_label"), "patient_id", "dos",
        "visit_stage", "provider", "facility",
    )


def unbilled_append_counts(tracked: DataFrame, unbilled: DataFrame) -> DataFrame:
    """One row: rows added and rows skipped because they are tracked already."""
    seen = tracked.select("patient_id", "dos", F.lit(True).alias("known")).distinct()
    per_key = unbilled.groupBy("patient_id", "dos").agg(F.count("*").alias("n"))
    return per_key.join(seen, ["patient_id", "dos"], "left").agg(
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("added"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("skipped"),
    )


def append_unbilled(tracker: FileTable, unbilled: DataFrame, run_date: str | dt.date, run_id: str | None = None) -> Appended:
    """Adds the unbilled rows that the tracking table lacks, once per run (by default one run a day).

    Rows are compared with the table as it is when the run commits, so a run that is started again, or two runs at
    once, add a visit once. Rows without patient or date match nothing and are added by every run that brings them.
    """
    stamp = dt.date.fromisoformat(str(run_date))

    def new_rows(tracked: DataFrame | None) -> DataFrame:
        known = unbilled.limit(0) if tracked is None else tracked
        return append_new_unbilled(known, unbilled, run_date)

    return tracker.append(run_id or f"unbilled-{stamp}", new_rows, dt.datetime.combine(stamp, dt.time()))

"""Visits and claims as one table, one row per (patient, date)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrecon.functions.dates import month_key

KEYS = ["patient_id", "service_date"]
_AMOUNTS = ("charges", "patient_payments", "insurance_payments", "total_paid")


def _money(value: Column, name: str) -> Column:
    return F.coalesce(value, F.lit(0)).cast("decimal(18,2)").alias(name)


def _common(
    visits: DataFrame, claims: DataFrame, office_facility: Callable[[str], Column]
) -> DataFrame:
    """Union of both systems on common columns, every row of both.

    ``in_combined`` tells the rows that the combined table is made of: dated ones, and of the claims
    those whose patient is known. ``alone`` is the row's number where no patient is known, so such
    rows share no key.
    """
    zero = F.lit(0)
    from_visits = visits.select(
        "patient_id",
        F.col("dos").alias("service_date"),
        _money(F.col("last_billed"), "charges"),
        _money(F.col("patient_paid"), "patient_payments"),
        _money(F.coalesce("primary_paid", zero) + F.coalesce("secondary_paid", zero), "insurance_payments"),
        _money(F.col("total_paid"), "total_paid"),
        "facility",
        F.lit(True).alias("is_visit"),
        "row_no",
    )
    from_claims = claims.select(
        "patient_id",
        "service_date",
        _money(F.col("charges"), "charges"),
        _money(F.col("patient_payments"), "patient_payments"),
        _money(F.col("insurance_payments"), "insurance_payments"),
        _money(F.coalesce("patient_payments", zero) + F.coalesce("insurance_payments", zero), "total_paid"),
        office_facility("office").alias("facility"),
        F.lit(False).alias("is_visit"),
        "row_no",
    )
    known = F.col("patient_id").isNotNull()
    return from_visits.unionByName(from_claims).withColumns(
        {
            "in_combined": F.col("service_date").isNotNull() & (F.col("is_visit") | known),
            "alone": F.when(~known, F.col("row_no")),
        }
    )


def _source(is_visit: Column) -> Column:
    return F.when(is_visit, "Visits").otherwise("Claims").alias("source")


def _best() -> Column:
    return F.struct("total_paid", "is_visit", (-F.col("row_no")).alias("earlier"))


def combined_dedup(
    visits: DataFrame, claims: DataFrame, office_facility: Callable[[str], Column]
) -> DataFrame:
    """One row per (patient, date): the highest total paid; visits before claims, then file order.

    An aggregate keeps the best row per key inside each task before the shuffle, so a key with very
    many rows stays cheap. Rows without a date are out; a visit without a patient id stays as it is,
    one row each, under its row number as a further key: both sources are read once.
    """
    rows = _common(visits, claims, office_facility).filter("in_combined")
    kept = F.struct("charges", "patient_payments", "insurance_payments", "facility", "total_paid", "is_visit")
    best = rows.groupBy(*KEYS, "alone").agg(F.max_by(kept, _best()).alias("r"))
    return best.select(*KEYS, *[f"r.{a}" for a in _AMOUNTS], "r.facility", _source(F.col("r.is_visit")))


def combined_stats(
    visits: DataFrame, claims: DataFrame, office_facility: Callable[[str], Column]
) -> DataFrame:
    """One row: inputs, matched and unmatched claims, duplicates removed, final rows by source.

    Counts are additive per (patient, date), so one grouping of one union answers all of them. A key's
    final row is a visit if the best visit is paid no less than the best claim, which takes two
    amounts and no text, so rows are never sorted.
    """
    rows = _common(visits, claims, office_facility)
    per_key = rows.groupBy(*KEYS, "alone", "in_combined").agg(
        F.count("*").alias("n"),
        F.count_if("is_visit").alias("n_visits"),
        F.max(F.when(F.col("is_visit"), F.col("total_paid"))).alias("best_visit"),
        F.max(F.when(~F.col("is_visit"), F.col("total_paid"))).alias("best_claim"),
    )
    final = F.col("in_combined")
    is_visit = F.col("best_visit").isNotNull() & F.coalesce(F.col("best_visit") >= F.col("best_claim"), F.lit(True))
    n_claims = F.col("n") - F.col("n_visits")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return per_key.agg(
        total(F.col("n_visits")).alias("visit_records"),
        total(n_claims).alias("claim_records"),
        total(F.when(F.col("patient_id").isNotNull(), n_claims)).alias("claims_matched"),
        total(F.when(F.col("patient_id").isNull(), n_claims)).alias("claims_unmatched"),
        total(F.when(final, F.col("n"))).alias("combined_records"),
        (total(F.when(final, F.col("n"))) - F.count_if(final)).alias("duplicates_removed"),
        F.count_if(final).alias("final_records"),
        F.count_if(final & is_visit).alias("final_from_visits"),
        F.count_if(final & ~is_visit).alias("final_from_claims"),
    )


def combined_monthly(combined: DataFrame) -> DataFrame:
    """Month and facility: charges, patient, insurance, total, visits."""
    return (
        combined.filter(F.col("facility").isNotNull())
        .groupBy(month_key("service_date").alias("month"), "facility")
        .agg(
            F.sum("charges").alias("charges"),
            F.sum("patient_payments").alias("patient_paid"),
            F.sum("insurance_payments").alias("insurance_paid"),
            F.sum("total_paid").alias("total_paid"),
            F.count("patient_id").alias("visit_count"),
        )
        .orderBy("month", "facility")
    )

"""Commercial audit: commercial visits with their claims, totals and roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrecon.functions.money import money_sum
from revrecon.operators.actions import with_claim
from revrecon.operators.filters import commercial_filter
from revrecon.operators.lookups import lookup

_CLAIM_COLUMNS = ("insurance_payments", "adjustments", "patient_payments", "current_balance")


def commercial_base(visits: DataFrame, claims_last: DataFrame) -> DataFrame:
    """Commercial billing-stage visits with the amounts of their claim."""
    base = commercial_filter(visits).withColumn("last_billed", F.coalesce("last_billed", F.lit(0)))
    return with_claim(base, claims_last, _CLAIM_COLUMNS)


def commercial_detail(
    visits: DataFrame, claims_last: DataFrame, names_by_id: DataFrame, ordered: bool = True
) -> DataFrame:
    """One row per commercial visit with claim amounts, match flag and the name from the master."""
    names = names_by_id.select("patient_id", F.col("patient_name").alias("master_name"))
    rows = (
        lookup(commercial_base(visits, claims_last), names, ["patient_id"])
        .select(
            "row_no",
            "patient_id",
            F.coalesce("master_name", F.lit("Unknown")).alias("patient_name"),
            "dos",
            "visit_stage",
            "visit_type",
            "payer_type",
            "payer",
            "facility",
            "last_billed",
            "primary_paid",
            "claim_insurance_payments",
            "claim_adjustments",
            "patient_paid",
            "claim_patient_payments",
            "current_balance",
            "claim_current_balance",
            F.when(F.col("claim_match"), "Yes").otherwise("No").alias("claim_match"),
        )
    )
    return rows.orderBy("patient_name", "dos", "row_no") if ordered else rows


def _sums() -> list[Column]:
    return [
        F.count("*").alias("visits"),
        F.count_if("claim_match").alias("matched"),
        money_sum("last_billed").alias("charges"),
        money_sum("claim_insurance_payments").alias("claim_insurance"),
        money_sum("claim_patient_payments").alias("claim_patient"),
        money_sum("claim_current_balance").alias("claim_balance"),
    ]


def commercial_overview(visits: DataFrame, claims_last: DataFrame) -> DataFrame:
    """One row: visits, matched, unmatched, charges by match, claim sums and the balance check."""
    matched = F.col("claim_match")
    totals = commercial_base(visits, claims_last).agg(
        *_sums(),
        F.count_if(~matched).alias("unmatched"),
        money_sum("last_billed", matched).alias("matched_charges"),
        money_sum("last_billed", ~matched).alias("unmatched_charges"),
        money_sum("claim_adjustments").alias("claim_adjustments"),
    )
    check = F.col("matched_charges") - F.col("claim_adjustments") - F.col("claim_insurance") - F.col("claim_patient")
    return totals.withColumn("balance_check", check)


_SETS = (("facility",), ("payer",), ("visit_stage",), ("patient_id",), ("facility", "visit_stage"))


def commercial_rollups(visits: DataFrame, claims_last: DataFrame) -> DataFrame:
    """The sums by facility, payer, stage, patient, and facility x stage, from one join.

    The visits are first reduced to the finest combination of the dimensions; only those group rows
    are expanded into the five grouping sets.
    """
    dims = ["facility", "payer", "visit_stage", "patient_id"]
    names = ["visits", "matched", "charges", "claim_insurance", "claim_patient", "claim_balance"]
    finest = commercial_base(visits, claims_last).groupBy(*dims).agg(*_sums())
    rolled = finest.groupingSets([list(s) for s in _SETS], *dims).agg(
        *[F.sum(n).alias(n) for n in names], *[F.grouping(d).alias(f"no_{d}") for d in dims]
    )
    label = None
    missing = None
    for s in _SETS:
        here = F.lit(True)
        for d in dims:
            here = here & (F.col(f"no_{d}") == F.lit(0 if d in s else 1))
        text = " x ".join(s)
        label = F.when(here, text) if label is None else label.when(here, text)
        blank = here & F.concat(*[F.col(d).cast("string") for d in s]).isNull()
        missing = blank if missing is None else missing | blank
    return rolled.filter(~missing).select(
        label.alias("rollup"), "facility", "payer", "visit_stage", F.col("patient_id").cast("string").alias("patient_id"),
        *names,
    )


def top_payers(visits: DataFrame, claims_last: DataFrame, n: int = 10) -> DataFrame:
    """The n payers with the highest charges, and whether a balance remains."""
    balance = F.when(F.col("claim_balance") > 0, "Balance Remaining").otherwise("Fully Resolved")
    return (
        commercial_base(visits, claims_last)
        .filter(F.col("payer").isNotNull())
        .groupBy("payer")
        .agg(*_sums())
        .select("payer", "charges", "claim_balance", "visits", balance.alias("balance_flag"))
        .orderBy(F.desc("charges"), "payer")
        .limit(n)
    )

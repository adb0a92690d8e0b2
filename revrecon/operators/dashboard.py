"""Queries behind the monthly dashboard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrecon import rules
from revrecon.functions import labels
from revrecon.functions.dates import in_month, month_key
from revrecon.functions.money import money_sum, pct
from revrecon.operators.actions import outstanding_ar, with_claim


def with_collected(visits: DataFrame, claims_last: DataFrame, month: str | None = None) -> DataFrame:
    """Billing-stage visits with ``collected``: paid on the visit if above 0, else paid on the claim, else 0.

    Visits that show a payment need no claim, so only the unpaid ones take part in the join.
    """
    billing = visits.filter(labels.is_billing())
    if month is not None:
        billing = billing.filter(in_month("dos", month))
    total = F.col("total_paid")
    columns = [*visits.columns, "collected"]
    paid = billing.filter(total > 0).withColumn("collected", total.cast("decimal(19,2)"))
    from_claim = F.coalesce("claim_insurance_payments", F.lit(0)) + F.coalesce("claim_patient_payments", F.lit(0))
    unpaid = with_claim(
        billing.filter((total <= 0) | total.isNull()), claims_last, ["insurance_payments", "patient_payments"]
    ).withColumn("collected", from_claim.cast("decimal(19,2)"))
    return paid.select(*columns).unionByName(unpaid.select(*columns))


def monthly_collections(visits: DataFrame, claims_last: DataFrame, month: str | None = None) -> DataFrame:
    """Per month: charges, collected, open AR, visits by stage, rate over visits with an allowed amount."""
    stage, has_allowed = F.col("visit_stage"), F.col("primary_allowed") > 0
    sums = (
        with_collected(visits, claims_last, month)
        .groupBy(month_key("dos").alias("month"))
        .agg(
            money_sum("last_billed").alias("total_charges"),
            money_sum("collected").alias("total_collected"),
            money_sum("last_billed", stage == "Open").alias("total_ar"),
            F.count("*").alias("visit_count"),
            F.count_if(stage == "Open").alias("open_count"),
            F.count_if(stage == "Closed").alias("closed_count"),
            F.count_if(stage == "Review").alias("review_count"),
            money_sum("total_paid", has_allowed).alias("paid"),
            money_sum("primary_allowed", has_allowed).alias("allowed"),
        )
    )
    return sums.withColumn("collection_rate", F.coalesce(pct("paid", "allowed"), F.lit(0.0))).drop("paid", "allowed")


def collections_by_provider(visits: DataFrame, claims_last: DataFrame, month: str | None = None) -> DataFrame:
    """Charges and collections per provider."""
    return (
        with_collected(visits, claims_last, month)
        .groupBy("provider")
        .agg(money_sum("last_billed").alias("charges"), money_sum("collected").alias("collected"))
    )


def ar_aging(outstanding: DataFrame) -> DataFrame:
    """Outstanding visits in four age buckets: visits and amount; an empty bucket shows 0.

    All buckets are counted in one aggregate and then turned into rows, so none can be missing.
    """
    age = F.col("days_since_dos")
    measures, rows = [], []
    for i, (label, first, last) in enumerate(rules.AGE_BUCKETS):
        inside = (age >= first) if last is None else (age >= first) & (age <= last)
        measures += [F.count_if(inside).alias(f"n{i}"), money_sum("last_billed", inside).alias(f"a{i}")]
        rows.append(
            F.struct(F.lit(label).alias("bucket"), F.col(f"n{i}").alias("visits"), F.col(f"a{i}").alias("amount"))
        )
    return outstanding.agg(*measures).select(F.inline(F.array(*rows)))


def ar_aging_of(visits: DataFrame, claims_last: DataFrame, as_of: str | dt.date) -> DataFrame:
    return ar_aging(outstanding_ar(visits, claims_last, as_of, ordered=False))


def available_months(pl: DataFrame, visits: DataFrame) -> DataFrame:
    """Distinct months of ledger and visits, newest first."""
    months = pl.select("month").unionByName(visits.select(month_key("dos").alias("month")))
    return months.filter(F.col("month").isNotNull()).distinct().orderBy(F.desc("month"))


def _income_expense() -> list:
    return [
        money_sum("amount", F.col("type") == "Income").alias("income"),
        money_sum("amount", F.col("type") == "Expense").alias("expenses"),
    ]


def pl_month_summary(pl: DataFrame, month: str) -> DataFrame:
    """One month: income, expenses, net."""
    sums = pl.filter(F.col("month") == month).agg(*_income_expense())
    return sums.withColumn("net", F.col("income") - F.col("expenses"))


def pl_month_categories(pl: DataFrame, month: str) -> DataFrame:
    """One month: amount by type and category."""
    rows = pl.filter(F.col("month") == month)
    return rows.groupBy("type", "category").agg(F.sum("amount").alias("amount"))


def pl_month_facility_net(pl: DataFrame, month: str) -> DataFrame:
    """One month: revenue, expenses and net per facility."""
    sums = pl.filter(F.col("month") == month).groupBy("facility").agg(*_income_expense())
    return sums.select(
        "facility", F.col("income").alias("revenue"), "expenses", (F.col("income") - F.col("expenses")).alias("net")
    )


def ehr_vs_ledger_gap(visits: DataFrame, claims_last: DataFrame, pl: DataFrame, month: str | None = None) -> DataFrame:
    """Per month: collections, ledger income and the gap between them."""
    collected = (
        with_collected(visits, claims_last, month)
        .groupBy(month_key("dos").alias("month"))
        .agg(money_sum("collected").alias("ehr_collected"))
    )
    rows = pl if month is None else pl.filter(F.col("month") == month)
    income = (
        rows.filter(F.col("type") == "Income").groupBy("month").agg(money_sum("amount").alias("ledger_income"))
    )
    return collected.join(income, "month", "full_outer").select(
        "month",
        F.coalesce("ehr_collected", F.lit(0)).alias("ehr_collected"),
        F.coalesce("ledger_income", F.lit(0)).alias("ledger_income"),
        (F.coalesce("ehr_collected", F.lit(0)) - F.coalesce("ledger_income", F.lit(0))).alias("gap"),
    )


def ar_detail_month(visits: DataFrame, month: str) -> DataFrame:
    """Open visits of a month without the name column."""
    return visits.filter(in_month("dos", month) & (F.col("visit_stage") == "Open")).drop("patient_name")


def ar_detail_totals(visits: DataFrame, month: str) -> DataFrame:
    """One row: number of open visits of a month and their billed sum."""
    return ar_detail_month(visits, month).agg(
        F.count("*").alias("open_visits"), money_sum("last_billed").alias("total_ar")
    )

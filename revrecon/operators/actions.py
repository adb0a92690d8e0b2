"""Record-level reconciliation: what the billing team has to act on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revrecon import rules
from revrecon.functions import labels
from revrecon.functions.dates import days_since
from revrecon.functions.money import money_sum, pct
from revrecon.operators.lookups import lookup, pick_per_key

CLAIM_AMOUNTS = ("charges", "adjustments", "insurance_payments", "patient_payments", "current_balance")


def claims_last_by_key(claims: DataFrame, order_by: Sequence[str] = ("row_no",)) -> DataFrame:
    """One claim per (patient_id, dos): the last in file order. Claims without id or date are out."""
    keyed = claims.filter(F.col("patient_id").isNotNull() & F.col("service_date").isNotNull())
    return pick_per_key(keyed.withColumnRenamed("service_date", "dos"), ["patient_id", "dos"], order_by)


def with_claim(visits: DataFrame, claims_last: DataFrame, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Visits with ``claim_*`` columns of the claim for the same patient and date.

    ``claim_match`` tells whether there is one. Only the requested columns enter the aggregate that
    made ``claims_last``.
    """
    side = claims_last.select(
        "patient_id", "dos", F.lit(True).alias("claim_match"), *[F.col(c).alias(f"claim_{c}") for c in columns]
    )
    joined = lookup(visits, side, ["patient_id", "dos"], how)
    return joined.withColumn("claim_match", F.coalesce("claim_match", F.lit(False)))


def operational_summary(visits: DataFrame) -> DataFrame:
    """Operational stages: count and share of operational visits."""
    counts = (
        visits.filter(labels.is_operational())
        .groupBy("visit_stage")
        .agg(F.count("patient_id").alias("n"))
    )
    # at most one row per operational stage reaches the unpartitioned window
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy())).select(
        "visit_stage", "n", pct("n", "total", 1).alias("pct_of_operational")
    )


def action_flags(
    visits: DataFrame,
    claims_last: DataFrame,
    as_of: str | dt.date,
    attention_days: int = rules.REVIEW_ATTENTION_DAYS,
    ar_days: int = rules.OUTSTANDING_AR_DAYS,
) -> DataFrame:
    """Billing-stage visits with their claim payments and one flag per action list.

    One join serves all lists: needs_attention, outstanding_ar, needs_posting, mismatched.
    """
    billing = visits.filter(labels.is_billing()).withColumn("days_since_dos", days_since(as_of, "dos"))
    joined = with_claim(billing, claims_last, ["insurance_payments", "patient_payments"])
    zero = F.lit(0)
    claim_ins = F.coalesce("claim_insurance_payments", zero)
    claim_pat = F.coalesce("claim_patient_payments", zero)
    visit_ins = F.coalesce("primary_paid", zero)
    visit_pat = F.coalesce("patient_paid", zero)
    ins_differs = (visit_ins > 0) & (claim_ins > 0) & (visit_ins != claim_ins)
    pat_differs = (visit_pat > 0) & (claim_pat > 0) & (visit_pat != claim_pat)
    stage, age = F.col("visit_stage"), F.col("days_since_dos")
    unpaid = (F.coalesce("total_paid", zero) == 0) & (claim_ins == 0) & (claim_pat == 0)
    flags = {
        "needs_attention": (stage == "Review") & (age > attention_days),
        "outstanding_ar": (stage == "Open") & (age > ar_days) & unpaid,
        "needs_posting": ((claim_ins > 0) & (visit_ins == 0)) | ((claim_pat > 0) & (visit_pat == 0)),
        "mismatched": ins_differs | pat_differs,
    }
    return joined.withColumns(
        {name: F.coalesce(test, F.lit(False)) for name, test in flags.items()}
    ).withColumns(
        {"insurance_diff": visit_ins - claim_ins, "patient_diff": visit_pat - claim_pat}
    )


def _sorted(rows: DataFrame, ordered: bool, *keys) -> DataFrame:
    """A global sort costs one more shuffle of the result; runs that only save the list leave it out."""
    return rows.orderBy(*keys) if ordered else rows


def needs_attention(
    visits: DataFrame, as_of: str | dt.date, days: int = rules.REVIEW_ATTENTION_DAYS, ordered: bool = True
) -> DataFrame:
    """Review visits older than ``days``, oldest first. Needs no claims, so it joins nothing."""
    rows = (
        visits.filter(F.col("visit_stage") == "Review")
        .withColumn("days_since_dos", days_since(as_of, "dos"))
        .filter(F.col("days_since_dos") > days)
        .select("row_no", "patient_id", "dos", "days_since_dos", "provider", "facility",
                F.coalesce("last_billed", F.lit(0)).alias("last_billed"))
    )
    return _sorted(rows, ordered, F.desc("days_since_dos"), "row_no")


def outstanding_ar(
    visits: DataFrame,
    claims_last: DataFrame,
    as_of: str | dt.date,
    days: int = rules.OUTSTANDING_AR_DAYS,
    ordered: bool = True,
) -> DataFrame:
    """Open visits older than ``days`` without a payment in either system, oldest first."""
    old_open = visits.filter(
        (F.col("visit_stage") == "Open")
        & (days_since(as_of, "dos") > days)
        & ((F.col("total_paid") == 0) | F.col("total_paid").isNull())
    )
    rows = (
        action_flags(old_open, claims_last, as_of, ar_days=days)
        .filter("outstanding_ar")
        .select("row_no", "patient_id", "dos", "days_since_dos", "provider", "facility", "payer",
                F.coalesce("last_billed", F.lit(0)).alias("last_billed"),
                F.when(F.col("claim_match"), "Yes").otherwise("No").alias("claim_match"))
    )
    return _sorted(rows, ordered, F.desc("days_since_dos"), "row_no")


_PAYMENT_COLUMNS = ("row_no", "patient_id", "dos", "visit_stage", "provider", "facility", "last_billed",
                    "primary_paid", "claim_insurance_payments", "patient_paid", "claim_patient_payments")


def needs_posting(
    visits: DataFrame, claims_last: DataFrame, as_of: str | dt.date, ordered: bool = True
) -> DataFrame:
    """A claim payment above 0 where the visit shows 0 (insurance or patient)."""
    rows = action_flags(visits, claims_last, as_of).filter("claim_match and needs_posting")
    return _sorted(rows.select(*_PAYMENT_COLUMNS), ordered, "dos", "row_no")


def mismatched_payments(
    visits: DataFrame, claims_last: DataFrame, as_of: str | dt.date, ordered: bool = True
) -> DataFrame:
    """Both systems show a payment and the amounts differ; differences are visit minus claim."""
    rows = action_flags(visits, claims_last, as_of).filter("claim_match and mismatched")
    return _sorted(rows.select(*_PAYMENT_COLUMNS, "insurance_diff", "patient_diff"), ordered, "dos", "row_no")


def reconciliation_overview(flagged: DataFrame, visits: DataFrame, claims: DataFrame) -> DataFrame:
    """(section, measure, value): record counts, then count, amounts and age of each action list.

    ``flagged`` comes from :func:`action_flags`; all four lists are measured in one aggregate.
    """
    attention, ar = F.col("needs_attention"), F.col("outstanding_ar")
    posting, differ = F.col("needs_posting"), F.col("mismatched")
    lists = {
        ("needs_attention", "n"): F.count_if(attention),
        ("needs_attention", "amount_on_hold"): money_sum("last_billed", attention),
        ("needs_attention", "oldest_days"): F.max(F.when(attention, F.col("days_since_dos"))),
        ("outstanding_ar", "n"): F.count_if(ar),
        ("outstanding_ar", "amount_at_risk"): money_sum("last_billed", ar),
        ("outstanding_ar", "oldest_days"): F.max(F.when(ar, F.col("days_since_dos"))),
        ("outstanding_ar", "without_claim"): F.count_if(ar & ~F.col("claim_match")),
        ("needs_posting", "n"): F.count_if(posting),
        ("needs_posting", "insurance_to_post"): money_sum("claim_insurance_payments", posting),
        ("needs_posting", "patient_to_post"): money_sum("claim_patient_payments", posting),
        ("mismatched", "n"): F.count_if(differ),
        ("mismatched", "insurance_discrepancy"): money_sum(F.abs("insurance_diff"), differ),
        ("mismatched", "patient_discrepancy"): money_sum(F.abs("patient_diff"), differ),
    }
    records = {
        ("records", "visits"): F.count("*"),
        ("records", "billing_visits"): F.count_if(labels.is_billing()),
        ("records", "operational_visits"): F.count_if(labels.is_operational()),
    }

    def rows(df: DataFrame, measures: dict) -> DataFrame:
        one = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures.values())])
        structs = [
            F.struct(F.lit(s).alias("section"), F.lit(m).alias("measure"), F.col(f"m{i}").cast("double").alias("value"))
            for i, (s, m) in enumerate(measures)
        ]
        return one.select(F.inline(F.array(*structs)))

    return (
        rows(visits, records)
        .unionByName(rows(claims, {("records", "claims"): F.count("*")}))
        .unionByName(rows(flagged, lists))
    )


"""Deposits, the long P&L table, and month-level reconciliation of visits with either."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrecon import rules
from revrecon.functions.dates import month_key
from revrecon.functions.labels import facility_normalized
from revrecon.functions.money import money_sum, ratio, round_half_away

ALL = "ALL"


# --- deposits ---------------------------------------------------------------------------------

def deposits_dedup(deposits: DataFrame, order_by: Sequence[str] = ("row_no",)) -> DataFrame:
    """One row per (facility, date, amount, memo), first in file order. A missing memo equals another."""
    keys = ["facility", "txn_date", "amount", "memo"]
    kept = [c for c in deposits.columns if c not in keys]
    first = F.min_by(F.struct(*kept), F.struct(*order_by)).alias("r")
    return deposits.groupBy(*keys).agg(first).select(*keys, "r.*")


def deposits_clean(deposits: DataFrame, order_by: Sequence[str] = ("row_no",)) -> DataFrame:
    """All facilities' deposits without repeats, by date."""
    return deposits_dedup(deposits, order_by).orderBy("txn_date", "facility", *order_by)


def _labelled_total(rolled: DataFrame) -> DataFrame:
    """The roll-up's total row under the name ALL."""
    return rolled.withColumn(
        "facility", F.when(F.col("is_total") == 1, ALL).otherwise(F.col("facility"))
    ).drop("is_total")


def deposit_stats(deposits: DataFrame) -> DataFrame:
    """Count, sum and date range per facility and in total; the total is rolled up from group rows."""
    groups = deposits.groupBy("facility").agg(
        F.count("*").alias("n"), money_sum("amount").alias("total"),
        F.min("txn_date").alias("first_date"), F.max("txn_date").alias("last_date"),
    )
    rolled = groups.rollup("facility").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), money_sum("total").alias("total"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.grouping("facility").alias("is_total"),
    )
    return _labelled_total(rolled)


def is_non_patient(keywords: Sequence[str] = rules.NON_PATIENT_KEYWORDS) -> Column:
    memo = F.lower("memo")
    hit = F.lit(False)
    for word in keywords:
        hit = hit | memo.contains(word)
    return F.coalesce(hit, F.lit(False))


def patient_deposits(deposits: DataFrame, keywords: Sequence[str] = rules.NON_PATIENT_KEYWORDS) -> DataFrame:
    """Deposits whose memo has none of the non-patient keywords; a missing memo is kept."""
    return deposits.filter(~is_non_patient(keywords))


def excluded_deposit_stats(deposits: DataFrame, keywords: Sequence[str] = rules.NON_PATIENT_KEYWORDS) -> DataFrame:
    """One row: count and sum of the excluded and of the kept deposits."""
    out = is_non_patient(keywords)
    return deposits.agg(
        F.count_if(out).alias("excluded"),
        money_sum("amount", out).alias("excluded_amount"),
        F.count_if(~out).alias("kept"),
        money_sum("amount", ~out).alias("kept_amount"),
    )


def deposits_by_facility(deposits: DataFrame, facility: str) -> DataFrame:
    return deposits.filter(F.lower("facility") == facility.lower())


def _facility_pivot(df: DataFrame, key: str, facilities: Sequence[str]) -> DataFrame:
    """Sum of amount per key and facility as columns (missing 0), with a row total over all facilities.

    One conditional sum per listed facility: an explicit list, so no extra pass finds the values. What facilities
    outside the list hold, and rows without one, is in ``other``.
    """
    sums = [money_sum("amount", F.col("facility") == f).alias(f) for f in facilities]
    listed = F.coalesce(F.col("facility").isin(*facilities), F.lit(False))
    return df.groupBy(key).agg(*sums, money_sum("amount", ~listed).alias("other"), money_sum("amount").alias("total"))


def deposits_daily(deposits: DataFrame, facilities: Sequence[str]) -> DataFrame:
    return _facility_pivot(deposits.withColumnRenamed("txn_date", "date"), "date", facilities).orderBy("date")


def deposits_monthly(deposits: DataFrame, facilities: Sequence[str]) -> DataFrame:
    return _facility_pivot(deposits.withColumn("month", month_key("txn_date")), "month", facilities).orderBy("month")


# --- long P&L table ---------------------------------------------------------------------------

def pl_stats(pl: DataFrame) -> DataFrame:
    """(measure, facility, value): income, expense, patient revenue, months, categories; per facility and ALL."""
    income, patient = F.col("type") == "Income", F.col("is_patient_revenue")
    stats = pl.rollup("facility").agg(
        money_sum("amount", income).alias("total_income"),
        money_sum("amount", ~income).alias("total_expense"),
        money_sum("amount", patient).alias("patient_revenue"),
        money_sum("amount", income & ~patient).alias("non_patient_revenue"),
        F.concat_ws("|", F.sort_array(F.collect_set("month"))).alias("months"),
        F.concat_ws("|", F.sort_array(F.collect_set("category"))).alias("categories"),
        F.grouping("facility").alias("is_total"),
    )
    return _labelled_total(stats)


def pl_monthly_revenue(pl: DataFrame, facilities: Sequence[str], patient_only: bool = True) -> DataFrame:
    rows = pl.filter(F.col("is_patient_revenue") if patient_only else F.col("type") == "Income")
    return _facility_pivot(rows, "month", facilities).orderBy("month")


def pl_monthly_expenses(pl: DataFrame, facilities: Sequence[str]) -> DataFrame:
    return _facility_pivot(pl.filter(F.col("type") == "Expense"), "month", facilities).orderBy("month")


def pl_by_category(pl: DataFrame, patient_only: bool = True) -> DataFrame:
    rows = pl.filter(F.col("is_patient_revenue") if patient_only else F.col("type") == "Income")
    return rows.groupBy("category").agg(F.sum("amount").alias("amount")).orderBy(F.desc("amount"), "category")


# --- month-level reconciliation ---------------------------------------------------------------

@dataclass(frozen=True)
class ReconRule:
    """Thresholds and texts of one month-level reconciliation."""

    flag_pct: float
    flag_amount: float
    high_amount: float
    pct_without_visits: float
    causes_ledger_high: Sequence[str]
    causes_visits_high: Sequence[str]


DEPOSIT_RULE = ReconRule(
    rules.DEPOSIT_FLAG_PCT, rules.FLAG_AMOUNT, rules.DEPOSIT_HIGH_AMOUNT, 0.0,
    rules.DEPOSIT_CAUSES_LEDGER_HIGH, rules.DEPOSIT_CAUSES_VISITS_HIGH,
)
LEDGER_RULE = ReconRule(
    rules.LEDGER_FLAG_PCT, rules.FLAG_AMOUNT, rules.LEDGER_HIGH_AMOUNT, 100.0,
    rules.PL_CAUSES_LEDGER_HIGH, rules.PL_CAUSES_VISITS_HIGH,
)


def _visit_rows(visits: DataFrame, facility_map: Mapping[str, str]) -> DataFrame:
    return visits.select(
        month_key("dos").alias("month"),
        facility_normalized("facility", facility_map).alias("facility"),
        "patient_id", "total_paid", "patient_paid", "primary_paid",
    )


def _visit_sums() -> list[Column]:
    return [
        money_sum("total_paid").alias("visits_collected"),
        money_sum("patient_paid").alias("visits_patient_paid"),
        money_sum("primary_paid").alias("visits_insurance_paid"),
        F.count("patient_id").alias("visit_count"),
    ]


def _discrepancy(joined: DataFrame, rule: ReconRule) -> DataFrame:
    diff = F.col("ledger_amount") - F.col("visits_collected")
    without = F.when(F.col("ledger_amount") != 0, rule.pct_without_visits).otherwise(0.0)
    share = F.coalesce(ratio("discrepancy", "visits_collected", 100.0), without)
    review = (F.abs("discrepancy_pct") > rule.flag_pct) | (F.abs("discrepancy") > rule.flag_amount)
    return (
        joined.withColumn("discrepancy", diff)
        .withColumn("discrepancy_pct", share)
        .withColumn("flag", F.when(review, "REVIEW").otherwise("OK"))
        .withColumn("discrepancy_pct", round_half_away(F.col("discrepancy_pct")))
    )


def _monthly(visits: DataFrame, ledger: DataFrame, facility_map, rule: ReconRule) -> DataFrame:
    """Both sides reduced to (month, facility) before the join: the join sees group rows only."""
    left = (
        _visit_rows(visits, facility_map)
        .filter(F.col("month").isNotNull())
        .groupBy("month", "facility")
        .agg(*_visit_sums())
    )
    right = (
        ledger.filter(F.col("month").isNotNull() & F.col("facility").isNotNull())
        .groupBy("month", "facility")
        .agg(money_sum("amount").alias("ledger_amount"), F.count("*").alias("ledger_count"))
    )
    amounts = ["visits_collected", "visits_patient_paid", "visits_insurance_paid", "visit_count", "ledger_amount",
               "ledger_count"]
    joined = left.join(right, ["month", "facility"], "full_outer").select(
        "month", "facility", *[F.coalesce(F.col(a), F.lit(0)).alias(a) for a in amounts]
    )
    return _discrepancy(joined, rule)


def _totals(visits: DataFrame, ledger: DataFrame, facility_map, rule: ReconRule) -> DataFrame:
    def rolled(df: DataFrame, sums: list[Column], names: list[str]) -> DataFrame:
        groups = df.groupBy("facility").agg(*sums)
        totals = groups.rollup("facility").agg(*[money_sum(n).alias(n) for n in names], F.grouping("facility").alias("is_total"))
        return _labelled_total(totals)

    names = ["visits_collected", "visits_patient_paid", "visits_insurance_paid"]
    left = rolled(_visit_rows(visits, facility_map), _visit_sums()[:3], names)
    right = rolled(ledger, [money_sum("amount").alias("ledger_amount")], ["ledger_amount"])
    amounts = ["visits_collected", "visits_patient_paid", "visits_insurance_paid", "ledger_amount"]
    joined = left.join(right, "facility", "full_outer").select(
        "facility", *[F.coalesce(F.col(a), F.lit(0)).alias(a) for a in amounts]
    )
    share = F.coalesce(ratio("discrepancy", "visits_collected", 100.0), F.lit(0.0))
    return joined.withColumn("discrepancy", F.col("ledger_amount") - F.col("visits_collected")).withColumn(
        "discrepancy_pct", round_half_away(share)
    )


def recon_flags(monthly: DataFrame, rule: ReconRule) -> DataFrame:
    """Months to review with severity, direction and possible causes."""
    ledger_high = F.col("ledger_amount") > F.col("visits_collected")
    causes = F.when(ledger_high, F.array(*[F.lit(c) for c in rule.causes_ledger_high])).otherwise(
        F.array(*[F.lit(c) for c in rule.causes_visits_high])
    )
    return monthly.filter(F.col("flag") == "REVIEW").select(
        "month", "facility", "visits_collected", "ledger_amount", "discrepancy", "discrepancy_pct",
        F.when(F.abs("discrepancy") > rule.high_amount, "HIGH").otherwise("MEDIUM").alias("severity"),
        F.when(ledger_high, "ledger > visits").otherwise("visits > ledger").alias("direction"),
        causes.alias("possible_causes"),
    )


def _deposit_ledger(deposits: DataFrame) -> DataFrame:
    return deposits.select(month_key("txn_date").alias("month"), "facility", "amount")


def recon_deposits_monthly(
    visits: DataFrame, deposits: DataFrame, facility_map: Mapping[str, str], rule: ReconRule = DEPOSIT_RULE
) -> DataFrame:
    """Visit collections against (patient) deposits per month and facility."""
    return _monthly(visits, _deposit_ledger(deposits), facility_map, rule)


def recon_deposits_totals(
    visits: DataFrame, deposits: DataFrame, facility_map: Mapping[str, str], rule: ReconRule = DEPOSIT_RULE
) -> DataFrame:
    """The same overall (ALL) and per facility."""
    return _totals(visits, _deposit_ledger(deposits), facility_map, rule)


def recon_deposits_flags(
    visits: DataFrame, deposits: DataFrame, facility_map: Mapping[str, str], rule: ReconRule = DEPOSIT_RULE
) -> DataFrame:
    return recon_flags(recon_deposits_monthly(visits, deposits, facility_map, rule), rule)


def _combined_visits(combined: DataFrame) -> DataFrame:
    """The combined table under visit column names; rows without facility or date are out."""
    named = combined.select(
        "patient_id",
        F.col("service_date").alias("dos"),
        "facility",
        "total_paid",
        F.col("patient_payments").alias("patient_paid"),
        F.col("insurance_payments").alias("primary_paid"),
    )
    return named.filter(F.col("facility").isNotNull() & (F.col("facility") != "") & F.col("dos").isNotNull())


def _patient_ledger(pl: DataFrame) -> DataFrame:
    return pl.filter("is_patient_revenue").select("month", "facility", "amount")


def recon_pl_monthly(
    combined: DataFrame, pl: DataFrame, facility_map: Mapping[str, str], rule: ReconRule = LEDGER_RULE
) -> DataFrame:
    """Combined collections against patient revenue of the P&L per month and facility."""
    return _monthly(_combined_visits(combined), _patient_ledger(pl), facility_map, rule).drop("ledger_count")


def recon_pl_totals(
    combined: DataFrame, pl: DataFrame, facility_map: Mapping[str, str], rule: ReconRule = LEDGER_RULE
) -> DataFrame:
    """The same overall (ALL) and per facility."""
    return _totals(_combined_visits(combined), _patient_ledger(pl), facility_map, rule)


def recon_pl_flags(
    combined: DataFrame, pl: DataFrame, facility_map: Mapping[str, str], rule: ReconRule = LEDGER_RULE
) -> DataFrame:
    return recon_flags(recon_pl_monthly(combined, pl, facility_map, rule), rule)

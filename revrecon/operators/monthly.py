"""Visit metrics by month, and month pivots that place them beside the ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrecon.functions import labels
from revrecon.functions.dates import in_month, month_key, month_label
from revrecon.functions.money import money_sum, pct, rounded_ratio

ALL_FACILITIES = "COMBINED"
PIVOT_METRICS = ("checked_in", "unbilled", "billed", "collected", "pl_revenue", "pl_expenses", "net_income")


def _unbilled() -> Column:
    return labels.is_billing() & (F.coalesce(F.col("last_billed"), F.lit(0)) == 0)


def visit_monthly_summary(visits: DataFrame) -> DataFrame:
    """Per month and facility: checked-in, unbilled, cancelled, no-show, charges, collected, allowed."""
    return (
        visits.groupBy(month_key("dos").alias("month"), "facility")
        .agg(
            F.min(month_label("dos")).alias("month_label"),
            F.count_if(labels.is_billing()).alias("checked_in"),
            F.count_if(_unbilled()).alias("unbilled"),
            F.count_if(labels.is_canceled()).alias("cancelled"),
            F.count_if(F.col("visit_stage") == "No Show").alias("no_show"),
            F.round(money_sum("last_billed", labels.is_billing()), 0).alias("gross_charges"),
            F.round(money_sum("total_paid"), 0).alias("collected"),
            F.round(money_sum("primary_allowed", labels.is_billing()), 0).alias("primary_allowed"),
        )
        .orderBy("month", "facility")
    )


def _period_measures() -> list[Column]:
    return [
        F.count_if(labels.is_billing()).alias("checked_in"),
        F.count_if(_unbilled()).alias("unbilled"),
        money_sum("last_billed", labels.is_billing()).alias("billed"),
        money_sum("total_paid").alias("collected"),
    ]


def visits_by_period(visits: DataFrame, facility: str) -> DataFrame:
    """Per month for one facility: checked-in, unbilled, billed, collected."""
    one = visits.filter(F.col("facility") == facility)
    return one.groupBy(month_key("dos").alias("month")).agg(*_period_measures())


def _ledger_months(key_lines: DataFrame) -> DataFrame:
    """Key lines (facility, line_item, month, amount) -> one row per facility and month."""
    def line(name: str) -> Column:
        return money_sum("amount", F.col("line_item") == name)

    return key_lines.groupBy("facility", "month").agg(
        line("Total for Income").alias("pl_revenue"),
        line("Total for Expenses").alias("pl_expenses"),
        line("Net Income").alias("net_income"),
    )


def _metric_rows(visits: DataFrame, key_lines: DataFrame) -> DataFrame:
    """(facility, month, metric, amount); months of either side, missing amounts 0."""
    periods = visits.groupBy("facility", month_key("dos").alias("month")).agg(*_period_measures())
    both = periods.join(_ledger_months(key_lines), ["facility", "month"], "full_outer")
    filled = both.select(
        "facility", "month", *[F.coalesce(F.col(m), F.lit(0)).cast("decimal(28,2)").alias(m) for m in PIVOT_METRICS]
    )
    return filled.unpivot(["facility", "month"], list(PIVOT_METRICS), "metric", "amount")


def _pivot(rows: DataFrame, keys: Sequence[str], months: Sequence[str] | None) -> DataFrame:
    """One column per month; without a list, those of the data: one distinct over rows grouped by month already."""
    if months is None:
        wide = rows.filter(F.col("month").isNotNull()).groupBy(*keys).pivot("month").agg(F.sum("amount"))
    else:
        listed = rows.filter(F.col("month").isin(*months))
        wide = listed.groupBy(*keys).pivot("month", list(months)).agg(F.sum("amount"))
    cells = [c for c in wide.columns if c not in keys]
    return wide.select(*keys, *[F.coalesce(F.col(f"`{m}`"), F.lit(0)).alias(m) for m in cells])


def facility_month_pivot(
    visits: DataFrame, key_lines: DataFrame, facility: str, months: Sequence[str] | None = None
) -> DataFrame:
    """Metric rows by month columns for one facility, visits and ledger side by side.

    Without ``months``, every month that either side has.
    """
    of_facility = F.col("facility") == facility
    rows = _metric_rows(visits.filter(of_facility), key_lines.filter(of_facility))
    return _pivot(rows, ["metric"], months)


def combined_month_pivot(
    visits: DataFrame, key_lines: DataFrame, months: Sequence[str] | None = None
) -> DataFrame:
    """The same for every facility, with the sum over facilities as ``COMBINED``."""
    rows = _metric_rows(visits, key_lines)
    totals = (
        rows.groupingSets([["facility", "month", "metric"], ["month", "metric"]], "facility", "month", "metric")
        .agg(F.sum("amount").alias("amount"), F.grouping("facility").alias("is_total"))
        .withColumn("facility", F.when(F.col("is_total") == 1, ALL_FACILITIES).otherwise(F.col("facility")))
    )
    return _pivot(totals, ["facility", "metric"], months)


def pl_month_table(key_lines: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Per facility and month: revenue, expenses, net income, contract labor; absent lines are 0."""
    if months is not None:
        key_lines = key_lines.filter(F.col("month").isin(*months))
    names = {
        "Total for Income": "revenue",
        "Total for Expenses": "expenses",
        "Net Income": "net_income",
        "Contract labor": "contract_labor",
    }
    wide = key_lines.groupBy("facility", "month").pivot("line_item", list(names)).agg(F.sum("amount"))
    return wide.select(
        "facility", "month", *[F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(v) for k, v in names.items()]
    )


def month_drilldown(visits: DataFrame, month: str) -> DataFrame:
    """One month: scheduled, checked-in, cancelled, no-show, the rest, and never-billed visits."""
    counts = visits.filter(in_month("dos", month)).agg(
        F.count("*").alias("scheduled"),
        F.count_if(labels.is_billing()).alias("checked_in"),
        F.count_if(labels.is_canceled()).alias("cancelled"),
        F.count_if(F.col("visit_stage") == "No Show").alias("no_show"),
        F.count_if(labels.is_billing() & F.col("last_billed").isNull()).alias("never_billed"),
    )
    return counts.select(
        "scheduled", "checked_in", "cancelled", "no_show",
        (F.col("scheduled") - F.col("checked_in") - F.col("cancelled") - F.col("no_show")).alias("unaccounted"),
        "never_billed",
        pct("never_billed", "checked_in", 1).alias("never_billed_pct"),
    )


def other_stage_counts(visits: DataFrame, month: str) -> DataFrame:
    """Stages of a month outside the counted groups, with their counts."""
    counted = labels.is_billing() | labels.is_canceled() | (F.col("visit_stage") == "No Show")
    return (
        visits.filter(in_month("dos", month) & ~counted)
        .groupBy("visit_stage")
        .agg(F.count("*").alias("n"))
    )


def _billing_measures() -> list[Column]:
    billed = F.col("last_billed") > 0
    return [
        F.count_if(billed).alias("billed_count"),
        money_sum("last_billed", billed).alias("billed_total"),
        money_sum("primary_allowed").alias("allowed"),
        money_sum("total_paid").alias("paid"),
        money_sum("primary_paid").alias("insurance_paid"),
        money_sum("patient_paid").alias("patient_paid"),
    ]


def _with_average(df: DataFrame) -> DataFrame:
    average = F.coalesce(rounded_ratio("billed_total", "billed_count"), F.lit(0.0))
    return df.withColumn("billed_avg", average)


def billing_summary_by(visits: DataFrame, dim: str, month: str | None = None) -> DataFrame:
    """Checked-in visits per ``dim``: count, sum and mean of positive bills, sums of the payments."""
    base = visits.filter(labels.is_billing() & F.col(dim).isNotNull())
    if month is not None:
        base = base.filter(in_month("dos", month))
    return _with_average(base.groupBy(dim).agg(*_billing_measures()))


def billing_totals(visits: DataFrame, month: str | None = None) -> DataFrame:
    """The grand totals of the same measures."""
    base = visits.filter(labels.is_billing())
    if month is not None:
        base = base.filter(in_month("dos", month))
    return _with_average(base.agg(*_billing_measures()))

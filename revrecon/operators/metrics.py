"""Revenue metrics over visits.

Facts are scanned once per metric and reduced to group rows (:func:`metric_cube`); everything else,
shares of total included, is arithmetic on group rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revrecon import rules, schemas
from revrecon.functions import labels
from revrecon.functions.money import MONEY_TYPE, money_sum, pct, ratio, round_half_away, rounded_ratio

CUBE_DIMS = ("provider", "payer_type", "facility", "visit_stage")

_MEASURES = ("n_rows", "visits", "billed", "collected", "written_off", "insurance_paid", "patient_paid",
             "patient_responsible", "uncollected_n", "uncollected_amount")


def metric_cube(visits: DataFrame, dims: Sequence[str] = CUBE_DIMS) -> DataFrame:
    """Additive measures per combination of ``dims``: the only pass over the visits.

    Partial aggregation runs before the one shuffle, so a dimension value that holds a third of the
    rows costs each task a single row.
    """
    uncollected = (
        (F.col("total_paid") == 0)
        & (F.col("primary_allowed") > 0)
        & ~F.coalesce(F.col("visit_stage").isin(*rules.UNCOLLECTED_EXCLUDED_STAGES), F.lit(False))
    )
    responsible = (
        money_sum("patient_responsibility")
        if "patient_responsibility" in visits.columns
        else F.lit(0).cast(MONEY_TYPE)
    )
    return visits.groupBy(*dims).agg(
        F.count("*").alias("n_rows"),
        F.count("patient_id").alias("visits"),
        money_sum("primary_allowed").alias("billed"),
        money_sum("total_paid").alias("collected"),
        money_sum("written_off").alias("written_off"),
        money_sum("primary_paid").alias("insurance_paid"),
        money_sum("patient_paid").alias("patient_paid"),
        responsible.alias("patient_responsible"),
        F.count_if(uncollected).alias("uncollected_n"),
        money_sum("primary_allowed", uncollected).alias("uncollected_amount"),
    )


def _totals(cube: DataFrame) -> DataFrame:
    return cube.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in _MEASURES])


def _by(cube: DataFrame, dim: str) -> DataFrame:
    """Group rows of one dimension with the grand totals beside them; null keys leave at the end.

    The window has no partition because its input is one row per dimension value, never a fact.
    """
    groups = cube.groupBy(dim).agg(*[F.expr(f"sum({m}) as {m}") for m in _MEASURES])
    everything = Window.partitionBy()
    return (
        groups.withColumn("all_rows", F.sum("n_rows").over(everything))
        .withColumn("all_collected", F.sum("collected").over(everything))
        .filter(F.col(dim).isNotNull())
    )


_RATES = {
    "collection_rate": lambda: pct("collected", "billed"),
    "avg_per_visit": lambda: rounded_ratio("collected", "visits"),
    "pct_of_revenue": lambda: pct("collected", "all_collected"),
    "pct_of_visits": lambda: pct("visits", "all_rows"),
}


def _group_metrics(cube: DataFrame, dim: str, columns: Sequence[str]) -> DataFrame:
    return _by(cube, dim).select(dim, *[_RATES[c]().alias(c) if c in _RATES else c for c in columns])


def provider_performance_of(cube: DataFrame) -> DataFrame:
    return _group_metrics(
        cube, "provider",
        ["visits", "billed", "collected", "collection_rate", "avg_per_visit", "pct_of_revenue", "written_off"],
    )


def insurance_analysis_of(cube: DataFrame) -> DataFrame:
    return _group_metrics(
        cube, "payer_type",
        ["visits", "billed", "collected", "collection_rate", "avg_per_visit", "pct_of_visits", "pct_of_revenue"],
    )


def facility_comparison_of(cube: DataFrame) -> DataFrame:
    return _group_metrics(
        cube, "facility", ["visits", "billed", "collected", "collection_rate", "avg_per_visit", "pct_of_visits"]
    )


def visit_stage_breakdown_of(cube: DataFrame) -> DataFrame:
    return _by(cube, "visit_stage").select(
        "visit_stage", F.col("visits").alias("n"), pct("visits", "all_rows").alias("pct_of_total"), "billed",
        "collected",
    )


def provider_performance(visits: DataFrame) -> DataFrame:
    """Per provider: visits, billed, collected, rates, share of revenue; best collected first."""
    return provider_performance_of(metric_cube(visits, ["provider"])).orderBy(F.desc("collected"), "provider")


def insurance_analysis(visits: DataFrame) -> DataFrame:
    """Per payer type: visits, billed, collected, rates, shares of visits and revenue."""
    return insurance_analysis_of(metric_cube(visits, ["payer_type"])).orderBy(F.desc("collected"), "payer_type")


def facility_comparison(visits: DataFrame) -> DataFrame:
    """Per facility: visits, billed, collected, rates, share of visits."""
    return facility_comparison_of(metric_cube(visits, ["facility"])).orderBy(F.desc("collected"), "facility")


def visit_stage_breakdown(visits: DataFrame) -> DataFrame:
    """Per stage: count, share of all visits, billed, collected; most frequent first."""
    return visit_stage_breakdown_of(metric_cube(visits, ["visit_stage"])).orderBy(F.desc("n"), "visit_stage")


def top_providers(visits: DataFrame, n: int) -> DataFrame:
    """The n providers with the highest collections."""
    return provider_performance(visits).limit(n)


def _outstanding() -> Column:
    left = F.col("billed") - F.col("collected") - F.col("written_off")
    return F.greatest(left, F.lit(0).cast(MONEY_TYPE))


def summary_row(totals: DataFrame) -> DataFrame:
    """The executive summary from grand totals that carry unique_patients."""
    return totals.select(
        F.col("n_rows").alias("total_visits"),
        "unique_patients",
        F.col("billed").alias("total_billed"),
        F.col("collected").alias("total_collected"),
        F.when(F.col("billed") > 0, pct("collected", "billed")).otherwise(0.0).alias("collection_rate"),
        F.when(F.col("n_rows") > 0, rounded_ratio("collected", "n_rows")).otherwise(0.0).alias(
            "avg_collection_per_visit"
        ),
        F.col("written_off").alias("total_written_off"),
        _outstanding().alias("total_outstanding"),
    )


def executive_summary(visits: DataFrame) -> DataFrame:
    """One row: visits, patients, billed, collected, rates, written off, outstanding.

    The first step reduces visits to one row per patient, combined inside each task; a patient with
    very many visits is therefore no hot spot, and distinct patients are plain rows afterwards.
    """
    per_patient = metric_cube(visits, ["patient_id"])
    totals = per_patient.agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in _MEASURES],
        F.count("patient_id").alias("unique_patients"),
    )
    return summary_row(totals)


def unique_patients(visits: DataFrame) -> DataFrame:
    return visits.agg(F.count_distinct("patient_id").alias("unique_patients"))


_PIPELINE = (
    ("billed", F.col, None),
    ("insurance_allowed", lambda _: F.col("billed"), None),
    ("insurance_paid", F.col, "pct"),
    ("patient_responsible", F.col, None),
    ("patient_paid", F.col, "pct"),
    ("written_off", F.col, "pct"),
    ("total_collected", lambda _: F.col("collected"), "pct"),
    ("total_outstanding", lambda _: _outstanding(), "pct"),
)


def collection_pipeline_of(cube: DataFrame) -> DataFrame:
    steps = []
    for i, (name, amount, share) in enumerate(_PIPELINE):
        value = amount(name)
        part = F.when(F.col("billed") > 0, pct(value, F.col("billed"))) if share else F.lit(None)
        steps.append(
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(name).alias("stage"),
                value.cast("double").alias("amount"),
                part.cast("double").alias("pct_of_billed"),
            )
        )
    return _totals(cube).select(F.inline(F.array(*steps)))


def collection_pipeline(visits: DataFrame) -> DataFrame:
    """Where the billed money is: one row per step, with its share of billed where that has a meaning."""
    return collection_pipeline_of(metric_cube(visits, []))


_FLAG_COLUMNS = "severity", "flag_type", "subject", "affected_records", "rate", "amount"


def red_flags_of(
    cube: DataFrame,
    rate_floor: float = rules.COLLECTION_RATE_FLOOR,
    write_off_ceiling: float = rules.WRITE_OFF_CEILING,
) -> DataFrame:
    def flag(df: DataFrame, severity: str, kind: str, subject: Column, n: Column, rate: Column, amount: Column):
        values = (F.lit(severity), F.lit(kind), subject, n, rate, amount)
        return df.select(*[v.alias(c) for v, c in zip(values, _FLAG_COLUMNS)])

    none = F.lit(None)
    low_payers = insurance_analysis_of(cube).filter(F.col("collection_rate") < rate_floor)
    low_providers = provider_performance_of(cube).filter(F.col("collection_rate") < rate_floor)
    totals = _totals(cube)
    share = F.when(F.col("billed") > 0, ratio("written_off", "billed", 100.0)).otherwise(0.0)
    parts = [
        flag(low_payers, "medium", "Low Insurance Collection Rate", F.col("payer_type"), F.col("visits"),
             F.col("collection_rate"), F.col("collected").cast("double")),
        flag(totals.filter("uncollected_n > 0"), "high", "Uncollected Claims with Balance", F.lit("all"),
             F.col("uncollected_n"), none.cast("double"), F.col("uncollected_amount").cast("double")),
        flag(totals.filter(share > write_off_ceiling), "medium", "High Write-off Percentage", F.lit("all"),
             none.cast("long"), round_half_away(share), F.col("written_off").cast("double")),
        flag(low_providers, "low", "Provider Below Collection Threshold", F.col("provider"), F.col("visits"),
             F.col("collection_rate"), F.col("collected").cast("double")),
    ]
    return reduce(DataFrame.unionByName, parts)


def red_flags(
    visits: DataFrame,
    rate_floor: float = rules.COLLECTION_RATE_FLOOR,
    write_off_ceiling: float = rules.WRITE_OFF_CEILING,
) -> DataFrame:
    """Payers and providers with a low rate, uncollected claims, high write-offs. Null rates never flag."""
    return red_flags_of(metric_cube(visits, ["provider", "payer_type"]), rate_floor, write_off_ceiling)


def overview_kpis(visits: DataFrame) -> DataFrame:
    """Billing stages: visits, charged, collected, balance and the rate over visits with an allowed amount."""
    has_allowed = F.col("primary_allowed") > 0
    kpis = visits.filter(labels.is_billing()).agg(
        F.count("*").alias("total_visits"),
        money_sum("last_billed").alias("total_charged"),
        money_sum("total_paid").alias("total_collected"),
        money_sum("current_balance").alias("total_balance"),
        money_sum("total_paid", has_allowed).alias("paid"),
        money_sum("primary_allowed", has_allowed).alias("allowed"),
    )
    return kpis.select(
        "total_visits", "total_charged", "total_collected", "total_balance",
        F.coalesce(pct("paid", "allowed"), F.lit(0.0)).alias("collection_rate"),
    )


def zero_allowed_visits(visits: DataFrame) -> DataFrame:
    """Per payer type: visits, paid and charges where nothing was allowed; kept apart from the rate."""
    return (
        visits.filter((F.col("primary_allowed") == 0) & F.col("payer_type").isNotNull())
        .groupBy("payer_type")
        .agg(
            F.count("*").alias("visits"),
            money_sum("total_paid").alias("paid"),
            money_sum("last_billed").alias("charges"),
        )
    )


def facility_amounts_long(visits: DataFrame) -> DataFrame:
    """Billing stages: charged, collected and outstanding per facility as (facility, metric, amount)."""
    sums = (
        visits.filter(labels.is_billing() & F.col("facility").isNotNull())
        .groupBy("facility")
        .agg(
            money_sum("last_billed").cast("double").alias("Charged"),
            money_sum("total_paid").cast("double").alias("Collected"),
            money_sum("current_balance").cast("double").alias("Outstanding"),
        )
    )
    return sums.unpivot("facility", ["Charged", "Collected", "Outstanding"], "metric", "amount")


def billing_stage_counts(visits: DataFrame) -> DataFrame:
    return visits.filter(labels.is_billing()).groupBy("visit_stage").agg(F.count("*").alias("n"))


def operational_rates(visits: DataFrame) -> DataFrame:
    """No-show and cancellation rate over all scheduled visits, per facility."""
    counts = visits.groupBy("facility").agg(
        F.count("*").alias("scheduled"),
        F.count_if(F.col("visit_stage") == "No Show").alias("no_show"),
        F.count_if(labels.is_canceled()).alias("canceled"),
    )
    return counts.select(
        "facility", "scheduled", "no_show", "canceled",
        pct("no_show", "scheduled").alias("no_show_rate"),
        pct("canceled", "scheduled").alias("cancellation_rate"),
    )


def require_metric_columns(visits: DataFrame) -> None:
    """Raise when a column that the metrics need is missing; looks at the schema only."""
    missing = [c for c in schemas.METRIC_COLUMNS if c not in visits.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")

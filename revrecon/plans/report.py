"""The revenue report: all metrics from one pass over the visits, as tables or as one long table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrecon.operators import metrics as m
from revrecon.session import settle


@dataclass(frozen=True)
class RevenueMetrics:
    """Metric tables by name, and the group rows they share."""

    tables: dict[str, DataFrame]
    cube: DataFrame


def all_metrics(visits: DataFrame, n_providers: int | None = None) -> RevenueMetrics:
    """Every metric of the report.

    The visits are read once into a cube of group rows (provider x payer type x facility x stage).
    Seven tables read it, so it is written to the shared folder; nothing stays in the cache.
    Distinct patients are not additive and are counted by a pass over that one column.
    """
    m.require_metric_columns(visits)
    cube = settle(visits.sparkSession, m.metric_cube(visits), "metric_cube")
    patients = m.unique_patients(visits).scalar()
    totals = cube.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", "billed", "collected", "written_off")])
    providers = m.provider_performance_of(cube).orderBy(F.desc("collected"), "provider")
    tables = {
        "executive_summary": m.summary_row(totals.withColumn("unique_patients", patients)),
        "collection_pipeline": m.collection_pipeline_of(cube),
        "provider_performance": providers if n_providers is None else providers.limit(n_providers),
        "facility_comparison": m.facility_comparison_of(cube).orderBy(F.desc("collected"), "facility"),
        "insurance_analysis": m.insurance_analysis_of(cube).orderBy(F.desc("collected"), "payer_type"),
        "visit_stage_breakdown": m.visit_stage_breakdown_of(cube).orderBy(F.desc("n"), "visit_stage"),
        "red_flags": m.red_flags_of(cube),
    }
    return RevenueMetrics(tables, cube)


# section -> column(s) that name the row
_KEYS = {
    "executive_summary": None,
    "collection_pipeline": "stage",
    "provider_performance": "provider",
    "facility_comparison": "facility",
    "insurance_analysis": "payer_type",
    "visit_stage_breakdown": "visit_stage",
    "red_flags": "flag_type",
}


def _long(section: str, df: DataFrame) -> DataFrame:
    key = F.lit("all") if _KEYS[section] is None else F.col(_KEYS[section])
    if section == "red_flags":
        key = F.concat("severity", F.lit(": "), "flag_type", F.lit(": "), "subject")
    named = df.withColumn("row_key", key)
    measures = [
        f.name for f in df.schema.fields if f.dataType.typeName() in ("long", "double", "decimal") and f.name != "step"
    ]
    doubles = named.select("row_key", *[F.col(c).cast("double").alias(c) for c in measures])
    return doubles.unpivot("row_key", measures, "measure", "value").select(
        F.lit(section).alias("section"), F.col("row_key").alias("key"), "measure", "value"
    )


def report_table(
    metrics: RevenueMetrics, sections: list[str] | None = None, date_range: str | None = None
) -> DataFrame:
    """Report sections as one table (section, key, measure, value), tagged with the date range."""
    chosen = sections or list(_KEYS)
    rows = reduce(DataFrame.unionByName, [_long(s, metrics.tables[s]) for s in chosen])
    return rows.withColumn("date_range", F.lit(date_range or "all")).filter(F.col("value").isNotNull())

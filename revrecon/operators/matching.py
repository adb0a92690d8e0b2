"""Visits against claims on (patient, date): match status, comparison, one-sided records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrecon import rules
from revrecon.functions.labels import yes_no
from revrecon.functions.money import pct
from revrecon.operators.actions import claims_last_by_key
from revrecon.operators.lookups import pick_per_key

KEYS = ["patient_id", "dos"]
_VISIT_COLUMNS = ("row_no", "payer", "provider", "referral_source", "facility", "visit_stage", "last_billed",
                  "patient_paid", "primary_paid", "total_paid")


def visits_last_by_key(visits: DataFrame, order_by: Sequence[str] = ("row_no",)) -> DataFrame:
    """One visit per (patient_id, dos): the last in file order; visits without id or date are out."""
    keyed = visits.filter(F.col("patient_id").isNotNull() & F.col("dos").isNotNull())
    return pick_per_key(keyed, KEYS, order_by)


def _sides(visits: DataFrame, claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    left = visits_last_by_key(visits.select(*KEYS, *_VISIT_COLUMNS))
    right = claims_last_by_key(claims)
    return left, right


def _open_visits(visits: DataFrame) -> DataFrame:
    """Visits without an id or a date: they match no claim and are never merged with each other."""
    return visits.filter(F.col("patient_id").isNull() | F.col("dos").isNull()).select(*KEYS, *_VISIT_COLUMNS)


def match_status(visits: DataFrame, claims: DataFrame) -> DataFrame:
    """(patient_id, dos, visit_row, claim_row, status): matched, visits_only or claims_only.

    Both sides arrive unique per key and partitioned by it, so the full join adds no exchange and
    no key can be hot. Rows without a full key cannot match; they follow as one-sided rows of their
    own and are not merged with each other.
    """
    left = visits_last_by_key(visits.select(*KEYS, "row_no")).withColumnRenamed("row_no", "visit_row")
    right = claims_last_by_key(claims.select("patient_id", "service_date", "row_no")).withColumnRenamed(
        "row_no", "claim_row"
    )
    status = (
        F.when(F.col("claim_row").isNull(), "visits_only")
        .when(F.col("visit_row").isNull(), "claims_only")
        .otherwise("matched")
    )
    joined = left.join(right, KEYS, "full_outer").select(*KEYS, "visit_row", "claim_row", status.alias("status"))
    no_row = F.lit(None).cast("long")
    open_visits = visits.filter(F.col("patient_id").isNull() | F.col("dos").isNull()).select(
        *KEYS, F.col("row_no").alias("visit_row"), no_row.alias("claim_row"), F.lit("visits_only").alias("status")
    )
    open_claims = claims.filter(F.col("patient_id").isNull() | F.col("service_date").isNull()).select(
        "patient_id", F.col("service_date").alias("dos"), no_row.alias("visit_row"),
        F.col("row_no").alias("claim_row"), F.lit("claims_only").alias("status"),
    )
    return joined.unionByName(open_visits).unionByName(open_claims)


_FIELDS = (
    ("billed", "BILLED", "visit_billed", "claim_charges"),
    ("patient", "PATIENT PAID", "visit_patient_paid", "claim_patient_paid"),
    ("insurance", "INSURANCE PAID", "visit_insurance_paid", "claim_insurance_paid"),
    ("total", "TOTAL PAID", "visit_total_paid", "claim_total_paid"),
)


def _amount(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("decimal(18,2)")


def _visit_side(left: DataFrame) -> DataFrame:
    return left.select(
        *KEYS, "payer", "provider", "referral_source", "facility", "visit_stage",
        _amount("last_billed").alias("visit_billed"),
        _amount("patient_paid").alias("visit_patient_paid"),
        _amount("primary_paid").alias("visit_insurance_paid"),
        _amount("total_paid").alias("visit_total_paid"),
    )


def _claim_side(right: DataFrame) -> DataFrame:
    total = F.coalesce("patient_payments", F.lit(0)) + F.coalesce("insurance_payments", F.lit(0))
    return right.select(
        *KEYS,
        _amount("charges").alias("claim_charges"),
        _amount("patient_payments").alias("claim_patient_paid"),
        _amount("insurance_payments").alias("claim_insurance_paid"),
        total.cast("decimal(18,2)").alias("claim_total_paid"),
    )


def _discrepancies() -> Column:
    texts = [
        F.when(
            F.col(v) != F.col(c),
            F.concat(F.lit(f"{label}: visit=$"), F.col(v).cast("string"), F.lit(" vs claim=$"), F.col(c).cast("string")),
        )
        for _, label, v, c in _FIELDS
    ]
    joined = F.array_join(F.array_compact(F.array(*texts)), " | ")
    return F.when(joined == "", "None").otherwise(joined)


def _compared(joined: DataFrame) -> DataFrame:
    matches = {f"{name}_match": yes_no(F.col(v) == F.col(c)) for name, _, v, c in _FIELDS}
    return joined.withColumns(matches).withColumn("discrepancies", _discrepancies())


def compare_matched(visits: DataFrame, claims: DataFrame) -> DataFrame:
    """Matched records with the amounts side by side, YES/NO per amount, and the differences as text."""
    left, right = _sides(visits, claims)
    return _compared(_visit_side(left).join(_claim_side(right), KEYS)).drop("visit_stage")


def comparison_stats(visits: DataFrame, claims: DataFrame) -> DataFrame:
    """One row: totals, matched share of claims, differing fields and records, match quality."""
    left, right = _sides(visits, claims)
    differs = {name: F.col(v) != F.col(c) for name, _, v, c in _FIELDS}
    stats = (
        _visit_side(left)
        .join(_claim_side(right), KEYS)
        .agg(
            F.count("*").alias("matched"),
            *[F.count_if(test).alias(f"{name}_mismatches") for name, test in differs.items()],
            F.coalesce(F.sum(reduce(add, [t.cast("int") for t in differs.values()])), F.lit(0)).alias("field_discrepancies"),
            F.count_if(reduce(lambda a, b: a | b, differs.values())).alias("records_with_discrepancies"),
        )
    )
    n_visits = visits.agg(F.count("*").alias("n")).scalar()
    n_claims = claims.agg(F.count("*").alias("n")).scalar()
    return stats.select(
        n_visits.alias("visits_total"),
        n_claims.alias("claims_total"),
        "*",
        (F.col("matched") - F.col("records_with_discrepancies")).alias("perfect_matches"),
    ).select(
        "*",
        F.coalesce(pct("matched", "claims_total", 1), F.lit(0.0)).alias("matched_pct_of_claims"),
        F.coalesce(pct("perfect_matches", "matched", 1), F.lit(0.0)).alias("match_quality"),
    )


def visits_only(visits: DataFrame, claims: DataFrame) -> DataFrame:
    """Visits without a claim on the same day, and every visit without an id or a date, with stage and note."""
    left, right = _sides(visits, claims)
    unmatched = left.join(right, KEYS, "left_anti").unionByName(_open_visits(visits).select(*left.columns))
    return _visit_side(unmatched).withColumn("note", F.lit(rules.VISITS_ONLY_NOTE))


def claims_only(visits: DataFrame, claims: DataFrame) -> DataFrame:
    """Claims without a visit on the same day, and every claim of an unknown patient, with note."""
    left, right = _sides(visits, claims)
    columns = [*KEYS, "row_no", "charges", "insurance_payments", "patient_payments", "current_balance"]
    known = right.join(left, KEYS, "left_anti").select(*columns)
    unknown = (
        claims.filter(F.col("patient_id").isNull() | F.col("service_date").isNull())
        .withColumnRenamed("service_date", "dos")
        .select(*columns)
    )
    return known.unionByName(unknown).withColumn("note", F.lit(rules.CLAIMS_ONLY_NOTE))


def expected_match_by_stage(visits: DataFrame, claims: DataFrame) -> DataFrame:
    """Visits without a claim by stage: only closed ones are a concern, open ones may lag."""
    left, right = _sides(visits, claims)
    verdict = (
        F.when(F.col("visit_stage") == "Closed", "concern")
        .when(F.col("visit_stage") == "Open", "possible")
        .otherwise("expected")
    )
    return (
        left.join(right, KEYS, "left_anti")
        .unionByName(_open_visits(visits).select(*left.columns))
        .groupBy("visit_stage")
        .agg(F.count("*").alias("n"))
        .withColumn("outcome", verdict)
    )


def billing_master(visits: DataFrame, claims: DataFrame) -> DataFrame:
    """Every visit key once: compared with its claim where there is one, else with blanks and a note.
    Visits without an id or a date follow one by one, past the join.

    One left join instead of the union of an inner and an anti join over the same two sides.
    """
    left, right = _sides(visits, claims)
    side = _claim_side(right).withColumn("has_claim", F.lit(True))
    joined = _visit_side(left).join(side, KEYS, "left")
    no_claim = _visit_side(_open_visits(visits).select(*left.columns))
    joined = _compared(joined.unionByName(no_claim, allowMissingColumns=True))
    matched = F.col("has_claim").isNotNull()

    def only_matched(name: str) -> Column:
        return F.when(matched, F.col(name)).alias(name)

    return joined.select(
        "patient_id",
        "dos",
        F.col("payer").alias("case_primary_insurance"),
        F.when(matched, "Both").otherwise("Visits Only").alias("source"),
        F.when(matched, "Matched").otherwise("Unmatched in Claims").alias("match_status"),
        "provider",
        "referral_source",
        "facility",
        "visit_billed",
        "claim_charges",
        only_matched("billed_match"),
        "visit_patient_paid",
        "claim_patient_paid",
        only_matched("patient_match"),
        "visit_insurance_paid",
        "claim_insurance_paid",
        only_matched("insurance_match"),
        "visit_total_paid",
        "claim_total_paid",
        only_matched("total_match"),
        F.when(~matched, F.col("visit_stage")).alias("visit_stage"),
        only_matched("discrepancies"),
        F.when(~matched, F.lit(rules.VISITS_ONLY_NOTE)).alias("note"),
    )


def billing_master_summary(master: DataFrame) -> DataFrame:
    """Rows by source and by match status, and rows with discrepancies: (grouping, value, n)."""
    differs = F.col("discrepancies").isNotNull() & (F.col("discrepancies") != "None")
    groups = master.groupBy("source", "match_status").agg(
        F.count("*").alias("n_rows"), F.count_if(differs).alias("n_diff")
    )
    sets = groups.groupingSets([["source"], ["match_status"], []], "source", "match_status").agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_diff"), F.lit(0)).alias("n_diff"),
        F.grouping("source").alias("no_source"),
        F.grouping("match_status").alias("no_status"),
    )
    overall = (F.col("no_source") == 1) & (F.col("no_status") == 1)
    return sets.select(
        F.when(overall, "discrepancies").when(F.col("no_source") == 0, "source").otherwise("match_status").alias("grouping"),
        F.when(overall, "matched records").otherwise(F.coalesce("source", "match_status")).alias("value"),
        F.when(overall, F.col("n_diff")).otherwise(F.col("n_rows")).alias("n"),
    )

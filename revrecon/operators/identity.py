"""Patient identity: master list upkeep, name matching and review decisions.

Names are resolved once per distinct name, not once per claim; the claims then need one lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrecon import rules
from revrecon.functions.money import pct
from revrecon.functions.names import first_last, name_collapsed, name_flipped, name_upper
from revrecon.operators.lookups import lookup, pick_per_key


def _batch_patients(batch: DataFrame) -> DataFrame:
    """Trimmed batch rows with no blank field (a null counts as blank)."""
    fields = ("master_id", "patient_name", "date_of_birth")
    trimmed = batch.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in fields], "row_no")
    for c in fields:
        trimmed = trimmed.filter(F.col(c).isNotNull() & (F.col(c) != ""))
    return trimmed


def new_patients(master: DataFrame, batch: DataFrame) -> DataFrame:
    """First batch row per (name, birth date) that the master does not have."""
    first = pick_per_key(_batch_patients(batch), ["patient_name", "date_of_birth"], ["row_no"], last=False)
    return first.join(master, ["patient_name", "date_of_birth"], "left_anti").select(
        "master_id", "patient_name", "date_of_birth"
    )


def patients_upsert(master: DataFrame, batch: DataFrame) -> DataFrame:
    """The master with the new patients of the batch appended; existing rows never change."""
    return master.select("master_id", "patient_name", "date_of_birth").unionByName(new_patients(master, batch))


def patients_upsert_stats(master: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: new, duplicate in batch, already known, total after the upsert.

    Batch and master are counted per (name, birth date) in one aggregate, instead of a join.
    """
    key = ["patient_name", "date_of_birth"]
    labelled = (
        _batch_patients(batch)
        .select(*key, F.lit(1).alias("in_batch"), F.lit(0).alias("in_master"))
        .unionByName(master.select(*key, F.lit(0).alias("in_batch"), F.lit(1).alias("in_master")))
    )
    per_key = labelled.groupBy(*key).agg(
        F.sum("in_batch").alias("in_batch"), F.sum("in_master").alias("in_master")
    )
    fresh = (F.col("in_batch") > 0) & (F.col("in_master") == 0)
    known = (F.col("in_batch") > 0) & (F.col("in_master") > 0)
    return per_key.agg(
        F.count_if(fresh).alias("new_patients"),
        F.coalesce(F.sum(F.greatest(F.col("in_batch") - 1, F.lit(0))), F.lit(0)).alias("duplicates_in_batch"),
        F.count_if(known).alias("already_known"),
        (F.coalesce(F.sum("in_master"), F.lit(0)) + F.count_if(fresh)).alias("total_patients"),
    )


def patient_names(patients: DataFrame) -> DataFrame:
    """Master (patient_id, patient_name, row_no) -> one id per normalised name; the last entry wins."""
    named = patients.select(
        name_flipped("patient_name").alias("name_norm"), "patient_id", "row_no"
    ).filter(F.col("name_norm") != "")
    return named.groupBy("name_norm").agg(F.max_by("patient_id", "row_no").alias("patient_id"))


def patients_from_visits(names: DataFrame, visits: DataFrame) -> DataFrame:
    """Name -> id list extended by visit patients whose normalised name is not in it; first id wins."""
    seen = visits.select(name_flipped("patient_name").alias("name_norm"), "patient_id", "row_no").filter(
        (F.col("name_norm") != "") & F.col("patient_id").isNotNull()
    )
    first = seen.groupBy("name_norm").agg(F.min_by("patient_id", "row_no").alias("patient_id"))
    return names.unionByName(first.join(names, "name_norm", "left_anti"))


def claims_patient_match(claims: DataFrame, names: DataFrame) -> DataFrame:
    """Claims with patient_id and match_level (exact, first_last, none).

    ``names`` is unique per name_norm. Each distinct claim name asks for itself and for its first
    and last token; the better answer is kept.
    """
    normalized = claims.withColumn("name_norm", F.nullif(name_upper("patient_name"), F.lit("")))
    asked = normalized.select("name_norm").filter(F.col("name_norm").isNotNull()).distinct()
    wanted = asked.select(
        F.col("name_norm").alias("asked"),
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("level"), F.col("name_norm").alias("name_norm")),
                F.struct(F.lit(2).alias("level"), first_last("name_norm").alias("name_norm")),
            )
        ).alias("w"),
    ).select("asked", "w.level", "w.name_norm")
    answers = (
        lookup(wanted, names, ["name_norm"], "inner", spread_by="asked")
        .groupBy(F.col("asked").alias("name_norm"))
        .agg(F.min_by("patient_id", "level").alias("patient_id"), F.min("level").alias("level"))
    )
    return (
        lookup(normalized, answers, ["name_norm"])
        .withColumn(
            "match_level",
            F.when(F.col("level") == 1, "exact").when(F.col("level") == 2, "first_last").otherwise("none"),
        )
        .drop("level", "name_norm")
    )


def name_dob_match(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Claims with match_id: the id for equal (name, dob); CLOSE_MATCH when only the birth date is
    known; else UNMATCHED. ``candidate_count`` is the number of patients with that birth date.

    The candidates are not repeated in every row: :func:`close_match_candidates` has them per birth
    date, which keeps a birth date shared by very many patients linear.
    """
    keyed = claims.withColumn("name_norm", name_collapsed("patient_name"))
    master = patients.select(
        name_collapsed(name_flipped("patient_name")).alias("name_norm"), "dob", "patient_id", "row_no"
    )
    exact = master.groupBy("name_norm", "dob").agg(
        F.max_by("patient_id", "row_no").cast("string").alias("exact_id")
    )
    per_dob = master.groupBy("dob").agg(F.count("*").alias("n"))
    asked = keyed.select("name_norm", "dob").distinct()
    answers = lookup(
        lookup(asked, exact, ["name_norm", "dob"], spread_by="name_norm"), per_dob, ["dob"], spread_by="name_norm"
    )
    status = F.when(F.col("exact_id").isNotNull(), F.col("exact_id")).when(
        F.col("n").isNotNull(), rules.CLOSE_MATCH
    )
    return (
        lookup(keyed, answers, ["name_norm", "dob"])
        .withColumn("match_id", F.coalesce(status, F.lit(rules.UNMATCHED)))
        .withColumn(
            "candidate_count",
            F.when(F.col("match_id") == rules.CLOSE_MATCH, F.col("n")).otherwise(F.lit(0)).cast("long"),
        )
        .drop("exact_id", "n")
    )


def close_match_candidates(matched: DataFrame, patients: DataFrame) -> DataFrame:
    """Master patients whose birth date occurs among the close matches: the review list, per birth date."""
    dobs = matched.filter(F.col("match_id") == rules.CLOSE_MATCH).select("dob").distinct()
    return lookup(patients, dobs, ["dob"], "left_semi").select(
        "dob", name_collapsed(name_flipped("patient_name")).alias("candidate_name"), "patient_name", "patient_id"
    )


def apply_match_decisions(matched: DataFrame, decisions: DataFrame, order_by: str | None = None) -> DataFrame:
    """Close matches overwritten by review decisions (an id or UNMATCHED), keyed by name and birth date.

    Of several decisions for one person the last by ``order_by`` holds; without that column an id goes before UNMATCHED
    and the greatest id before others.
    """
    order = F.col(order_by) if order_by else F.struct(F.col("decision") != "UNMATCHED", "decision")
    last = decisions.groupBy("name_norm", "dob").agg(F.max_by("decision", order).alias("decision"))
    decided = lookup(matched, last, ["name_norm", "dob"])
    return decided.withColumn(
        "match_id",
        F.when(
            (F.col("match_id") == rules.CLOSE_MATCH) & F.col("decision").isNotNull(), F.col("decision")
        ).otherwise(F.col("match_id")),
    ).drop("decision")


def match_stats(matched: DataFrame) -> DataFrame:
    """One row: total, matched, close, unmatched, match rate."""
    counts = matched.agg(
        F.count("*").alias("total"),
        F.count_if(~F.col("match_id").isin(rules.UNMATCHED, rules.CLOSE_MATCH)).alias("matched"),
        F.count_if(F.col("match_id") == rules.CLOSE_MATCH).alias("close_matches"),
        F.count_if(F.col("match_id") == rules.UNMATCHED).alias("unmatched"),
    )
    return counts.withColumn("match_rate", F.coalesce(pct("matched", "total", 1), F.lit(0.0)))


def unmatched_patients(matched: DataFrame, include_close: bool = False) -> DataFrame:
    """Distinct unmatched (name, birth date) with the first source row and the number of rows."""
    wanted = [rules.UNMATCHED, rules.CLOSE_MATCH] if include_close else [rules.UNMATCHED]
    return (
        matched.filter(F.col("match_id").isin(*wanted))
        .groupBy("patient_name", "dob")
        .agg(F.min("row_no").alias("first_row"), F.count("*").alias("n_rows"))
    )


def id_to_name(patients: DataFrame) -> DataFrame:
    """Reverse map id -> normalised name; the last name wins."""
    return patients.groupBy("patient_id").agg(
        F.max_by(name_flipped("patient_name"), F.col("row_no")).alias("patient_name")
    )

"""Rows without a patient id, a date or a listed facility stay in counts and totals, one by one."""

from decimal import Decimal

from helpers import as_dicts, claims, visits
from pyspark.sql import functions as F
from revrecon.functions.labels import facility_from_office
from revrecon.operators import combined, identity, ledger, matching, quality


def office(column):
    return facility_from_office(column, ((("MAIN",), "North Clinic"),))


def _some(spark):
    v = visits(
        spark, {}, {"total_paid": 9}, {"patient_id": "p2"}, {"patient_id": None, "total_paid": 5},
        {"patient_id": None, "total_paid": 7, "visit_stage": "Open"}, {"patient_id": "p3", "dos": None},
    )
    c = claims(spark, {"insurance_payments": 3}, {"patient_id": "p9"}, {"patient_id": None}, {"patient_id": "p8", "service_date": None})
    return v, c


def test_every_visit_is_matched_unmatched_or_a_duplicate(spark):
    v, c = _some(spark)
    status = {r["status"]: r["count"] for r in matching.match_status(v, c).groupBy("status").count().collect()}
    only = as_dicts(matching.visits_only(v, c))
    assert len(only) == status["visits_only"] == 4
    assert v.count() == status["matched"] + len(only) + 1
    assert sorted(r["visit_total_paid"] for r in only) == [0, 0, 5, 7]
    stages = {r["visit_stage"]: r["n"] for r in as_dicts(matching.expected_match_by_stage(v, c))}
    assert stages == {"Closed": 3, "Open": 1}
    master = as_dicts(matching.billing_master(v, c))
    assert len(master) == 5
    assert {r["source"] for r in master if r["patient_id"] is None} == {"Visits Only"}
    assert sum(r["visit_total_paid"] for r in master) == 21


def test_visits_without_an_id_are_not_merged(spark):
    v, c = _some(spark)
    rows = as_dicts(combined.combined_dedup(v, c, office))
    assert sorted(r["total_paid"] for r in rows if r["patient_id"] is None) == [5, 7]
    assert sum(r["total_paid"] for r in rows) == 21
    stats = as_dicts(combined.combined_stats(v, c, office))[0]
    assert (stats["final_records"], stats["final_from_visits"]) == (len(rows), sum(r["source"] == "Visits" for r in rows))
    assert stats["combined_records"] - stats["duplicates_removed"] == stats["final_records"]


def test_totals_hold_facilities_that_are_not_listed(spark):
    rows = [("2025-09-01", "a", 1), ("2025-09-01", "b", 2), ("2025-09-01", None, 4), ("2025-09-02", "b", 8)]
    frame = spark.createDataFrame([(d, f, Decimal(x)) for d, f, x in rows], "txn_date string, facility string, amount decimal(18,2)")
    got = as_dicts(ledger.deposits_daily(frame.withColumn("txn_date", F.to_date("txn_date")), ["a"]))
    assert [(r["a"], r["other"], r["total"]) for r in got] == [(1, 6, 7), (0, 8, 8)]


def test_the_last_decision_holds(spark):
    matched = spark.createDataFrame([("N", None, "CLOSE_MATCH")], "name_norm string, dob date, match_id string")
    matched = matched.withColumn("dob", F.lit("1980-01-01").cast("date")).withColumn("row_no", F.lit(1).cast("long"))
    matched = matched.withColumn("match_id", F.lit(identity.rules.CLOSE_MATCH))
    made = spark.createDataFrame([("N", "7", 1), ("N", "UNMATCHED", 2), ("N", "12", 3)], "name_norm string, decision string, at int")
    made = made.withColumn("dob", F.lit("1980-01-01").cast("date"))
    assert as_dicts(identity.apply_match_decisions(matched, made, "at"))[0]["match_id"] == "12"
    assert as_dicts(identity.apply_match_decisions(matched, made.where("at < 3"), "at"))[0]["match_id"] == "UNMATCHED"
    assert as_dicts(identity.apply_match_decisions(matched, made.where("at < 3")))[0]["match_id"] == "7"


def test_whole_numbers_have_statistics(spark):
    rows = {r["column_name"]: r for r in as_dicts(quality.summary_stats(visits(spark, {}, {}, {}).select("row_no", "last_billed")))}
    assert (rows["row_no"]["n"], rows["row_no"]["mean"], rows["row_no"]["p50"], rows["row_no"]["max_value"]) == (3, 2.0, 2.0, 3.0)

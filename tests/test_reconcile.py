import datetime as dt
from decimal import Decimal

from helpers import as_dicts, claims, visits
from revrecon.operators import actions, combined, commercial, dashboard, deidentify, identity, matching, patient
from revrecon.functions.labels import facility_from_office

AS_OF = "2025-10-01"


def office(column):
    return facility_from_office(column, ((("MAIN",), "North Clinic"),))


def last(spark, *rows):
    return actions.claims_last_by_key(claims(spark, *rows))


def test_last_claim_per_key_wins_and_open_keys_are_out(spark):
    rows = last(
        spark, {"charges": 1}, {"charges": 2}, {"charges": 3, "patient_id": "p2"}, {"patient_id": None}, {"service_date": None}
    ).collect()
    assert {(r.patient_id, r.charges) for r in rows} == {("p1", Decimal(2)), ("p2", Decimal(3))}


def test_a_null_in_the_last_claim_is_kept(spark):
    row = last(spark, {"insurance_payments": 5}, {"insurance_payments": None}).first()
    assert row.insurance_payments is None


def test_needs_attention_edge(spark):
    v = visits(
        spark,
        {"visit_stage": "Review", "dos": "2025-09-17"},  # 14 days
        {"visit_stage": "Review", "dos": "2025-09-16"},  # 15 days
        {"visit_stage": "Review", "dos": None},
        {"visit_stage": "Open", "dos": "2025-01-01"},
    )
    assert [(r["row_no"], r["days_since_dos"]) for r in as_dicts(actions.needs_attention(v, AS_OF))] == [(2, 15)]


def test_outstanding_ar(spark):
    base = {"visit_stage": "Open", "dos": "2025-08-31"}  # 31 days
    v = visits(
        spark, base, {**base, "dos": "2025-09-01"}, {**base, "patient_id": "p2"}, {**base, "patient_id": "p3"},
        {**base, "total_paid": 1}, {**base, "patient_id": None},
    )
    c = last(
        spark,
        {"patient_id": "p2", "service_date": "2025-08-31", "insurance_payments": 7},
        {"patient_id": "p3", "service_date": "2025-08-31"},
    )
    rows = {r["row_no"]: r["claim_match"] for r in as_dicts(actions.outstanding_ar(v, c, AS_OF))}
    assert rows == {1: "No", 4: "Yes", 6: "No"}


def test_posting_and_mismatch(spark):
    v = visits(
        spark,
        {"patient_id": "a", "primary_paid": 100},  # claim 80: conflict
        {"patient_id": "b", "primary_paid": 100},  # claim 0: normal lag
        {"patient_id": "c", "primary_paid": 0},  # claim 80: to post
        {"patient_id": "d", "primary_paid": 80, "patient_paid": 5},  # equal insurance, patient differs
        {"patient_id": "e", "primary_paid": 0, "visit_stage": "No Show"},
        {"patient_id": "f", "primary_paid": 0},  # no claim
    )
    c = last(
        spark,
        *[{"patient_id": p, "insurance_payments": 80, "patient_payments": 6 if p == "d" else 0} for p in "acde"],
        {"patient_id": "b"},
    )
    assert [r["patient_id"] for r in as_dicts(actions.needs_posting(v, c, AS_OF))] == ["c"]
    rows = {r["patient_id"]: (r["insurance_diff"], r["patient_diff"]) for r in as_dicts(actions.mismatched_payments(v, c, AS_OF))}
    assert rows == {"a": (20, 0), "d": (0, -1)}
    flagged = actions.action_flags(v, c, AS_OF)
    over = {(r["section"], r["measure"]): r["value"] for r in as_dicts(actions.reconciliation_overview(flagged, v, claims(spark, {})))}
    assert over["needs_posting", "insurance_to_post"] == 80.0
    assert over["mismatched", "insurance_discrepancy"] == 20.0
    assert over["mismatched", "patient_discrepancy"] == 1.0
    assert over["records", "operational_visits"] == 1.0


def test_match_status_keeps_rows_without_a_key_apart(spark):
    v = visits(spark, {}, {"total_paid": 9}, {"patient_id": "p2"}, {"patient_id": None}, {"patient_id": None})
    c = claims(spark, {}, {"patient_id": "p9"}, {"patient_id": None}, {"patient_id": None})
    rows = as_dicts(matching.match_status(v, c))
    count = {}
    for r in rows:
        count[r["status"]] = count.get(r["status"], 0) + 1
    assert count == {"matched": 1, "visits_only": 3, "claims_only": 3}
    assert [r["visit_row"] for r in rows if r["status"] == "matched"] == [2]


def test_comparison_text_and_master(spark):
    v = visits(spark, {"last_billed": 100, "patient_paid": 1, "total_paid": 1}, {"patient_id": "p2"}, {"patient_id": "p3"})
    c = claims(spark, {"charges": 90, "patient_payments": 1}, {"patient_id": "p2"}, {"patient_id": "p8"})
    rows = {r["patient_id"]: r for r in as_dicts(matching.compare_matched(v, c))}
    assert rows["p1"]["discrepancies"] == "BILLED: visit=$100.00 vs claim=$90.00"
    assert (rows["p1"]["billed_match"], rows["p1"]["total_match"]) == ("NO", "YES")
    assert rows["p2"]["discrepancies"] == "None"
    master = {r["patient_id"]: r for r in as_dicts(matching.billing_master(v, c))}
    assert set(master) == {"p1", "p2", "p3"}
    assert (master["p3"]["source"], master["p3"]["billed_match"], master["p3"]["visit_stage"]) == ("Visits Only", None, "Closed")
    stats = as_dicts(matching.comparison_stats(v, c))[0]
    assert (stats["matched"], stats["field_discrepancies"], stats["perfect_matches"], stats["match_quality"]) == (2, 1, 1, 50.0)
    assert len(matching.billing_master(v, c).columns) == 23
    assert matching.comparison_stats(v.limit(0), c.limit(0)).first()["match_quality"] == 0.0


def test_combined_prefers_higher_payment_then_visits_then_order(spark):
    v = visits(spark, {"total_paid": 5, "last_billed": 1}, {"total_paid": 5, "last_billed": 2}, {"patient_id": "p2", "total_paid": 0})
    c = claims(
        spark, {"patient_payments": 5, "charges": 3}, {"patient_id": "p2", "insurance_payments": 1, "charges": 4}, {"patient_id": None}
    )
    rows = {r["patient_id"]: r for r in as_dicts(combined.combined_dedup(v, c, office))}
    assert (rows["p1"]["charges"], rows["p1"]["source"]) == (1, "Visits")
    assert (rows["p2"]["charges"], rows["p2"]["source"], rows["p2"]["facility"]) == (4, "Claims", "North Clinic")
    stats = as_dicts(combined.combined_stats(v, c, office))[0]
    assert (stats["combined_records"], stats["duplicates_removed"], stats["final_records"], stats["claims_unmatched"]) == (5, 3, 2, 1)


def test_claim_names(spark):
    people = spark.createDataFrame([("p1", "Doe, Jane", 1), ("p2", "Roe, Rob", 2), ("p3", "Roe, Rob", 3)],
                                   "patient_id string, patient_name string, row_no bigint")
    names = identity.patient_names(people)
    c = claims(spark, {"patient_name": "jane doe "}, {"patient_name": "Jane Q Doe"}, {"patient_name": "Rob Roe"},
               {"patient_name": "Nobody"}, {"patient_name": None}).drop("patient_id")
    rows = [(r["patient_id"], r["match_level"]) for r in as_dicts(identity.claims_patient_match(c, names).orderBy("row_no"))]
    assert rows == [("p1", "exact"), ("p1", "first_last"), ("p3", "exact"), (None, "none"), (None, "none")]


def test_review_flow(spark):
    d = dt.date(1980, 1, 1)
    people = spark.createDataFrame([("p1", "Doe, Jane", d, 1), ("p2", "Roe, Rob", d, 2)],
                                   "patient_id string, patient_name string, dob date, row_no bigint")
    c = claims(spark, {"patient_name": "Jane  Doe"}, {"patient_name": "Robert Roe"}, {"patient_name": "R Roe"},
               {"patient_name": "X", "dob": "1999-01-01"}, {"patient_name": "X", "dob": None})
    matched = identity.name_dob_match(c, people)
    rows = [(r["match_id"], r["candidate_count"]) for r in as_dicts(matched.orderBy("row_no"))]
    assert rows == [("p1", 0), ("CLOSE_MATCH", 2), ("CLOSE_MATCH", 2), ("UNMATCHED", 0), ("UNMATCHED", 0)]
    assert {r["patient_id"] for r in as_dicts(identity.close_match_candidates(matched, people))} == {"p1", "p2"}
    decisions = spark.createDataFrame([("ROBERT ROE", d, "p2"), ("JANE DOE", d, "UNMATCHED")],
                                      "name_norm string, dob date, decision string")
    decided = identity.apply_match_decisions(matched, decisions)
    assert [r["match_id"] for r in as_dicts(decided.orderBy("row_no"))] == ["p1", "p2", "CLOSE_MATCH", "UNMATCHED", "UNMATCHED"]
    assert as_dicts(identity.match_stats(decided)) == [
        {"total": 5, "matched": 2, "close_matches": 1, "unmatched": 2, "match_rate": 40.0}]
    assert deidentify.follow_up(decided).count() == 3


def test_patient_upsert(spark):
    ddl = "master_id string, patient_name string, date_of_birth string"
    master = spark.createDataFrame([("m", "Old", "d")], ddl)
    batch = spark.createDataFrame(
        [("1", " New ", "d", 1), ("2", "New", "d", 2), ("3", "Old", "d", 3), (None, "Null", "d", 4), ("5", "", "d", 5)],
        ddl + ", row_no bigint")
    assert {(r["master_id"], r["patient_name"]) for r in as_dicts(identity.patients_upsert(master, batch))} == {("m", "Old"), ("1", "New")}
    assert as_dicts(identity.patients_upsert_stats(master, batch)) == [
        {"new_patients": 1, "duplicates_in_batch": 1, "already_known": 1, "total_patients": 2}]


def test_deidentify_leaves_no_identifying_column(spark):
    df = spark.createDataFrame([("J", "p1", "d", "o", "x", "y", 1)], ["Patient Name (First Last)", "Record_ID", "Patient Birth Date",
                               "Office Key and Practice Name", "Provider Profile", "Service Date", "Charges"])
    clean = deidentify.deidentify(df, "Record_ID")
    assert clean.columns == ["Patient Account Number", "Service Date", "Charges"]
    assert deidentify.phi_leak_check(clean).count() == 0
    assert deidentify.phi_leak_check(df).count() == 3


def test_patient_views(spark):
    v = visits(spark, {"dos": "2025-09-02", "facility": "B"}, {"dos": "2025-09-01", "payer": "First"}, {"dos": "2025-09-05", "facility": "B"},
               {"patient_id": "p2"}, {"dos": None, "payer": "Undated", "facility": None})
    c = claims(spark, {"service_date": "2025-09-01", "first_bill_date": "2025-09-04", "insurance_payments": 3},
               {"service_date": "2025-09-02", "first_bill_date": "2025-08-04"})
    names = spark.createDataFrame([("p1", "JANE DOE")], "patient_id string, patient_name string")
    rows = as_dicts(patient.patient_history(v, c, names, "p1"))
    assert [(str(r["dos"]), r["days_to_first_bill"]) for r in rows] == [
        ("None", None), ("2025-09-01", 3), ("2025-09-02", None), ("2025-09-05", None)]
    head = as_dicts(patient.patient_header(v, "p1"))[0]
    assert (head["payer"], head["facility"], head["visits"]) == ("First", "B", 4)


def test_unbilled_tracker(spark):
    v = visits(spark, {"last_billed": None}, {"last_billed": 0}, {"last_billed": None, "patient_id": "p2"},
               {"last_billed": None, "visit_stage": "No Show"}, {"last_billed": None, "dos": "2025-10-01"})
    unbilled = patient.unbilled_visits(v, "2025-09")
    assert {r["patient_id"] for r in as_dicts(unbilled)} == {"p1", "p2"}
    tracked = v.filter("patient_id = 'p2'")
    rows = as_dicts(patient.append_new_unbilled(tracked, unbilled, "2025-10-02"))
    assert [(r["patient_id"], r["month_label"]) for r in rows] == [("p1", "September 2025")]
    assert as_dicts(patient.unbilled_append_counts(tracked, unbilled)) == [{"added": 1, "skipped": 1}]


def test_commercial_and_dashboard(spark):
    v = visits(spark, {"visit_type": "telecom"}, {"visit_type": "AUTO", "patient_id": "p2"}, {"visit_stage": "Open", "patient_id": "p3"},
               {"patient_id": "p4", "total_paid": 7, "primary_allowed": 10})
    c = last(spark, {"insurance_payments": 30, "adjustments": 50, "current_balance": 20}, {"patient_id": "p4", "insurance_payments": 99})
    over = as_dicts(commercial.commercial_overview(v, c))[0]
    assert (over["visits"], over["matched"], over["unmatched"], over["balance_check"]) == (3, 2, 1, Decimal("21.00"))
    rolled = as_dicts(commercial.commercial_rollups(v, c))
    assert sum(r["visits"] for r in rolled if r["rollup"] == "payer") == 3
    assert [r["balance_flag"] for r in as_dicts(commercial.top_payers(v, c))] == ["Balance Remaining"]
    month = as_dicts(dashboard.monthly_collections(v, c))[0]
    assert (month["total_collected"], month["visit_count"], month["open_count"]) == (Decimal(37), 4, 1)
    assert month["collection_rate"] == 5.38
    ar = actions.outstanding_ar(visits(spark, {"visit_stage": "Open", "dos": "2025-08-02"}, {"visit_stage": "Open", "dos": "2025-08-01"}), c, AS_OF)
    assert {r["bucket"]: r["visits"] for r in as_dicts(dashboard.ar_aging(ar))} == {
        "31-60 days": 1, "61-90 days": 1, "91-120 days": 0, "120+ days": 0}

import datetime as dt
import random
from decimal import Decimal

import pytest
from helpers import as_dicts, visits
from pyspark.sql import functions as F
from revrecon.operators import filters, ledger, metrics, monthly, quality
from revrecon.plans import report

FACILITIES = {"North Clinic": "North"}


def test_group_metrics_drop_null_keys_but_keep_them_in_totals(spark):
    v = visits(spark, {"total_paid": 30}, {"total_paid": 10, "provider": "B", "primary_allowed": 0}, {"total_paid": 60, "provider": None},
               {"patient_id": None})
    rows = {r["provider"]: r for r in as_dicts(metrics.provider_performance(v))}
    assert set(rows) == {"A", "B"}
    assert (rows["A"]["visits"], rows["A"]["pct_of_revenue"], rows["A"]["collection_rate"]) == (1, 30.0, 37.5)
    assert rows["B"]["collection_rate"] is None
    stages = as_dicts(metrics.visit_stage_breakdown(v))
    assert (stages[0]["n"], stages[0]["pct_of_total"]) == (3, 75.0)


def test_executive_summary_and_pipeline_agree(spark):
    v = visits(spark, {"total_paid": 30, "written_off": 5}, {"patient_id": "p2"}, {})
    s = as_dicts(metrics.executive_summary(v))[0]
    assert (s["total_visits"], s["unique_patients"], s["total_billed"], s["total_outstanding"]) == (3, 2, 120, Decimal(85))
    steps = {r["stage"]: r["amount"] for r in as_dicts(metrics.collection_pipeline(v))}
    assert steps["total_outstanding"] == 85.0
    assert steps["billed"] == float(s["total_billed"])
    empty = as_dicts(metrics.executive_summary(v.limit(0)))[0]
    assert (empty["total_visits"], empty["collection_rate"], empty["avg_collection_per_visit"]) == (0, 0.0, 0.0)
    over = as_dicts(metrics.executive_summary(visits(spark, {"total_paid": 99})))[0]
    assert over["total_outstanding"] == 0


def test_red_flags(spark):
    v = visits(spark, {"provider": "A", "total_paid": 0}, {"provider": "B", "total_paid": 40, "written_off": 20},
               {"provider": "C", "primary_allowed": 0, "payer_type": "Self"}, {"provider": "B", "total_paid": 40, "visit_stage": "Not Started"})
    flags = {(r["severity"], r["subject"]) for r in as_dicts(metrics.red_flags(v))}
    assert flags == {("high", "all"), ("medium", "all"), ("medium", "Auto"), ("low", "A")}


def test_all_metrics_from_one_cube(spark):
    v = visits(spark, {"total_paid": 30}, {"provider": "B", "facility": "X", "total_paid": 5}, {"patient_id": "p2", "payer_type": "Self"})
    bundle = report.all_metrics(v, n_providers=1)
    assert as_dicts(bundle.tables["executive_summary"]) == as_dicts(metrics.executive_summary(v))
    assert [r["provider"] for r in as_dicts(bundle.tables["provider_performance"])] == ["A"]
    table = as_dicts(report.report_table(bundle, date_range="all of it"))
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
    assert {r["section"] for r in table} >= {"executive_summary", "red_flags", "facility_comparison"}
    assert {r["date_range"] for r in table} == {"all of it"}
    with pytest.raises(ValueError, match="total_paid"):
        report.all_metrics(v.drop("total_paid"))


def test_rate_over_allowed_only(spark):
    v = visits(spark, {"total_paid": 20}, {"primary_allowed": 0, "total_paid": 50}, {"visit_stage": "No Show", "total_paid": 9})
    kpi = as_dicts(metrics.overview_kpis(v))[0]
    assert (kpi["total_visits"], kpi["collection_rate"]) == (2, 50.0)
    rates = as_dicts(metrics.operational_rates(v))[0]
    assert rates["no_show_rate"] == 33.33


def test_month_views(spark):
    v = visits(spark, {}, {"last_billed": 0}, {"last_billed": None}, {"visit_stage": "In Progress"}, {"visit_stage": "No Show"}, {"dos": "2025-10-01"})
    d = as_dicts(monthly.month_drilldown(v, "2025-09"))[0]
    assert (d["scheduled"], d["checked_in"], d["unaccounted"], d["never_billed"], d["never_billed_pct"]) == (5, 3, 1, 1, 33.3)
    assert as_dicts(monthly.other_stage_counts(v, "2025-09")) == [{"visit_stage": "In Progress", "n": 1}]
    m = {r["month"]: r["unbilled"] for r in as_dicts(monthly.visit_monthly_summary(v))}
    assert m == {"2025-09": 2, "2025-10": 0}
    t = as_dicts(monthly.billing_totals(v, "2025-09"))[0]
    assert (t["billed_count"], t["billed_avg"]) == (1, 100.0)


def test_month_pivot_fills_missing_sides(spark):
    v = visits(spark, {"total_paid": 4}, {"facility": "Other", "total_paid": 6})
    lines = spark.createDataFrame([("North Clinic", "Total for Income", "2025-10", Decimal(7))],
                                  "facility string, line_item string, month string, amount decimal(18,2)")
    rows = {(r["facility"], r["metric"]): r for r in as_dicts(monthly.combined_month_pivot(v, lines, ["2025-09", "2025-10"]))}
    assert rows["COMBINED", "collected"]["2025-09"] == 10
    assert rows["North Clinic", "pl_revenue"]["2025-10"] == 7
    assert rows["North Clinic", "collected"]["2025-10"] == 0


def test_filters(spark):
    v = visits(spark, {"dos": "2025-09-01"}, {"dos": "2025-09-30"}, {"dos": None}, {"dos": "2025-10-01"})
    assert filters.filter_date_range(v, "2025-09-01", "2025-09-30").count() == 2
    assert filters.filter_date_range(v, end="2025-09-30").count() == 2
    assert filters.filter_date_range(v).count() == 4
    assert filters.filter_month(v, "2025-09").count() == 2
    assert [r["row_no"] for r in as_dicts(filters.head_sample(v, 2))] == [1, 2]


def test_validation(spark):
    v = visits(spark, {}, {}, {"patient_id": None}, {"dos": "2031-01-01", "visit_stage": "Odd"}, {"total_paid": 50, "visit_stage": "Open", "dos": "2025-01-01"})
    rows = {(r["check_name"], r["field"], r["measure"]): r for r in as_dicts(quality.validation_summary(v, "2025-10-01"))}
    assert rows["ids", "patient_id", "duplicate_visits"]["value"] == 2.0
    assert rows["dates", "dos", "future_dates"]["severity"] == "warning"
    assert rows["stages", "Odd", "unknown_count"]["value"] == 1.0
    assert rows["rules", "Open visits older than 90 days", "violations"]["severity"] == "error"
    assert rows["overall", "table", "is_valid"]["value"] == 0.0
    clean = {(r["check_name"], r["measure"]): r for r in as_dicts(quality.validation_summary(visits(spark, {"total_paid": 1}), "2025-10-01"))}
    assert clean["overall", "is_valid"]["value"] == 1.0


def test_quartiles_are_exact(spark):
    data = [Decimal(x) for x in ("-5", "0", "0.01", "3", "3", "1000000", "7.25")]
    df = spark.createDataFrame([(x,) for x in data] + [(None,)], "m decimal(18,2)")
    row = as_dicts(quality.exact_quartiles(df, ["m"]))[0]
    assert (row["p25"], row["p50"], row["p75"]) == (pytest.approx(0.005), 3.0, 5.125)
    stats = as_dicts(quality.summary_stats(df))[0]
    assert (stats["null_count"], stats["n"], stats["max_value"]) == (1, 7, 1e6)


def deposits(spark, *rows):
    return spark.createDataFrame(
        [(i, dt.date.fromisoformat(d), Decimal(a), m, c, f) for i, (d, a, m, c, f) in enumerate(rows)],
        "row_no bigint, txn_date date, amount decimal(18,2), memo string, cleared string, facility string")


def test_deposits(spark):
    d = deposits(spark, ("2025-09-01", 5, "card", "Cleared", "North"), ("2025-09-01", 5, "card", "Reconciled", "North"),
                 ("2025-09-01", 5, None, "Cleared", "North"), ("2025-09-01", 5, None, "Late", "North"),
                 ("2025-10-02", 9, "Owner LOAN", "Cleared", "South"))
    clean = ledger.deposits_dedup(d)
    assert sorted(r["cleared"] for r in as_dicts(clean)) == ["Cleared"] * 3
    assert ledger.patient_deposits(clean).count() == 2
    assert as_dicts(ledger.excluded_deposit_stats(clean))[0]["excluded_amount"] == 9
    months = as_dicts(ledger.deposits_monthly(clean, ["North", "South"]))
    assert [(r["month"], r["North"], r["South"], r["total"]) for r in months] == [("2025-09", 10, 0, 10), ("2025-10", 0, 9, 9)]
    assert {r["facility"]: r["n"] for r in as_dicts(ledger.deposit_stats(clean))} == {"ALL": 3, "North": 2, "South": 1}
    assert ledger.deposits_by_facility(clean, "north").count() == 2


@pytest.mark.parametrize(
    ("paid", "banked", "flag"),
    [(10000, 10500, "OK"), (10000, 10500.01, "REVIEW"), (1000, 1050, "OK"), (1000, 1050.5, "REVIEW"), (0, 400, "OK")],
)
def test_deposit_flags_at_the_edge(spark, paid, banked, flag):
    v = visits(spark, {"total_paid": paid})
    d = deposits(spark, ("2025-09-05", str(banked), "card", "Cleared", "North"))
    row = as_dicts(ledger.recon_deposits_monthly(v, d, FACILITIES))[0]
    assert (row["flag"], row["facility"]) == (flag, "North")


def test_ledger_without_visits_is_flagged(spark):
    ddl = "month string, category string, amount decimal(18,2), facility string, is_patient_revenue boolean, type string"
    pl = spark.createDataFrame([("2025-09", "Services", Decimal(10), "North", True, "Income"),
                                ("2025-09", "Other", Decimal(99), "North", False, "Income")], ddl)
    merged = visits(spark, {"dos": "2025-08-01", "total_paid": 10}).selectExpr(
        "patient_id", "dos as service_date", "patient_paid as patient_payments", "primary_paid as insurance_payments", "total_paid", "facility")
    rows = {r["month"]: r for r in as_dicts(ledger.recon_pl_monthly(merged, pl, FACILITIES))}
    assert (rows["2025-09"]["discrepancy_pct"], rows["2025-09"]["flag"]) == (100.0, "REVIEW")
    flags = {r["month"]: r for r in as_dicts(ledger.recon_pl_flags(merged, pl, FACILITIES))}
    assert (flags["2025-08"]["direction"], flags["2025-08"]["severity"]) == ("visits > ledger", "MEDIUM")
    assert len(flags["2025-09"]["possible_causes"]) == 3
    stats = {r["facility"]: r for r in as_dicts(ledger.pl_stats(pl))}
    assert (stats["ALL"]["total_income"], stats["ALL"]["non_patient_revenue"]) == (109, 99)


def test_quartiles_by_selection_against_all_values(spark):
    rng = random.Random(8)
    kinds = {
        "cents": [rng.randint(-500_000, 500_000) / 100 for _ in range(4001)],
        "doubles": [1000 + rng.random() for _ in range(3002)],
        "ties": [rng.choice([0.0, 1.0, 1.0, 5.5]) for _ in range(999)],
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(1500)],
        "tiny": [1.0 + i * 2.0**-52 for i in range(3000)],
        "one": [7.25],
        "with nan": [1.5, float("nan"), -2.0],
        "empty": [],
    }
    longest = max(map(len, kinds.values()))
    rows = [tuple(v[i] if i < len(v) else None for v in kinds.values()) for i in range(longest)]
    df = spark.createDataFrame(rows, ", ".join(f"`{k}.x` double" for k in kinds)).repartition(5)
    got = {r.column_name[:-2]: (r.p25, r.p50, r.p75) for r in quality.exact_quartiles(df, df.columns).collect()}

    def want(numbers):
        numbers, out = sorted(x for x in numbers if x == x), []
        for share in (0.25, 0.5, 0.75):
            at = share * (len(numbers) - 1)
            low = numbers[int(at)]
            high = numbers[min(int(at) + (at > int(at)), len(numbers) - 1)]
            out.append(low if low == high else low + (high - low) * (at - int(at)))
        return tuple(out)

    assert got == {k: want(v) for k, v in kinds.items() if v}
    assert quality.exact_quartiles(df, []).collect() == []


def test_summary_derives_its_table_once(spark):
    """Every pass reads written columns: a table that is dear to derive, or differs from run to run, is derived once."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(20_000).selectExpr("id", "cast(id % 997 as decimal(18,2)) / 7 as m", "if(id % 4 = 0, null, 'x') as `t`")
    stats = {r["column_name"]: r for r in as_dicts(quality.summary_stats(df.mapInArrow(counted, df.schema)))}
    assert seen.value == 20_000
    assert (stats["id"]["p25"], stats["id"]["p50"], stats["t"]["null_count"], stats["t"]["n"]) == (4999.75, 9999.5, 5000, None)


def test_quartiles_shuffle_buckets_only(spark, monkeypatch):
    made = []
    inner = quality._values
    monkeypatch.setattr(quality, "_values", lambda *a: made.append(inner(*a)) or made[-1])
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003 / 100).alias("m"))
    row = quality.exact_quartiles(df, ["m"]).first()
    assert len(made) == 2 and row.p50 is not None
    first, second = (t.count() for t in made)
    assert first < 4000 and second <= 6 * quality._PARTS

"""What the physical plans must and must not contain."""

import pytest
from checks import fixtures as fx
from checks.queries import REGISTRY
from pyspark.sql import functions as F
from revrecon.operators import actions, lookups, metrics, monthly

SF = "/root/testdata/sf0.001"
TINY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "32",
}


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tiny(spark):
    before = {k: spark.conf.get(k, None) for k in TINY}
    for k, v in TINY.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot_visits(spark, n=20000):
    """A third of the visits on one key, a third without a patient."""
    i = F.col("id")
    return spark.range(0, n, 1, 8).select(
        i.alias("row_no"),
        F.when(i % 3 == 0, F.lit(-1)).when(i % 3 == 1, i).alias("patient_id"),
        F.date_add(F.lit("2025-09-01").cast("date"), (i % 1).cast("int")).alias("dos"),
        F.lit("Closed").alias("visit_stage"),
        F.lit(0).cast("decimal(18,2)").alias("total_paid"),
        F.lit(0).cast("decimal(18,2)").alias("primary_paid"),
        F.lit(0).cast("decimal(18,2)").alias("patient_paid"),
        F.lit(1).cast("decimal(18,2)").alias("last_billed"),
    )


def hot_claims(spark, n=20000):
    i = F.col("id")
    return spark.range(0, n, 1, 8).select(
        i.alias("row_no"),
        F.when(i % 2 == 0, F.lit(-1)).otherwise(i).alias("patient_id"),
        F.date_add(F.lit("2025-09-01").cast("date"), (i % 1).cast("int")).alias("service_date"),
        i.cast("decimal(18,2)").alias("insurance_payments"),
        F.lit(0).cast("decimal(18,2)").alias("patient_payments"),
    )


def test_hot_key_is_split_and_results_stay_whole(tiny):
    joined = actions.with_claim(
        hot_visits(tiny), actions.claims_last_by_key(hot_claims(tiny)), ["insurance_payments"]
    ).select("row_no", "patient_id", "claim_insurance_payments")
    rows = joined.collect()
    assert "skew=true" in plan_of(joined)
    assert len(rows) == 20000
    hot = {r.claim_insurance_payments for r in rows if r.patient_id == -1}
    assert hot == {19998}
    assert sum(r.patient_id is None for r in rows) == 6666


def test_last_claim_is_a_partial_hash_aggregate(spark):
    last = actions.claims_last_by_key(hot_claims(spark)).select("patient_id", "dos", "insurance_payments")
    plan = plan_of(last)
    assert "partial_max_by" in plan
    assert "Window" not in plan
    assert "SortAggregate" not in plan


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "visits")
    fx.visits(spark, SF).write.parquet(path)
    v = spark.read.parquet(path)
    plan = plan_of(monthly.month_drilldown(v, "1997-06"))
    assert "GreaterThanOrEqual(dos,1997-06-01)" in plan
    assert "LessThan(dos,1997-07-01)" in plan
    plan = plan_of(metrics.provider_performance(v))
    schema = plan[plan.index("ReadSchema: "):]
    assert "patient_name" not in schema
    assert "last_billed" not in schema
    plan = plan_of(monthly.visits_by_period(v, "ASIA"))
    assert "EqualTo(facility,ASIA)" in plan


def test_full_match_adds_no_exchange_after_the_two_aggregates(tiny):
    from revrecon.operators.matching import match_status

    v, c = hot_visits(tiny), hot_claims(tiny)
    joined = match_status(v, c)
    assert plan_of(joined).count("Exchange hashpartitioning") == 2


def test_lookup_keeps_every_fact(spark):
    facts = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "row_no bigint, k string")
    side = spark.createDataFrame([("a", 10)], "k string, v int")
    rows = {(r.row_no, r.k, r.v) for r in lookups.lookup(facts, side, ["k"]).collect()}
    assert rows == {(1, "a", 10), (2, None, None), (3, "z", None)}


def test_stored_files_cover_separate_dates(tiny, tmp_path):
    from revrecon.plans.layout import store_by_date

    i = F.col("id")
    df = tiny.range(0, 20000, 1, 8).select(
        i.alias("row_no"), F.date_add(F.lit("2025-01-01").cast("date"), (i * 7919 % 365).cast("int")).alias("dos")
    )
    store_by_date(df, str(tmp_path / "t"), "dos")
    ranges = (
        tiny.read.parquet(str(tmp_path / "t")).groupBy("_metadata.file_path")
        .agg(F.min("dos").alias("lo"), F.max("dos").alias("hi"), F.count("*").alias("n")).orderBy("lo", "hi").collect()
    )
    assert len(ranges) > 4
    assert sum(r.n for r in ranges) == 20000
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))


def test_runs_end_to_end(spark, tmp_path):
    from revrecon.plans import reconcile

    v, c, p = fx.visits(spark, SF), fx.claims(spark, SF), fx.patients(spark, SF)
    results = reconcile.billing_reconciliation(spark, v, c, p, "2001-09-01")
    written = reconcile.save_run(results, str(tmp_path), "20010901_000000")
    assert spark.read.parquet(written["needs_posting"]).count() == REGISTRY["needs_posting"](spark, SF).count()
    assert set(reconcile.comparison(spark, v, c, p)) == {"comparison_matched", "visits_only", "claims_only", "billing_master"}
    audit = reconcile.commercial_audit(spark, v, c, p)
    assert audit["commercial_overview"].first()["visits"] == audit["commercial_audit"].count()

"""The end-to-end job: tables written once, bucketed claim-keyed tables join without a shuffle."""

from claimlake.operators import star
from claimlake.plans.job import run
from claimlake.plans.lake import Lake
from claimlake.sources.files import TableConfig, scan_table

from .conftest import SF_SMALL


def test_bucketed_silver_tables_join_without_exchange(spark):
    lk = Lake(spark, SF_SMALL)
    cfg = TableConfig(root="unused", use_catalog=True, buckets=4)
    run(spark, cfg, lk.bronze, lk.as_of, lk.run_ts, stages=("silver",))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fa = star.fact_assessment(scan_table(spark, cfg, "silver", "claim_assessments"),
                                  scan_table(spark, cfg, "silver", "claims"))
        plan = fa._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        assert fa.count() == star.fact_assessment(lk.silver("claim_assessments"), lk.silver("claims")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_quarantine_table_equals_failed_rows(spark):
    lk = Lake(spark, SF_SMALL)
    cfg = TableConfig(root="unused", use_catalog=True, buckets=4)
    run(spark, cfg, lk.bronze, lk.as_of, lk.run_ts, stages=("silver",))
    q = scan_table(spark, cfg, "silver", "quarantine")
    assert q.count() == lk.quarantine.count()
    for entity in ("claims", "claim_assessments"):
        assert scan_table(spark, cfg, "silver", entity).count() == lk.silver(entity).count()


def test_month_filter_prunes_summary_partitions(spark):
    from claimlake.operators import fraud
    from claimlake.session import scratch_path

    lk = Lake(spark, SF_SMALL)
    cfg = TableConfig(scratch_path(spark, "job-test"))
    run(spark, cfg, lk.bronze, lk.as_of, lk.run_ts, stages=("silver", "summary"))
    s = scan_table(spark, cfg, "gold", "summary_fraud_intelligence")
    df = fraud.fraud_where(s, months=("2024-03", "2024-05"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert fraud.fraud_kpis(df).collect()[0]["total_claims"] == \
        fraud.fraud_kpis(fraud.fraud_where(lk.fraud_summary, months=("2024-03", "2024-05"))).collect()[0]["total_claims"]

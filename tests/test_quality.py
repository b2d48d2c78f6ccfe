"""add_dq / quarantine / policies / expectations, and golden counts of the fixture views."""

import json

import pytest
from pyspark.sql import functions as F

from claimlake.operators import quality, silver
from claimlake.plans.lake import Lake

from .conftest import SF_SMALL


def test_add_dq_empty_rule_list_keeps_columns(spark):
    df = spark.createDataFrame([("a", 1.0)], "id string, amount double")
    out = quality.add_dq(df, [])
    assert out.columns == ["id", "amount", "_dq"]
    assert out.collect()[0]["_dq"] is None


def test_add_dq_lists_only_failing_rules(spark):
    df = spark.createDataFrame([("a", -1.0), ("b", 2.0)], "id string, amount double")
    out = quality.add_dq(df, [(F.col("amount") < 0, "neg"), (F.col("id") == "x", "is_x")])
    assert {r["id"]: r["_dq"] for r in out.collect()} == {"a": "neg", "b": None}


def test_quarantine_shape_and_json_round_trip(spark):
    df = spark.createDataFrame([("a", -1.0, "London"), ("b", 2.0, None)], "id string, amount double, region string")
    flagged = quality.add_dq(df, [(F.col("amount") < 0, "neg")])
    q = quality.to_quarantine(flagged, "things", "id", "2026-02-17 06:00:00")
    assert tuple(q.columns) == quality.QUARANTINE_COLUMNS
    rows = q.collect()
    assert [r["record_id"] for r in rows] == ["a"]
    assert json.loads(rows[0]["raw_record"]) == {"id": "a", "amount": -1.0, "region": "London"}


def test_empty_quarantine(spark):
    df = spark.createDataFrame([("a", 1.0)], "id string, amount double")
    assert quality.to_quarantine(quality.add_dq(df, [(F.col("amount") < 0, "neg")]), "t", "id").count() == 0


def test_documented_policy_keeps_soft_only_rows(spark):
    df = spark.createDataFrame([("CLM-1", "POL-1", 10.0, "weird", 0.1), ("BAD-1", "POL-1", 10.0, "minor", 0.1)],
                               "claim_id string, policy_id string, claim_amount_gbp double, "
                               "severity_label string, fraud_risk_score double")
    dq = quality.add_rules(df, silver.RULES["claims"])
    strict_clean, _ = quality.split_by_policy(dq, "strict", silver.RULES["claims"])
    doc_clean, failed = quality.split_by_policy(dq, "documented", silver.RULES["claims"])
    assert strict_clean.count() == 0
    assert [r["claim_id"] for r in doc_clean.collect()] == ["CLM-1"]
    assert failed.count() == 2


def test_expectation_report_counts(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    rep = {r["expectation"]: (r["passed"], r["failed"])
           for r in quality.expectation_report(df, {"x_present": F.col("x").isNotNull()}).collect()}
    assert rep == {"x_present": (2, 1)}


def test_expect_warn_keeps_rows_and_observes(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    out, obs = quality.expect_warn(df, "x_present", F.col("x").isNotNull())
    assert out.count() == 2
    assert obs.get == {"rows": 2, "failed": 1}


GOLDEN_SF0001 = {"policyholders": (137, 13), "vehicles": (178, 22), "policies": (180, 20), "claims": (1374, 126),
                 "incidents": (949, 51), "claim_assessments": (4524, 1476)}


@pytest.mark.parametrize("entity", list(GOLDEN_SF0001))
def test_golden_clean_and_quarantined_counts(spark, entity):
    lk = Lake(spark, SF_SMALL)
    clean, bad = GOLDEN_SF0001[entity]
    assert lk.silver(entity).count() == clean
    assert lk.failed(entity).count() == bad


def test_clean_plus_quarantine_is_total(spark):
    lk = Lake(spark, SF_SMALL)
    for entity in GOLDEN_SF0001:
        assert lk.silver(entity).count() + lk.failed(entity).count() == lk.bronze(entity).count()

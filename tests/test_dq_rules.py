"""Rule-by-rule checks on one-row frames (defaults + override), using the production catalogue."""

import pytest
from pyspark.sql import types as T

from claimlake.operators.quality import add_rules
from claimlake.operators.silver import RULES

CLAIMS = T.StructType([
    T.StructField("claim_id", T.StringType()), T.StructField("policy_id", T.StringType()),
    T.StructField("claim_amount_gbp", T.DoubleType()), T.StructField("severity_label", T.StringType()),
    T.StructField("fraud_risk_score", T.DoubleType())])
POLICYHOLDERS = T.StructType([
    T.StructField("policyholder_id", T.StringType()), T.StructField("age", T.IntegerType()),
    T.StructField("email", T.StringType())])
VEHICLES = T.StructType([
    T.StructField("vehicle_id", T.StringType()), T.StructField("policyholder_id", T.StringType()),
    T.StructField("year", T.IntegerType()), T.StructField("estimated_value", T.DoubleType())])
POLICIES = T.StructType([
    T.StructField("policy_id", T.StringType()), T.StructField("policyholder_id", T.StringType()),
    T.StructField("vehicle_id", T.StringType()), T.StructField("premium_monthly", T.DoubleType()),
    T.StructField("start_date", T.DateType()), T.StructField("end_date", T.DateType())])
INCIDENTS = T.StructType([T.StructField("incident_id", T.StringType()), T.StructField("claim_id", T.StringType())])
ASSESSMENTS = T.StructType([
    T.StructField("assessment_id", T.StringType()), T.StructField("claim_id", T.StringType()),
    T.StructField("estimated_repair_cost_gbp", T.DoubleType()), T.StructField("labour_hours", T.DoubleType())])

import datetime as _dt  # noqa: E402

DEFAULTS = {
    "claims": (CLAIMS, dict(claim_id="CLM-001", policy_id="POL-001", claim_amount_gbp=1000.0,
                            severity_label="moderate", fraud_risk_score=0.3)),
    "policyholders": (POLICYHOLDERS, dict(policyholder_id="PH-001", age=35, email="user@example.com")),
    "vehicles": (VEHICLES, dict(vehicle_id="VH-001", policyholder_id="PH-001", year=2018, estimated_value=12000.0)),
    "policies": (POLICIES, dict(policy_id="POL-001", policyholder_id="PH-001", vehicle_id="VH-001",
                                premium_monthly=85.0, start_date=_dt.date(2024, 1, 1),
                                end_date=_dt.date(2025, 1, 1))),
    "incidents": (INCIDENTS, dict(incident_id="INC-001", claim_id="CLM-001")),
    "claim_assessments": (ASSESSMENTS, dict(assessment_id="ASS-001", claim_id="CLM-001",
                                            estimated_repair_cost_gbp=500.0, labour_hours=3.0)),
}


def dq(spark, entity, **override):
    schema, row = DEFAULTS[entity]
    data = dict(row, **override)
    df = spark.createDataFrame([tuple(data[f.name] for f in schema.fields)], schema)
    return add_rules(df, RULES[entity]).collect()[0]["_dq"]


@pytest.mark.parametrize("entity", list(DEFAULTS))
def test_clean_row_passes(spark, entity):
    assert dq(spark, entity) is None


CASES = [
    ("claims", dict(claim_id="BAD-001"), "invalid_claim_id"),
    ("claims", dict(claim_id=None), "invalid_claim_id"),
    ("claims", dict(policy_id=None), "missing_policy_fk"),
    ("claims", dict(claim_amount_gbp=0.0), "non_positive_claim_amount"),
    ("claims", dict(claim_amount_gbp=-5000.0), "non_positive_claim_amount"),
    ("claims", dict(severity_label="CATASTROPHIC"), "invalid_severity_label"),
    ("claims", dict(fraud_risk_score=2.5), "fraud_score_out_of_range"),
    ("claims", dict(fraud_risk_score=-0.1), "fraud_score_out_of_range"),
    ("policyholders", dict(policyholder_id="X-1"), "invalid_policyholder_id"),
    ("policyholders", dict(age=15), "age_out_of_range"),
    ("policyholders", dict(age=101), "age_out_of_range"),
    ("policyholders", dict(email="invalidemail"), "invalid_email_format"),
    ("vehicles", dict(vehicle_id=None), "invalid_vehicle_id"),
    ("vehicles", dict(policyholder_id=None), "missing_policyholder_fk"),
    ("vehicles", dict(year=1985), "year_out_of_range"),
    ("vehicles", dict(year=2031), "year_out_of_range"),
    ("vehicles", dict(estimated_value=0.0), "non_positive_vehicle_value"),
    ("policies", dict(policy_id="BAD-1"), "invalid_policy_id"),
    ("policies", dict(policyholder_id=None), "missing_policyholder_fk"),
    ("policies", dict(vehicle_id=None), "missing_vehicle_fk"),
    ("policies", dict(premium_monthly=-200.0), "non_positive_premium"),
    ("policies", dict(end_date=_dt.date(2024, 1, 1)), "end_date_before_start_date"),
    ("incidents", dict(incident_id="BAD-1"), "invalid_incident_id"),
    ("incidents", dict(claim_id=None), "missing_claim_fk"),
    ("claim_assessments", dict(assessment_id=None), "invalid_assessment_id"),
    ("claim_assessments", dict(claim_id=None), "missing_claim_fk"),
    ("claim_assessments", dict(estimated_repair_cost_gbp=-3000.0), "non_positive_repair_cost"),
    ("claim_assessments", dict(labour_hours=-5.0), "non_positive_labor_hours"),
]


@pytest.mark.parametrize("entity,override,rule", CASES)
def test_rule_fires(spark, entity, override, rule):
    assert dq(spark, entity, **override) == rule


@pytest.mark.parametrize("entity,override", [
    ("claims", dict(fraud_risk_score=None)),       # NULL score passes (three-valued logic)
    ("claims", dict(severity_label=None)),         # NULL label passes
    ("claims", dict(claim_amount_gbp=None)),       # unparsable amount is NULL, passes
    ("policyholders", dict(email=None)),
    ("policyholders", dict(age=16)),               # boundaries are inclusive
    ("policyholders", dict(age=100)),
    ("policyholders", dict(age=None)),
    ("claims", dict(fraud_risk_score=1.0)),
])
def test_null_and_boundaries_pass(spark, entity, override):
    assert dq(spark, entity, **override) is None


def test_several_violations_in_declaration_order(spark):
    assert dq(spark, "claims", claim_id="BAD-1", claim_amount_gbp=-1.0, fraud_risk_score=2.0) == \
        "invalid_claim_id|non_positive_claim_amount|fraud_score_out_of_range"


def test_catalogue_has_23_rules():
    assert sum(len(v) for v in RULES.values()) == 23

"""Joins with sides whose ids repeat: the rows of the left joins, multiplied after the last shuffle."""

import pytest
from pyspark.sql import functions as F

from claimlake.functions import late
from claimlake.operators import features, star

from .test_fact_order import _fact


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _sides(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", None), (None, 9)], "a string, of_a_col int")
    b = spark.createDataFrame([("p", "u"), ("p", "v"), (None, "w")], "b string, of_b_col string")
    rows = spark.createDataFrame([(1, "x", "p"), (1, "x", "p"), (2, "y", None), (3, None, "p"), (4, "z", "q")], "k int, a string, b string")
    return rows, a, b


def test_rows_of_left_joins(spark):
    rows, a, b = _sides(spark)
    for pack in (1, 2, late.PACK):
        made = rows
        for side, key, column in ((a, "a", "of_a_col"), (b, "b", "of_b_col")):
            made = made.join(late.packed(side, key, {column: column}, pack), key, "left")
        got = late.spread(made, ["a", "b"]).select("k", "a", "b", "of_a_col", "of_b_col")
        want = rows.join(a, "a", "left").join(b, "b", "left").select("k", "a", "b", "of_a_col", "of_b_col")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 16


def test_no_array_is_longer_than_a_pack(spark):
    side = spark.range(0, 1000).select(F.lit("hot").alias("a"), F.col("id").alias("v"))
    sizes = sorted(r[0] for r in late.packed(side, "a", {"v": "v"}).select(F.size("of_a")).collect())
    assert sum(sizes) == 1000 and max(sizes) <= late.PACK


def _multiplied_after_the_last_shuffle(df):
    """In the physical plan, read from the result down, every Generate comes before the first Exchange."""
    lines = [line for line in df._jdf.queryExecution().sparkPlan().toString().splitlines() if "Generate " in line or "Join" in line]
    assert lines and sum("Generate" in line for line in lines) == 3
    return all("Generate" in line for line in lines[:3])


def test_fact_claim_multiplies_last(spark, no_broadcast):
    assert _multiplied_after_the_last_shuffle(_fact(spark))


def test_claim_features_multiply_last(spark, no_broadcast):
    claims = spark.createDataFrame([("C1", "P1", "H1", "V1", "minor", "fire", 10.0, 0.1, True), ("C2", None, "H9", None, "severe", "theft", 20.0, 0.2, False)],
                                   "claim_id string, policy_id string, policyholder_id string, vehicle_id string, severity_label string, "
                                   "claim_type string, claim_amount_gbp double, fraud_risk_score double, is_storm_related boolean")
    policies = spark.createDataFrame([("P1", "Comprehensive", 1.0, 2.0, 3.0), ("P1", "ThirdPartyOnly", 4.0, 5.0, 6.0)],
                                     "policy_id string, policy_type string, excess double, coverage_limit double, premium_monthly double")
    holders = spark.createDataFrame([("H1", 30, 5, 0)], "policyholder_id string, age int, driving_years int, driving_points int")
    vehicles = spark.createDataFrame([("V1", "SUV", 2001, 9.0, 7000), ("V1", "Estate", 2002, 8.0, 5000)],
                                     "vehicle_id string, vehicle_type string, year int, estimated_value double, mileage int")
    incidents = spark.createDataFrame([], "incident_id string, claim_id string, " + ", ".join(f"{c} {t}" for c, t in features.OF_INCIDENT.items()))
    assessed = spark.createDataFrame([], "assessment_id string, claim_id string, assessor_tier string, estimated_repair_cost_gbp double, labour_hours double")
    made = features.claim_features(claims, policies, holders, vehicles, incidents, assessed, incident_mode="first")
    assert _multiplied_after_the_last_shuffle(made)
    got = sorted((r.claim_id, r.f_pol_comprehensive, r.f_pol_tpo, r.f_vtype_suv, r.f_vtype_estate, r.f_excess_gbp, r.f_vehicle_age, r.f_ph_age,
                  r.f_type_fire, r.f_num_assessments) for r in made.collect())
    assert got == [("C1", 0, 1, 0, 1, 4.0, star.REFERENCE_YEAR - 2002, 30, 1, 0), ("C1", 0, 1, 1, 0, 4.0, star.REFERENCE_YEAR - 2001, 30, 1, 0),
                   ("C1", 1, 0, 0, 1, 1.0, star.REFERENCE_YEAR - 2002, 30, 1, 0), ("C1", 1, 0, 1, 0, 1.0, star.REFERENCE_YEAR - 2001, 30, 1, 0),
                   ("C2", 0, 0, 0, 0, None, None, None, 0, 0)]

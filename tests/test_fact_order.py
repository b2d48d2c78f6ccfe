"""fact_claim: repeated policy and vehicle ids multiply rows after the claims are dealt out by holder."""

from claimlake.operators import star

CLAIM = ("claim_id string, policy_id string, policyholder_id string, vehicle_id string, claim_date date, claim_type string, claim_status string, "
         "severity_label string, incident_region string, incident_city string, is_storm_related boolean, fraud_flag boolean, "
         "fraud_risk_score double, claim_amount_gbp double")


def _fact(spark):
    row = lambda c, p, h, v: (c, p, h, v, None, "fire", "open", "minor", "Kent", "City1", False, False, 0.1, 100.0)
    claims = spark.createDataFrame([row("C1", "P1", "H1", "V1"), row("C2", None, "H2", "V9"), row("C3", "P2", None, None)], CLAIM)
    policies = spark.createDataFrame([("P1", "a", "x", 1.0, 2.0, 5.0), ("P1", "b", "x", 1.0, 3.0, 6.0), ("P2", "c", "x", 1.0, 4.0, 7.0), (None, "d", "x", 1.0, 1.0, 1.0)],
                                     "policy_id string, policy_type string, coverage_type string, coverage_limit double, premium_monthly double, excess double")
    holders = spark.createDataFrame([("H1", "Kent", 30, "F", 0), ("H2", "Devon", 40, "M", 3)],
                                    "policyholder_id string, region string, age int, gender string, driving_points int")
    vehicles = spark.createDataFrame([("V1", 2001, 9.0, "m", "suv"), ("V1", 2002, 9.0, "m", "suv")],
                                     "vehicle_id string, year int, estimated_value double, make string, vehicle_type string")
    return star.fact_claim(claims, policies, holders, vehicles)


def test_fact_claim_deals_by_holder_first(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = _fact(spark)
        plan = fact._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line.split("Join ")[1] for line in plan.splitlines() if "Join LeftOuter" in line]
    assert [next(k for k in ("vehicle_id", "policy_id", "policyholder_id") if f"({k}#" in j) for j in joins] == \
        ["vehicle_id", "policy_id", "policyholder_id"]


def test_fact_claim_rows_and_columns(spark):
    fact = _fact(spark)
    assert fact.columns[:4] == ["vehicle_id", "policyholder_id", "policy_id", "claim_id"]
    assert fact.columns[-7:] == ["driving_points", "vehicle_year", "vehicle_value_gbp", "make", "vehicle_type", "net_payout_gbp",
                                 "annual_premium_gbp"]
    got = sorted((r.claim_id, r.policy_type or "", r.vehicle_year or 0, r.age or 0) for r in fact.collect())
    assert got == [("C1", "a", 2001, 30), ("C1", "a", 2002, 30), ("C1", "b", 2001, 30), ("C1", "b", 2002, 30), ("C2", "", 0, 40), ("C3", "c", 0, 0)]

"""Registered queries: star schema, features, summaries and fraud analytics."""

from __future__ import annotations

from ..operators import features, fraud, star, summary
from .oracle_sql import cte
from .registry import q, register

# ── oracle CTEs (gold) ────────────────────────────────────────────────────────
cte("dim_date", """
SELECT d AS date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
  dayofweek(d) IN (0, 6) AS is_weekend,
  d >= DATE '2026-02-03' AND d <= DATE '2026-02-17' AS is_storm_period
FROM (SELECT CAST(DATE '2023-01-01' + CAST(i AS INTEGER) AS DATE) AS d FROM range(0, 1825) t(i))""")

cte("fact_claim", """
SELECT c.claim_id, c.policy_id, c.policyholder_id, c.vehicle_id, c.claim_date,
  CAST(strftime(c.claim_date, '%Y%m%d') AS INTEGER) AS claim_date_key,
  c.claim_type, c.incident_region, c.incident_city, c.claim_status, c.severity_label,
  c.is_storm_related, c.fraud_flag, c.fraud_risk_score, c.claim_amount_gbp AS claimed_amount_gbp, p.excess,
  greatest(c.claim_amount_gbp - p.excess, 0.0) AS net_payout_gbp,
  p.policy_type, p.coverage_type, p.premium_monthly, p.premium_monthly * 12 AS annual_premium_gbp,
  p.coverage_limit, h.age, h.gender, h.region AS ph_region, h.driving_points,
  v.make, v.vehicle_type, v.year AS vehicle_year, v.estimated_value AS vehicle_value_gbp
FROM s_claims c
LEFT JOIN s_policies p ON c.policy_id = p.policy_id
LEFT JOIN s_policyholders h ON c.policyholder_id = h.policyholder_id
LEFT JOIN s_vehicles v ON c.vehicle_id = v.vehicle_id""", "s_claims", "s_policies", "s_policyholders", "s_vehicles")

cte("assessment_agg", """
SELECT claim_id, COUNT(assessment_id) AS num_assessments, AVG(estimated_repair_cost_gbp) AS avg_repair_cost_gbp,
  MAX(estimated_repair_cost_gbp) AS max_repair_cost_gbp, SUM(labour_hours) AS total_labour_hours,
  COUNT(DISTINCT assessor_tier) AS distinct_assessor_tiers
FROM s_claim_assessments GROUP BY claim_id""", "s_claim_assessments")


def _oh(col: str, *vals: str) -> str:
    vs = ", ".join(f"'{v}'" for v in vals)
    return f"CASE WHEN {col} IN ({vs}) THEN 1 ELSE 0 END"


def _claim_features_sql(inc: str) -> str:
    return f"""
SELECT c.claim_id,
  CAST(CASE c.severity_label WHEN 'minor' THEN 0 WHEN 'moderate' THEN 1 WHEN 'severe' THEN 2
       WHEN 'total_loss' THEN 3 END AS INTEGER) AS severity_encoded,
  c.severity_label,
  {_oh('c.claim_type', 'weather')} AS f_type_weather, {_oh('c.claim_type', 'collision')} AS f_type_collision,
  {_oh('c.claim_type', 'theft')} AS f_type_theft, {_oh('c.claim_type', 'vandalism')} AS f_type_vandalism,
  {_oh('c.claim_type', 'fire')} AS f_type_fire,
  c.claim_amount_gbp AS f_claim_amount_gbp, c.fraud_risk_score AS f_fraud_risk_score,
  CASE WHEN c.is_storm_related THEN 1 ELSE 0 END AS f_is_storm,
  p.excess AS f_excess_gbp, p.coverage_limit AS f_coverage_limit_gbp, p.premium_monthly AS f_premium_monthly_gbp,
  {_oh('p.policy_type', 'Comprehensive')} AS f_pol_comprehensive,
  {_oh('p.policy_type', 'ThirdPartyFireTheft')} AS f_pol_tpft,
  {_oh('p.policy_type', 'ThirdPartyOnly')} AS f_pol_tpo,
  h.age AS f_ph_age, h.driving_years AS f_driving_years, h.driving_points AS f_driving_points,
  2026 - v.year AS f_vehicle_age, v.estimated_value AS f_vehicle_value_gbp, v.mileage / 1000.0 AS f_mileage_k,
  {_oh('v.vehicle_type', 'SUV', 'Crossover')} AS f_vtype_suv, {_oh('v.vehicle_type', 'Estate')} AS f_vtype_estate,
  {_oh('i.weather_condition', 'flood')} AS f_weather_flood, {_oh('i.weather_condition', 'heavy_rain')} AS f_weather_rain,
  {_oh('i.weather_condition', 'strong_wind')} AS f_weather_wind, {_oh('i.weather_condition', 'clear')} AS f_weather_clear,
  {_oh('i.road_condition', 'flooded')} AS f_road_flooded, {_oh('i.road_condition', 'icy')} AS f_road_icy,
  {_oh('i.visibility', 'poor')} AS f_visibility_poor,
  i.num_vehicles_involved AS f_num_vehicles, i.witness_count AS f_witness_count,
  {_oh('i.police_report_filed', 'Y')} AS f_police_report,
  coalesce(a.num_assessments, 0) AS f_num_assessments, coalesce(a.avg_repair_cost_gbp, 0.0) AS f_avg_repair_cost_gbp,
  coalesce(a.max_repair_cost_gbp, 0.0) AS f_max_repair_cost_gbp, coalesce(a.total_labour_hours, 0.0) AS f_total_labour_hours
FROM s_claims c
LEFT JOIN s_policies p ON c.policy_id = p.policy_id
LEFT JOIN s_policyholders h ON c.policyholder_id = h.policyholder_id
LEFT JOIN s_vehicles v ON c.vehicle_id = v.vehicle_id
LEFT JOIN {inc} i ON c.claim_id = i.claim_id
LEFT JOIN assessment_agg a ON c.claim_id = a.claim_id"""


_CF_DEPS = ("s_claims", "s_policies", "s_policyholders", "s_vehicles", "assessment_agg")
cte("claim_features", _claim_features_sql("s_incidents"), *_CF_DEPS, "s_incidents")
cte("first_incident", """
SELECT claim_id, arg_min(weather_condition, incident_id) AS weather_condition,
  arg_min(road_condition, incident_id) AS road_condition, arg_min(visibility, incident_id) AS visibility,
  arg_min(num_vehicles_involved, incident_id) AS num_vehicles_involved,
  arg_min(witness_count, incident_id) AS witness_count, arg_min(police_report_filed, incident_id) AS police_report_filed
FROM s_incidents GROUP BY claim_id""", "s_incidents")
cte("claim_features_first", _claim_features_sql("first_incident"), *_CF_DEPS, "first_incident")

cte("claim_history_agg", """
SELECT policyholder_id, COUNT(claim_id) AS total_claims,
  CAST(SUM(CASE WHEN is_storm_related THEN 1 ELSE 0 END) AS BIGINT) AS storm_claims,
  AVG(claim_amount_gbp) AS avg_claim_amount_gbp, MAX(claim_amount_gbp) AS max_claim_amount_gbp,
  AVG(fraud_risk_score) AS avg_fraud_score, MAX(fraud_risk_score) AS max_fraud_score,
  CAST(SUM(CASE WHEN fraud_flag THEN 1 ELSE 0 END) AS BIGINT) AS flagged_claims,
  CAST(SUM(CASE WHEN severity_label = 'total_loss' THEN 1 ELSE 0 END) AS BIGINT) AS total_loss_claims,
  CAST(SUM(CASE WHEN severity_label = 'severe' THEN 1 ELSE 0 END) AS BIGINT) AS severe_claims
FROM s_claims GROUP BY policyholder_id""", "s_claims")

cte("policy_agg", """
SELECT policyholder_id, COUNT(policy_id) AS total_policies, AVG(premium_monthly) AS avg_premium_monthly_gbp
FROM s_policies GROUP BY policyholder_id""", "s_policies")

cte("policyholder_risk_profile", """
SELECT *, CASE WHEN risk_score < 0.2 THEN 'low' WHEN risk_score < 0.5 THEN 'medium'
               WHEN risk_score < 0.7 THEN 'high' ELSE 'very_high' END AS risk_tier
FROM (SELECT *, least(1.0, driving_points / 12.0 * 0.2 + claim_frequency * 0.3 + avg_fraud_score * 0.4
                           + total_loss_claims * 0.1) AS risk_score
  FROM (SELECT *, total_claims / greatest(driving_years, 1) AS claim_frequency
    FROM (SELECT h.policyholder_id, h.age, h.gender, h.region, h.driving_years, h.driving_points,
            coalesce(c.total_claims, 0) AS total_claims, c.storm_claims,
            coalesce(c.avg_claim_amount_gbp, 0.0) AS avg_claim_amount_gbp, c.max_claim_amount_gbp,
            coalesce(c.avg_fraud_score, 0.0) AS avg_fraud_score, c.max_fraud_score,
            coalesce(c.flagged_claims, 0) AS flagged_claims, coalesce(c.total_loss_claims, 0) AS total_loss_claims,
            c.severe_claims, coalesce(p.total_policies, 0) AS total_policies, p.avg_premium_monthly_gbp
          FROM s_policyholders h
          LEFT JOIN claim_history_agg c ON h.policyholder_id = c.policyholder_id
          LEFT JOIN policy_agg p ON h.policyholder_id = p.policyholder_id)))""",
    "s_policyholders", "claim_history_agg", "policy_agg")

cte("fraud_summary", """
SELECT strftime(claim_date, '%Y-%m') AS month, incident_region, claim_type, is_storm_related,
  COUNT(claim_id) AS total_claims,
  CAST(SUM(CASE WHEN fraud_flag THEN 1 ELSE 0 END) AS BIGINT) AS flagged_claims,
  AVG(fraud_risk_score) AS avg_fraud_score, MAX(fraud_risk_score) AS max_fraud_score,
  SUM(CASE WHEN fraud_flag THEN claim_amount_gbp ELSE 0 END) AS flagged_claims_gbp,
  SUM(claim_amount_gbp) AS total_claims_gbp
FROM s_claims GROUP BY ALL""", "s_claims")

# ── 2.4 star schema ───────────────────────────────────────────────────────────
register(
    "dim_geography",
    lambda lk: star.dim_geography(lk.silver("claims"), lk.silver("policyholders")),
    q("""
SELECT incident_region, incident_city,
  incident_region IN ('West Yorkshire', 'South Yorkshire', 'Somerset', 'Greater Manchester', 'Devon') AS is_storm_region,
  CASE WHEN incident_region IN ('Greater London') THEN 'London'
       WHEN incident_region IN ('West Yorkshire', 'South Yorkshire', 'North Yorkshire') THEN 'Yorkshire'
       WHEN incident_region IN ('West Midlands', 'Nottinghamshire') THEN 'Midlands'
       WHEN incident_region IN ('Greater Manchester', 'Merseyside', 'Lancashire') THEN 'North West'
       WHEN incident_region IN ('Tyne and Wear') THEN 'North East'
       WHEN incident_region IN ('Somerset', 'Devon', 'Bristol') THEN 'South West'
       WHEN incident_region IN ('Hampshire', 'Kent', 'Essex') THEN 'South East' ELSE 'Other' END AS uk_area,
  concat_ws('-', incident_region, incident_city) AS geo_key
FROM (SELECT incident_region, incident_city FROM s_claims
      UNION SELECT region, city FROM s_policyholders)""", "s_claims", "s_policyholders"),
)

register(
    "dim_policyholder",
    lambda lk: star.dim_policyholder(lk.silver("policyholders")),
    q("""
SELECT policyholder_id, first_name, last_name, gender, age, region, city, postcode, driving_years, driving_points,
  CASE WHEN age < 25 THEN '17-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
       WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END AS age_band,
  CASE WHEN driving_points = 0 THEN 'low' WHEN driving_points <= 6 THEN 'medium' ELSE 'high' END AS risk_tier
FROM s_policyholders""", "s_policyholders"),
)

register(
    "dim_vehicle",
    lambda lk: star.dim_vehicle(lk.silver("vehicles")),
    q("""
SELECT vehicle_id, policyholder_id, make, vehicle_type, year, colour, estimated_value, mileage,
  2026 - year AS vehicle_age,
  CASE WHEN 2026 - year <= 3 THEN '0-3 years' WHEN 2026 - year <= 7 THEN '4-7 years'
       WHEN 2026 - year <= 12 THEN '8-12 years' ELSE '13+ years' END AS vehicle_age_band,
  CASE WHEN estimated_value < 8000 THEN '<£8K' WHEN estimated_value < 20000 THEN '£8K-£20K'
       WHEN estimated_value < 40000 THEN '£20K-£40K' ELSE '£40K+' END AS value_band_gbp
FROM s_vehicles""", "s_vehicles"),
)

register(
    "dim_policy",
    lambda lk: star.dim_policy(lk.silver("policies")),
    q("""
SELECT policy_id, policyholder_id, vehicle_id, policy_type, coverage_type, status, premium_monthly, excess,
  coverage_limit, start_date, end_date, round(premium_monthly * 12, 2) AS annual_premium_gbp,
  CAST(date_diff('day', start_date, end_date) AS INTEGER) AS policy_duration_days,
  CASE WHEN premium_monthly < 60 THEN '<£60/mo' WHEN premium_monthly < 100 THEN '£60-£100/mo'
       WHEN premium_monthly < 200 THEN '£100-£200/mo' ELSE '£200+/mo' END AS premium_band
FROM s_policies""", "s_policies"),
)

register("fact_claim", lambda lk: lk.fact_claim, q("SELECT * FROM fact_claim", "fact_claim"))

register(
    "fact_assessment",
    lambda lk: star.fact_assessment(lk.silver("claim_assessments"), lk.silver("claims")),
    q("""
SELECT a.assessment_id, a.claim_id, a.assessor_id, a.assessor_tier, a.assessment_date,
  CAST(strftime(a.assessment_date, '%Y%m%d') AS INTEGER) AS assessment_date_key,
  a.damage_category, a.recommended_action, a.estimated_repair_cost_gbp, a.labour_hours, a.parts_cost_gbp,
  a.total_assessment_cost_gbp, c.claim_type, c.severity_label, c.is_storm_related, c.incident_region, c.claim_date,
  CAST(date_diff('day', c.claim_date, a.assessment_date) AS INTEGER) AS days_to_assessment
FROM s_claim_assessments a LEFT JOIN s_claims c ON a.claim_id = c.claim_id""",
      "s_claim_assessments", "s_claims"),
)

register(
    "dim_date",
    lambda lk: star.claims_by_calendar(lk.fact_claim, star.dim_date(lk.spark)),
    q("""
SELECT d.year, d.quarter, d.day_name, d.is_weekend, d.is_storm_period, COUNT(*) AS claims,
  SUM(f.claimed_amount_gbp) AS claimed_gbp, SUM(f.net_payout_gbp) AS net_payout_gbp
FROM fact_claim f JOIN dim_date d ON f.claim_date_key = d.date_key GROUP BY ALL""", "fact_claim", "dim_date"),
    rounded=("claimed_gbp", "net_payout_gbp"),
)

# ── 2.5 features and summaries ────────────────────────────────────────────────
register(
    "assessment_agg",
    lambda lk: features.assessment_agg(lk.silver("claim_assessments")),
    q("SELECT * FROM assessment_agg", "assessment_agg"),
    rounded=("avg_repair_cost_gbp", "total_labour_hours"),
)
register(
    "claim_features",
    lambda lk: lk.claim_features,
    q("SELECT * FROM claim_features", "claim_features"),
    rounded=("f_avg_repair_cost_gbp", "f_total_labour_hours"),
)
register(
    "claim_features_first_incident",
    lambda lk: features.claim_features(
        lk.silver("claims"), lk.silver("policies"), lk.silver("policyholders"), lk.silver("vehicles"),
        lk.silver("incidents"), lk.silver("claim_assessments"), incident_mode="first"),
    q("SELECT * FROM claim_features_first", "claim_features_first"),
    rounded=("f_avg_repair_cost_gbp", "f_total_labour_hours"),
)
register(
    "claim_history_agg",
    lambda lk: features.claim_history_agg(lk.silver("claims")),
    q("SELECT * FROM claim_history_agg", "claim_history_agg"),
    rounded=("avg_claim_amount_gbp", "avg_fraud_score"),
)
register(
    "policy_agg",
    lambda lk: features.policy_agg(lk.silver("policies")),
    q("SELECT * FROM policy_agg", "policy_agg"),
    rounded=("avg_premium_monthly_gbp",),
)
register(
    "policyholder_risk_profile",
    lambda lk: features.policyholder_risk_profile(lk.silver("policyholders"), lk.silver("claims"),
                                                  lk.silver("policies")),
    q("SELECT * FROM policyholder_risk_profile", "policyholder_risk_profile"),
    rounded=("avg_claim_amount_gbp", "avg_fraud_score", "avg_premium_monthly_gbp", "risk_score"),
)
register(
    "summary_claims_daily",
    lambda lk: summary.summary_claims_daily(lk.silver("claims")),
    q("""
SELECT claim_date, incident_region, claim_type, severity_label, is_storm_related,
  COUNT(claim_id) AS claim_count, SUM(claim_amount_gbp) AS total_claimed_gbp, AVG(claim_amount_gbp) AS avg_claimed_gbp,
  MAX(claim_amount_gbp) AS max_claimed_gbp,
  SUM(CASE WHEN claim_status = 'approved' THEN claim_amount_gbp ELSE 0 END) AS approved_amount_gbp,
  CAST(SUM(CASE WHEN claim_status = 'denied' THEN 1 ELSE 0 END) AS BIGINT) AS denied_count,
  SUM(CASE WHEN claim_status = 'settled' THEN claim_amount_gbp ELSE 0 END) AS settled_amount_gbp,
  CAST(SUM(CASE WHEN claim_status = 'open' THEN 1 ELSE 0 END) AS BIGINT) AS open_count,
  CAST(SUM(CASE WHEN severity_label = 'total_loss' THEN 1 ELSE 0 END) AS BIGINT) AS total_loss_count,
  strftime(claim_date, '%Y-%m') AS month, date_trunc('week', claim_date) AS week_start
FROM s_claims GROUP BY claim_date, incident_region, claim_type, severity_label, is_storm_related""", "s_claims"),
    rounded=("total_claimed_gbp", "avg_claimed_gbp", "approved_amount_gbp", "settled_amount_gbp"),
)
register(
    "summary_financial_kpis",
    lambda lk: summary.summary_financial_kpis(lk.silver("claims"), lk.silver("policies")),
    q("""
SELECT *, round(total_net_payout_gbp / greatest(total_monthly_premium_gbp, 0.01), 4) AS loss_ratio FROM (
SELECT strftime(c.claim_date, '%Y-%m') AS month, p.policy_type, c.incident_region,
  COUNT(c.claim_id) AS total_claims, SUM(c.claim_amount_gbp) AS total_claims_gbp,
  SUM(greatest(c.claim_amount_gbp - p.excess, 0.0)) AS total_net_payout_gbp, AVG(c.claim_amount_gbp) AS avg_claim_gbp,
  SUM(p.premium_monthly) AS total_monthly_premium_gbp,
  SUM(CASE WHEN c.severity_label = 'total_loss' THEN c.claim_amount_gbp ELSE 0 END) AS total_loss_gbp,
  SUM(CASE WHEN c.is_storm_related THEN c.claim_amount_gbp ELSE 0 END) AS storm_claims_gbp,
  COUNT(DISTINCT c.policyholder_id) AS unique_claimants
FROM s_claims c LEFT JOIN s_policies p ON c.policy_id = p.policy_id GROUP BY 1, 2, 3)""", "s_claims", "s_policies"),
    rounded=("total_claims_gbp", "total_net_payout_gbp", "avg_claim_gbp", "total_monthly_premium_gbp",
             "total_loss_gbp", "storm_claims_gbp"),
)
register(
    "summary_fraud_intelligence",
    lambda lk: lk.fraud_summary,
    q("""
SELECT *, round(flagged_claims / greatest(total_claims, 1), 4) AS fraud_rate,
  round(flagged_claims_gbp / greatest(total_claims_gbp, 0.01), 4) AS fraud_amount_ratio
FROM fraud_summary""", "fraud_summary"),
    rounded=("avg_fraud_score", "flagged_claims_gbp", "total_claims_gbp"),
)
register(
    "summary_triage_performance",
    lambda lk: summary.summary_triage_performance(lk.silver("claim_assessments"), lk.silver("claims")),
    q("""
SELECT strftime(c.claim_date, '%Y-%m') AS month, a.assessor_tier, a.damage_category, a.recommended_action,
  c.severity_label, c.is_storm_related,
  COUNT(a.assessment_id) AS total_assessments,
  AVG(date_diff('day', c.claim_date, a.assessment_date)) AS avg_days_to_assess,
  CAST(MAX(date_diff('day', c.claim_date, a.assessment_date)) AS INTEGER) AS max_days_to_assess,
  AVG(a.estimated_repair_cost_gbp) AS avg_repair_cost_gbp, SUM(a.total_assessment_cost_gbp) AS total_repair_cost_gbp,
  AVG(a.labour_hours) AS avg_labour_hours, COUNT(DISTINCT a.claim_id) AS unique_claims_assessed,
  AVG(CASE WHEN c.severity_label = 'total_loss' AND a.recommended_action = 'write_off' THEN 1.0
           WHEN c.severity_label = 'severe' AND a.recommended_action IN ('repair', 'replace') THEN 1.0
           WHEN c.severity_label = 'minor' AND a.recommended_action = 'repair' THEN 1.0 ELSE 0.0 END)
    AS severity_action_alignment_rate
FROM s_claim_assessments a LEFT JOIN s_claims c ON a.claim_id = c.claim_id GROUP BY 1, 2, 3, 4, 5, 6""",
      "s_claim_assessments", "s_claims"),
    rounded=("avg_days_to_assess", "avg_repair_cost_gbp", "total_repair_cost_gbp", "avg_labour_hours",
             "severity_action_alignment_rate"),
)

# ── 2.6 fraud analytics ───────────────────────────────────────────────────────
_RATE = "round(SUM(flagged_claims) / NULLIF(SUM(total_claims), 0) * 100, 2) AS fraud_rate_pct"
_RATIO = "round(SUM(flagged_claims_gbp) / NULLIF(SUM(total_claims_gbp), 0) * 100, 2) AS fraud_amount_ratio_pct"
_AMOUNT = "round(SUM(flagged_claims_gbp), 0) AS fraud_amount_gbp"
_SCORE = "round(AVG(avg_fraud_score), 3) AS avg_fraud_score"
_TOT = "CAST(SUM(total_claims) AS BIGINT) AS total_claims, CAST(SUM(flagged_claims) AS BIGINT) AS flagged_claims"

register("fraud_kpis", lambda lk: fraud.fraud_kpis(lk.fraud_summary),
         q(f"SELECT {_TOT}, {_RATE}, {_AMOUNT}, {_RATIO}, {_SCORE} FROM fraud_summary", "fraud_summary"))
register("fraud_by_region", lambda lk: fraud.fraud_by_region(lk.fraud_summary),
         q(f"SELECT incident_region, {_TOT}, {_RATE}, {_AMOUNT} FROM fraud_summary GROUP BY incident_region",
           "fraud_summary"))
register("fraud_storm_vs_baseline", lambda lk: fraud.fraud_storm_vs_baseline(lk.fraud_summary),
         q(f"""SELECT CASE WHEN is_storm_related THEN 'Storm Freya' ELSE 'Baseline' END AS period_type,
  {_RATE}, {_RATIO}, {_TOT} FROM fraud_summary GROUP BY is_storm_related""", "fraud_summary"))
register("fraud_trend", lambda lk: fraud.fraud_trend(lk.fraud_summary),
         q(f"SELECT month, claim_type, {_RATE}, {_TOT} FROM fraud_summary GROUP BY month, claim_type",
           "fraud_summary"))
register("fraud_by_type", lambda lk: fraud.fraud_by_type(lk.fraud_summary),
         q(f"SELECT claim_type, {_TOT}, {_RATE}, {_SCORE}, {_AMOUNT} FROM fraud_summary GROUP BY claim_type",
           "fraud_summary"))
register("fraud_rate_vs_amount", lambda lk: fraud.fraud_rate_vs_amount(lk.fraud_summary),
         q(f"""SELECT incident_region, {_RATE}, {_RATIO}, CAST(SUM(total_claims) AS BIGINT) AS total_claims, {_AMOUNT}
FROM fraud_summary GROUP BY incident_region""", "fraud_summary"))
register("fraud_heatmap_long", lambda lk: fraud.fraud_heatmap_long(lk.fraud_summary),
         q(f"SELECT incident_region, claim_type, {_RATE} FROM fraud_summary GROUP BY incident_region, claim_type",
           "fraud_summary"))
register("fraud_heatmap", lambda lk: fraud.fraud_heatmap(lk.fraud_summary),
         q("SELECT incident_region, " + ", ".join(
             f"round(AVG(CASE WHEN claim_type = '{t}' THEN fraud_rate_pct END), 1) AS {t}"
             for t in fraud.CLAIM_TYPES)
           + f" FROM (SELECT incident_region, claim_type, {_RATE} FROM fraud_summary GROUP BY 1, 2) "
             "GROUP BY incident_region", "fraud_summary"))
register("fraud_detail", lambda lk: fraud.fraud_detail(lk.fraud_summary),
         q(f"""SELECT month, incident_region AS region, claim_type, CASE WHEN is_storm_related THEN 'Yes' ELSE 'No' END AS storm,
  {_TOT}, {_RATE}, {_SCORE}, {_AMOUNT}, {_RATIO}
FROM fraud_summary GROUP BY month, incident_region, claim_type, is_storm_related""", "fraud_summary"))
register("fraud_filter_values", lambda lk: fraud.fraud_filter_values(lk.fraud_summary),
         q("""SELECT DISTINCT 'month' AS kind, month AS value FROM fraud_summary WHERE month IS NOT NULL
UNION SELECT DISTINCT 'region', incident_region FROM fraud_summary WHERE incident_region IS NOT NULL
UNION SELECT DISTINCT 'claim_type', claim_type FROM fraud_summary WHERE claim_type IS NOT NULL""", "fraud_summary"))

_FRAUD_FILTER = dict(months=("2024-03", "2025-06"), regions=("Greater London", "Devon", "Kent", "Essex"),
                     claim_types=("weather", "theft"), storm="storm")
register("fraud_where",
         lambda lk: fraud.fraud_kpis(fraud.fraud_where(lk.fraud_summary, **_FRAUD_FILTER)),
         q(f"""SELECT {_TOT}, {_RATE}, {_AMOUNT}, {_RATIO}, {_SCORE} FROM fraud_summary
WHERE month BETWEEN '2024-03' AND '2025-06' AND incident_region IN ('Greater London', 'Devon', 'Kent', 'Essex')
  AND claim_type IN ('weather', 'theft') AND is_storm_related = TRUE""", "fraud_summary"))

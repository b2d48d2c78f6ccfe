"""Registered queries: silver conformance and the data-quality framework."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dq_reports, quality, silver
from ..sources import files
from ..sources.fixtures import BRONZE_ENTITIES
from .lake import Lake
from .oracle_sql import ENTITY_IDS, RUN_TS, cte
from .registry import q, register

QUARANTINE_CMP = ("source_table", "record_id", "dq_rule_violated", "quarantined_at")

# ── 2.2 silver ────────────────────────────────────────────────────────────────
_DQ_KEYS = {
    "policyholders": "silver_policyholders_dq", "vehicles": "silver_vehicles_dq",
    "policies": "silver_policies_dq", "claims": "silver_claims_dq",
    "incidents": "silver_incidents_dq", "claim_assessments": "silver_assessments_dq",
}
for _e, _k in _DQ_KEYS.items():
    register(_k, lambda lk, e=_e: lk.dq(e), q(f"SELECT * FROM dq_{_e}", f"dq_{_e}"))
    register(f"silver_{_e}", lambda lk, e=_e: lk.silver(e), q(f"SELECT * FROM s_{_e}", f"s_{_e}"))

register(
    "drop_audit_cols",
    lambda lk: silver.drop_audit_cols(
        lk.bronze("incidents").withColumns({
            "_ingested_at": F.lit(None).cast("timestamp"), "_source_file": F.lit("landing/incidents.csv"),
            "_rescued_data": F.lit(None).cast("string")})),
    q("SELECT * FROM fx_incidents", "fx_incidents"),
)

register(
    "stringify_all",
    lambda lk: dq_reports.stringify_all(lk.silver("incidents")),
    q("SELECT COLUMNS(*)::VARCHAR FROM s_incidents", "s_incidents"),
)

# ── 2.3 data-quality framework ────────────────────────────────────────────────
register(
    "add_dq",
    lambda lk: quality.add_rules(
        silver.drop_audit_cols(lk.dq("claims").drop("_dq")), silver.RULES["claims"]).select("claim_id", "_dq"),
    q("SELECT claim_id, _dq FROM dq_claims", "dq_claims"),
)

register(
    "to_quarantine",
    lambda lk: lk.failed("claims").select(*QUARANTINE_CMP),
    q("SELECT * FROM quarantine WHERE source_table = 'claims'", "quarantine"),
)

register(
    "quarantine",
    lambda lk: lk.quarantine.select(*QUARANTINE_CMP),
    q("SELECT * FROM quarantine", "quarantine"),
)

_HARD_CLAIMS = "invalid_claim_id|missing_policy_fk|non_positive_claim_amount"
register(
    "split_by_policy",
    lambda lk: quality.split_by_policy(lk.dq("claims"), "documented", silver.RULES["claims"])[0],
    q(f"SELECT * EXCLUDE (_dq) FROM dq_claims WHERE _dq IS NULL "
      f"OR NOT regexp_matches(_dq, '(^|\\|)({_HARD_CLAIMS})(\\||$)')", "dq_claims"),
)

register(
    "expect_warn",
    lambda lk: quality.expectation_report(lk.bronze("claims"), {
        "claim_id_present": F.col("claim_id").isNotNull(),
        "amount_parses": F.col("claim_amount_gbp").try_cast("double").isNotNull(),
        "storm_flag_known": F.col("is_storm_related").isNotNull(),
    }),
    q("""
SELECT * FROM (VALUES ('claim_id_present'), ('amount_parses'), ('storm_flag_known')) e(expectation)
JOIN (
  SELECT 'claim_id_present' AS expectation, CAST(count_if(claim_id IS NOT NULL) AS BIGINT) AS passed,
         CAST(count_if(claim_id IS NULL) AS BIGINT) AS failed FROM fx_claims
  UNION ALL SELECT 'amount_parses', CAST(count_if(TRY_CAST(claim_amount_gbp AS DOUBLE) IS NOT NULL) AS BIGINT),
         CAST(count_if(TRY_CAST(claim_amount_gbp AS DOUBLE) IS NULL) AS BIGINT) FROM fx_claims
  UNION ALL SELECT 'storm_flag_known', CAST(count_if(is_storm_related IS NOT NULL) AS BIGINT),
         CAST(count_if(is_storm_related IS NULL) AS BIGINT) FROM fx_claims
) USING (expectation)""", "fx_claims"),
)

register(
    "dq_summary",
    lambda lk: dq_reports.dq_summary(lk.quarantine),
    q("""
SELECT source_table, dq_rule_violated, COUNT(*) AS failed_records, MIN(quarantined_at) AS first_seen,
       MAX(quarantined_at) AS last_seen, COUNT(DISTINCT CAST(quarantined_at AS DATE)) AS distinct_run_days
FROM quarantine GROUP BY 1, 2""", "quarantine"),
)

register(
    "dq_daily_trend",
    lambda lk: dq_reports.dq_daily_trend(lk.quarantine),
    q("""
SELECT CAST(quarantined_at AS DATE) AS run_date, source_table, COUNT(*) AS failed_records,
  COUNT(DISTINCT dq_rule_violated) AS distinct_rules_violated,
  CAST(SUM(CASE WHEN regexp_matches(dq_rule_violated, 'invalid.*_id|missing.*_fk|non_positive_claim_amount') THEN 1 ELSE 0 END) AS BIGINT) AS hard_blocks,
  CAST(SUM(CASE WHEN NOT regexp_matches(dq_rule_violated, 'invalid.*_id|missing.*_fk|non_positive_claim_amount') THEN 1 ELSE 0 END) AS BIGINT) AS soft_warnings
FROM quarantine GROUP BY 1, 2""", "quarantine"),
)

_HARD_11 = ("invalid_policyholder_id|invalid_vehicle_id|invalid_policy_id|invalid_claim_id|invalid_incident_id|"
            "invalid_assessment_id|missing_policyholder_fk|missing_vehicle_fk|missing_policy_fk|missing_claim_fk|"
            "non_positive_claim_amount")
register(
    "dq_hard_blocks",
    lambda lk: dq_reports.dq_hard_blocks(lk.quarantine).drop("raw_record"),
    q(f"SELECT source_table, record_id, dq_rule_violated, quarantined_at FROM quarantine "
      f"WHERE regexp_matches(dq_rule_violated, '{_HARD_11}')", "quarantine"),
)
register(
    "dq_soft_warnings",
    lambda lk: dq_reports.dq_soft_warnings(lk.quarantine).drop("raw_record"),
    q(f"SELECT source_table, record_id, dq_rule_violated, quarantined_at FROM quarantine "
      f"WHERE NOT regexp_matches(dq_rule_violated, '{_HARD_11}')", "quarantine"),
)
register(
    "dq_multi_issue",
    lambda lk: dq_reports.dq_multi_issue(lk.quarantine).drop("raw_record"),
    q("""SELECT source_table, record_id, dq_rule_violated,
       CAST(len(string_split(dq_rule_violated, '|')) AS INTEGER) AS issue_count, quarantined_at
FROM quarantine WHERE dq_rule_violated LIKE '%|%'""", "quarantine"),
)
register(
    "dq_multi_issue_len",
    lambda lk: dq_reports.dq_multi_issue_len(lk.quarantine).drop("raw_record"),
    q("""SELECT *, CAST(length(dq_rule_violated) - length(replace(dq_rule_violated, '|', '')) + 1 AS INTEGER) AS issue_count
FROM quarantine WHERE dq_rule_violated LIKE '%|%'""", "quarantine"),
)
register(
    "dq_claims_investigation",
    lambda lk: dq_reports.dq_claims_investigation(lk.quarantine).withColumns({
        "claim_amount_gbp": F.col("claim_amount_gbp").cast("double"),
        "fraud_risk_score": F.col("fraud_risk_score").cast("double")}),
    q(f"""
SELECT claim_id, _dq AS dq_rule_violated, {RUN_TS} AS quarantined_at, policy_id, claim_type,
  CAST(claim_date AS VARCHAR) AS claim_date, claim_amount_gbp, severity_label, fraud_risk_score,
  CAST(NULL AS VARCHAR) AS is_hailstorm_related, CAST(NULL AS VARCHAR) AS incident_state,
  incident_region, CAST(is_storm_related AS VARCHAR) AS is_storm_related
FROM dq_claims WHERE _dq IS NOT NULL""", "dq_claims"),
)
register(
    "dq_rule_breakdown",
    lambda lk: dq_reports.dq_rule_breakdown(lk.quarantine),
    q("SELECT source_table, dq_rule_violated, COUNT(*) AS failed_records FROM quarantine GROUP BY 1, 2",
      "quarantine"),
)
register(
    "dq_rule_breakdown_like",
    lambda lk: dq_reports.dq_rule_breakdown(lk.quarantine, "claims", "%invalid_severity%"),
    q("""SELECT source_table, dq_rule_violated, COUNT(*) AS failed_records FROM quarantine
WHERE source_table = 'claims' AND dq_rule_violated LIKE '%invalid_severity%' GROUP BY 1, 2""", "quarantine"),
)
register(
    "dq_failures_by_rule",
    lambda lk: dq_reports.dq_failures_by_rule(lk.quarantine),
    q("""SELECT source_table, rule, COUNT(*) AS failed_records FROM (
  SELECT source_table, unnest(string_split(dq_rule_violated, '|')) AS rule FROM quarantine) GROUP BY 1, 2""",
      "quarantine"),
)
register(
    "dq_recent_failures_alert",
    lambda lk: dq_reports.dq_recent_failures_alert(lk.quarantine, "2026-02-17 12:00:00"),
    q("""SELECT COUNT(*) AS failed_records, COUNT(*) > 0 AS alert FROM quarantine
WHERE quarantined_at >= TIMESTAMP '2026-02-17 12:00:00' - INTERVAL 24 HOURS""", "quarantine"),
)

cte("grain_dupes", """
SELECT claim_id, COUNT(*) AS occurrences FROM claim_features GROUP BY claim_id HAVING COUNT(*) > 1""",
    "claim_features")
register(
    "grain_check",
    lambda lk: quality.grain_check(lk.claim_features, ["claim_id"]),
    q("SELECT * FROM grain_dupes", "grain_dupes"),
)

def _rule_catalog(lk: Lake):
    out = None
    for entity, rules in silver.rule_catalog().items():
        part = quality.rule_report(silver.typed(entity, lk.bronze(entity), lk.as_of), entity, rules)
        out = part if out is None else out.unionByName(part)
    return out


_RULE_ROWS = ", ".join(f"('{e}', '{r.name}', '{r.severity}')" for e, rs in silver.RULES.items() for r in rs)
register(
    "rule_catalog",
    _rule_catalog,
    q(f"""SELECT c.entity, c.rule, c.severity, CAST(count(d.source_table) AS BIGINT) AS failed_records
FROM (VALUES {_RULE_ROWS}) c(entity, rule, severity)
LEFT JOIN (SELECT source_table, unnest(string_split(dq_rule_violated, '|')) AS rule FROM quarantine) d
  ON d.source_table = c.entity AND d.rule = c.rule
GROUP BY 1, 2, 3""", "quarantine"),
)

register(
    "scan_table",
    lambda lk: files.scan_table(lk.spark, files.TableConfig(lk.sf_dir, layout="{root}/{name}.parquet"), "", "customer"),
    q("SELECT * FROM customer"),
)

__all__ = ["BRONZE_ENTITIES", "ENTITY_IDS", "Lake"]

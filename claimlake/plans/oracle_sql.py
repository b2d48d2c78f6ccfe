"""Independent DuckDB formulations of every checked operator.

The oracle is written as SQL from the semantics (not generated from the Spark
code), so a bug in a DataFrame operator does not repeat itself here.  Shared
intermediate tables are CTEs; :func:`compose` pulls in the transitive
dependencies of a final SELECT in order.

Dialect notes (Spark ↔ DuckDB): ``datediff(end, start)`` ↔ ``date_diff('day',
start, end)``; ``dayofweek`` is 1-based in Spark and 0-based in DuckDB;
``date_format`` patterns ↔ ``strftime``; integer ``SUM`` is HUGEINT in DuckDB
and cast to BIGINT here; ``RLIKE`` ↔ ``regexp_matches``.
"""

from __future__ import annotations

import re

from ..sources.fixtures import FIXTURES, duckdb_cte

AS_OF = "DATE '2026-02-17'"
RUN_TS = "TIMESTAMP '2026-02-17 06:00:00'"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql.strip(), deps)


def _spark_round(sql: str) -> str:
    """Rewrite ``round(x, d)`` to Spark's rounding of doubles: HALF_UP applied to the
    shortest decimal text of ``x`` (DuckDB's own ``round`` scales in binary and
    differs on ties such as the mean of 0.046 and 0.071)."""
    out, i = [], 0
    pat = re.compile(r"(?<![A-Za-z0-9_])round\(", re.IGNORECASE)
    while True:
        m = pat.search(sql, i)
        if not m:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:m.start()])
        depth, j, comma = 1, m.end(), -1
        while depth:
            ch = sql[j]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = j
            j += 1
        inner_end = j - 1
        if comma < 0:
            out.append(sql[m.start():j])
        else:
            arg = _spark_round(sql[m.end():comma])
            digits = sql[comma + 1:inner_end].strip()
            out.append(f"CAST(round(CAST(CAST(({arg}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)")
        i = j


def compose(final_sql: str, *deps: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return _spark_round(final_sql.strip())
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    final = final_sql.strip()
    if re.match(r"(?i)^with\s", final):  # merge the final query's own CTEs into one WITH list
        return _spark_round(f"WITH {body},\n{final[5:]}")
    return _spark_round(f"WITH {body}\n{final}")


# ── fixture views ─────────────────────────────────────────────────────────────
for _name in FIXTURES:
    cte(f"fx_{_name}", duckdb_cte(_name))


def _dq(*rules: tuple[str, str]) -> str:
    flags = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for cond, name in rules)
    return f"NULLIF(concat_ws('|', {flags}), '') AS _dq"


def _bad_id(col: str, prefix: str) -> str:
    return f"({col} IS NULL OR NOT {col} LIKE '{prefix}%')"


# ── silver typed frames with _dq ──────────────────────────────────────────────
cte("dq_policyholders", f"""
SELECT * EXCLUDE (driving_points, driving_years, created_date),
  TRY_CAST(driving_points AS INTEGER) AS driving_points,
  TRY_CAST(driving_years AS INTEGER) AS driving_years,
  TRY_CAST(created_date AS DATE) AS created_date,
  {_dq((_bad_id('policyholder_id', 'PH-'), 'invalid_policyholder_id'),
       ('age IS NOT NULL AND NOT age BETWEEN 16 AND 100', 'age_out_of_range'),
       ("NOT email LIKE '%@%'", 'invalid_email_format'))}
FROM (SELECT *, CAST(floor(date_diff('day', TRY_CAST(date_of_birth AS DATE), {AS_OF}) / 365) AS INTEGER) AS age
      FROM fx_policyholders)""", "fx_policyholders")

cte("dq_vehicles", f"""
SELECT * EXCLUDE (year, estimated_value, mileage, created_date),
  year, estimated_value, mileage, created_date,
  {_dq((_bad_id('vehicle_id', 'VH-'), 'invalid_vehicle_id'),
       ('policyholder_id IS NULL', 'missing_policyholder_fk'),
       ('year IS NOT NULL AND NOT year BETWEEN 1990 AND 2030', 'year_out_of_range'),
       ('estimated_value IS NOT NULL AND estimated_value <= 0', 'non_positive_vehicle_value'))}
FROM (SELECT * REPLACE (TRY_CAST(year AS INTEGER) AS year, TRY_CAST(estimated_value AS DOUBLE) AS estimated_value,
                        TRY_CAST(mileage AS INTEGER) AS mileage, TRY_CAST(created_date AS DATE) AS created_date)
      FROM fx_vehicles)""", "fx_vehicles")

cte("dq_policies", f"""
SELECT *,
  {_dq((_bad_id('policy_id', 'POL-'), 'invalid_policy_id'),
       ('policyholder_id IS NULL', 'missing_policyholder_fk'),
       ('vehicle_id IS NULL', 'missing_vehicle_fk'),
       ('end_date IS NOT NULL AND start_date IS NOT NULL AND end_date <= start_date', 'end_date_before_start_date'),
       ('premium_monthly IS NOT NULL AND premium_monthly <= 0', 'non_positive_premium'))}
FROM (SELECT * REPLACE (TRY_CAST(premium_monthly AS DOUBLE) AS premium_monthly, TRY_CAST(excess AS DOUBLE) AS excess,
                        TRY_CAST(coverage_limit AS DOUBLE) AS coverage_limit, TRY_CAST(start_date AS DATE) AS start_date,
                        TRY_CAST(end_date AS DATE) AS end_date, TRY_CAST(created_date AS DATE) AS created_date)
      FROM fx_policies)""", "fx_policies")

cte("dq_claims", f"""
SELECT *,
  coalesce(TRY_CAST(fraud_risk_score AS DOUBLE) >= 0.6, FALSE) AS fraud_flag,
  {_dq((_bad_id('claim_id', 'CLM-'), 'invalid_claim_id'),
       ('policy_id IS NULL', 'missing_policy_fk'),
       ('claim_amount_gbp IS NOT NULL AND claim_amount_gbp <= 0', 'non_positive_claim_amount'),
       ("NOT severity_label IN ('minor', 'moderate', 'severe', 'total_loss')", 'invalid_severity_label'),
       ('fraud_risk_score IS NOT NULL AND NOT fraud_risk_score BETWEEN 0.0 AND 1.0', 'fraud_score_out_of_range'))}
FROM (SELECT * REPLACE (TRY_CAST(claim_amount_gbp AS DOUBLE) AS claim_amount_gbp,
                        TRY_CAST(fraud_risk_score AS DOUBLE) AS fraud_risk_score,
                        TRY_CAST(claim_date AS DATE) AS claim_date, TRY_CAST(created_date AS DATE) AS created_date,
                        coalesce(upper(is_storm_related) IN ('Y', 'YES', 'TRUE', '1'), FALSE) AS is_storm_related)
      FROM fx_claims)""", "fx_claims")

cte("dq_incidents", f"""
SELECT *,
  {_dq((_bad_id('incident_id', 'INC-'), 'invalid_incident_id'), ('claim_id IS NULL', 'missing_claim_fk'))}
FROM (SELECT * REPLACE (TRY_CAST(incident_date AS DATE) AS incident_date,
                        TRY_CAST(num_vehicles_involved AS INTEGER) AS num_vehicles_involved,
                        TRY_CAST(witness_count AS INTEGER) AS witness_count, TRY_CAST(created_date AS DATE) AS created_date)
      FROM fx_incidents)""", "fx_incidents")

cte("dq_claim_assessments", f"""
SELECT *, coalesce(estimated_repair_cost_gbp, 0.0) AS total_assessment_cost_gbp,
  {_dq((_bad_id('assessment_id', 'ASS-'), 'invalid_assessment_id'),
       ('claim_id IS NULL', 'missing_claim_fk'),
       ('estimated_repair_cost_gbp IS NOT NULL AND estimated_repair_cost_gbp <= 0', 'non_positive_repair_cost'),
       ('labour_hours IS NOT NULL AND labour_hours <= 0', 'non_positive_labor_hours'))}
FROM (SELECT * REPLACE (TRY_CAST(estimated_repair_cost_gbp AS DOUBLE) AS estimated_repair_cost_gbp,
                        TRY_CAST(labour_hours AS DOUBLE) AS labour_hours, TRY_CAST(parts_cost_gbp AS DOUBLE) AS parts_cost_gbp,
                        TRY_CAST(assessment_date AS DATE) AS assessment_date, TRY_CAST(created_date AS DATE) AS created_date)
      FROM fx_claim_assessments)""", "fx_claim_assessments")

ENTITY_IDS = {
    "policyholders": "policyholder_id", "vehicles": "vehicle_id", "policies": "policy_id",
    "claims": "claim_id", "incidents": "incident_id", "claim_assessments": "assessment_id",
}

for _e in ENTITY_IDS:
    cte(f"s_{_e}", f"SELECT * EXCLUDE (_dq) FROM dq_{_e} WHERE _dq IS NULL", f"dq_{_e}")

cte("quarantine", "\nUNION ALL\n".join(
    f"SELECT '{e}' AS source_table, CAST({i} AS VARCHAR) AS record_id, _dq AS dq_rule_violated, "
    f"{RUN_TS} AS quarantined_at FROM dq_{e} WHERE _dq IS NOT NULL"
    for e, i in ENTITY_IDS.items()), *[f"dq_{e}" for e in ENTITY_IDS])

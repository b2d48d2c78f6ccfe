"""Silver conformance: typed casts, derived columns and the rule catalogue per entity.

Each ``*_dq`` function takes the all-string bronze frame and returns the typed
frame plus ``_dq``.  Casts use ``try_cast`` so unparsable text becomes NULL
(Spark 4 runs with ANSI on, where a plain cast would fail the job).  The
``silver_*`` functions keep the clean rows (strict policy).

All of it is narrow: one projection per entity, no shuffle.  At scale the
``_dq`` frame has two consumers (clean table and quarantine); the pipeline
writes it once and reads it back rather than scanning bronze twice.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import Rule, add_rules, clean_rows, failing_rows, passing_rows

AUDIT_COLUMNS = ("_ingested_at", "_source_file", "_rescued_data")

# Fixed values of the reference's conformance logic.
SEVERITY_LABELS = ("minor", "moderate", "severe", "total_loss")
STORM_TRUE_VALUES = ("Y", "YES", "TRUE", "1")
FRAUD_FLAG_THRESHOLD = 0.6
AGE_RANGE = (16, 100)
VEHICLE_YEAR_RANGE = (1990, 2030)
DEFAULT_AS_OF = date(2026, 2, 17)


def _c(name: str) -> Column:
    return F.col(name)


def _bad_id(col: str, prefix: str) -> Column:
    return _c(col).isNull() | ~_c(col).like(f"{prefix}%")


def _non_positive(col: str) -> Column:
    return _c(col).isNotNull() & (_c(col) <= 0)


def _as_date(col: str) -> Column:
    return _c(col).try_cast("date")


def drop_audit_cols(df: DataFrame) -> DataFrame:
    """Remove the bronze system columns (no-op for the ones that are absent)."""
    return df.drop(*[c for c in AUDIT_COLUMNS if c in df.columns])


# Rule catalogue: entity -> rules in declaration order.  Severity follows the
# data-quality documentation (hard = drop, soft = warn); the strict policy
# ignores severity, as the pipeline code does.
RULES: dict[str, list[Rule]] = {
    "policyholders": [
        Rule("invalid_policyholder_id", lambda: _bad_id("policyholder_id", "PH-")),
        Rule("age_out_of_range", lambda: _c("age").isNotNull() & ~_c("age").between(*AGE_RANGE)),
        Rule("invalid_email_format", lambda: ~_c("email").like("%@%"), "soft"),
    ],
    "vehicles": [
        Rule("invalid_vehicle_id", lambda: _bad_id("vehicle_id", "VH-")),
        Rule("missing_policyholder_fk", lambda: _c("policyholder_id").isNull()),
        Rule("year_out_of_range",
             lambda: _c("year").isNotNull() & ~_c("year").between(*VEHICLE_YEAR_RANGE), "soft"),
        Rule("non_positive_vehicle_value", lambda: _non_positive("estimated_value"), "soft"),
    ],
    "policies": [
        Rule("invalid_policy_id", lambda: _bad_id("policy_id", "POL-")),
        Rule("missing_policyholder_fk", lambda: _c("policyholder_id").isNull()),
        Rule("missing_vehicle_fk", lambda: _c("vehicle_id").isNull()),
        Rule("end_date_before_start_date",
             lambda: _c("end_date").isNotNull() & _c("start_date").isNotNull()
             & (_c("end_date") <= _c("start_date")), "soft"),
        Rule("non_positive_premium", lambda: _non_positive("premium_monthly"), "soft"),
    ],
    "claims": [
        Rule("invalid_claim_id", lambda: _bad_id("claim_id", "CLM-")),
        Rule("missing_policy_fk", lambda: _c("policy_id").isNull()),
        Rule("non_positive_claim_amount", lambda: _non_positive("claim_amount_gbp")),
        Rule("invalid_severity_label", lambda: ~_c("severity_label").isin(*SEVERITY_LABELS), "soft"),
        Rule("fraud_score_out_of_range",
             lambda: _c("fraud_risk_score").isNotNull() & ~_c("fraud_risk_score").between(0.0, 1.0), "soft"),
    ],
    "incidents": [
        Rule("invalid_incident_id", lambda: _bad_id("incident_id", "INC-")),
        Rule("missing_claim_fk", lambda: _c("claim_id").isNull()),
    ],
    "claim_assessments": [
        Rule("invalid_assessment_id", lambda: _bad_id("assessment_id", "ASS-")),
        Rule("missing_claim_fk", lambda: _c("claim_id").isNull()),
        Rule("non_positive_repair_cost", lambda: _non_positive("estimated_repair_cost_gbp"), "soft"),
        Rule("non_positive_labor_hours", lambda: _non_positive("labour_hours"), "soft"),
    ],
}

ID_COLUMNS = {
    "policyholders": "policyholder_id",
    "vehicles": "vehicle_id",
    "policies": "policy_id",
    "claims": "claim_id",
    "incidents": "incident_id",
    "claim_assessments": "assessment_id",
}


def rule_catalog() -> dict[str, list[Rule]]:
    return {k: list(v) for k, v in RULES.items()}


def _with(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    return drop_audit_cols(df).withColumns(cols)


def typed_policyholders(df: DataFrame, as_of: date | Column = DEFAULT_AS_OF) -> DataFrame:
    """``age = floor(days(as_of - dob) / 365)`` — ignores leap days like the reference."""
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of)
    typed = _with(df, {
        "age": F.floor(F.datediff(as_of_col, _as_date("date_of_birth")) / 365).cast("int"),
        "driving_points": _c("driving_points").try_cast("int"),
        "driving_years": _c("driving_years").try_cast("int"),
        "created_date": _as_date("created_date"),
    })
    return typed


def typed_vehicles(df: DataFrame) -> DataFrame:
    typed = _with(df, {
        "year": _c("year").try_cast("int"),
        "estimated_value": _c("estimated_value").try_cast("double"),
        "mileage": _c("mileage").try_cast("int"),
        "created_date": _as_date("created_date"),
    })
    return typed


def typed_policies(df: DataFrame) -> DataFrame:
    typed = _with(df, {
        "premium_monthly": _c("premium_monthly").try_cast("double"),
        "excess": _c("excess").try_cast("double"),
        "coverage_limit": _c("coverage_limit").try_cast("double"),
        "start_date": _as_date("start_date"),
        "end_date": _as_date("end_date"),
        "created_date": _as_date("created_date"),
    })
    return typed


def typed_claims(df: DataFrame) -> DataFrame:
    score = _c("fraud_risk_score").try_cast("double")
    typed = _with(df, {
        "claim_amount_gbp": _c("claim_amount_gbp").try_cast("double"),
        "fraud_risk_score": score,
        "claim_date": _as_date("claim_date"),
        "created_date": _as_date("created_date"),
        "is_storm_related": F.coalesce(F.upper(_c("is_storm_related")).isin(*STORM_TRUE_VALUES), F.lit(False)),
        "fraud_flag": F.coalesce(score >= FRAUD_FLAG_THRESHOLD, F.lit(False)),
    })
    return typed


def typed_incidents(df: DataFrame) -> DataFrame:
    typed = _with(df, {
        "incident_date": _as_date("incident_date"),
        "num_vehicles_involved": _c("num_vehicles_involved").try_cast("int"),
        "witness_count": _c("witness_count").try_cast("int"),
        "created_date": _as_date("created_date"),
    })
    return typed


def typed_claim_assessments(df: DataFrame) -> DataFrame:
    repair = _c("estimated_repair_cost_gbp").try_cast("double")
    typed = _with(df, {
        "estimated_repair_cost_gbp": repair,
        "labour_hours": _c("labour_hours").try_cast("double"),
        "parts_cost_gbp": _c("parts_cost_gbp").try_cast("double"),
        "assessment_date": _as_date("assessment_date"),
        "created_date": _as_date("created_date"),
        "total_assessment_cost_gbp": F.coalesce(repair, F.lit(0.0)),
    })
    return typed


TYPERS = {
    "policyholders": typed_policyholders,
    "vehicles": typed_vehicles,
    "policies": typed_policies,
    "claims": typed_claims,
    "incidents": typed_incidents,
    "claim_assessments": typed_claim_assessments,
}


def typed(entity: str, bronze: DataFrame, as_of: date | None = None) -> DataFrame:
    """Casts and derived columns of one entity (no rule evaluation)."""
    if entity == "policyholders":
        return typed_policyholders(bronze, as_of or DEFAULT_AS_OF)
    return TYPERS[entity](bronze)


def conform(entity: str, bronze: DataFrame, as_of: date | None = None) -> DataFrame:
    """Typed frame + ``_dq`` for one entity."""
    return add_rules(typed(entity, bronze, as_of), RULES[entity])


def silver_policyholders_dq(df: DataFrame, as_of: date | Column = DEFAULT_AS_OF) -> DataFrame:
    return add_rules(typed_policyholders(df, as_of), RULES["policyholders"])


def silver_vehicles_dq(df: DataFrame) -> DataFrame:
    return add_rules(typed_vehicles(df), RULES["vehicles"])


def silver_policies_dq(df: DataFrame) -> DataFrame:
    return add_rules(typed_policies(df), RULES["policies"])


def silver_claims_dq(df: DataFrame) -> DataFrame:
    return add_rules(typed_claims(df), RULES["claims"])


def silver_incidents_dq(df: DataFrame) -> DataFrame:
    return add_rules(typed_incidents(df), RULES["incidents"])


def silver_assessments_dq(df: DataFrame) -> DataFrame:
    return add_rules(typed_claim_assessments(df), RULES["claim_assessments"])


def clean(entity: str, bronze: DataFrame, as_of: date | None = None) -> DataFrame:
    """Clean rows straight from the rule predicates (no ``_dq`` string is built)."""
    return passing_rows(typed(entity, bronze, as_of), RULES[entity])


def failing(entity: str, bronze: DataFrame, as_of: date | None = None) -> DataFrame:
    """Flagged rows with ``_dq``; the rule-name string is built for those rows only."""
    return failing_rows(typed(entity, bronze, as_of), RULES[entity])


def silver_policyholders(dq: DataFrame) -> DataFrame:
    return clean_rows(dq)


silver_vehicles = silver_policies = silver_claims = silver_policyholders
silver_incidents = silver_claim_assessments = silver_policyholders

"""Reports over the quarantine table (the reference's saved DQ queries and alert).

Each report is one filter or one aggregate over quarantine; hard/soft
classification keeps each source query's own regular expression.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the reference's saved queries.
HARD_RULES_TREND = "invalid.*_id|missing.*_fk|non_positive_claim_amount"
HARD_RULES_BLOCKS = (
    "invalid_policyholder_id|invalid_vehicle_id|invalid_policy_id|invalid_claim_id|invalid_incident_id|"
    "invalid_assessment_id|missing_policyholder_fk|missing_vehicle_fk|missing_policy_fk|missing_claim_fk|"
    "non_positive_claim_amount"
)
INVESTIGATION_FIELDS = ("policy_id", "claim_type", "claim_date", "claim_amount_gbp", "severity_label",
                        "fraud_risk_score", "is_hailstorm_related", "incident_state")
# Fields that the claims entity really has (the two above it names do not exist).
INVESTIGATION_EXTRA = ("incident_region", "is_storm_related")


def _rule() -> Column:
    return F.col("dq_rule_violated")


def stringify_all(df: DataFrame) -> DataFrame:
    """Cast every column to string (landing files are all text)."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def dq_summary(q: DataFrame) -> DataFrame:
    return (q.groupBy("source_table", "dq_rule_violated")
            .agg(F.count(F.lit(1)).alias("failed_records"),
                 F.min("quarantined_at").alias("first_seen"),
                 F.max("quarantined_at").alias("last_seen"),
                 F.countDistinct(F.to_date("quarantined_at")).alias("distinct_run_days"))
            .orderBy(F.col("failed_records").desc(), "source_table", "dq_rule_violated"))


def dq_daily_trend(q: DataFrame, hard_regex: str = HARD_RULES_TREND) -> DataFrame:
    hard = _rule().rlike(hard_regex)
    return (q.groupBy(F.to_date("quarantined_at").alias("run_date"), "source_table")
            .agg(F.count(F.lit(1)).alias("failed_records"),
                 F.countDistinct("dq_rule_violated").alias("distinct_rules_violated"),
                 F.sum(F.when(hard, 1).otherwise(0)).alias("hard_blocks"),
                 F.sum(F.when(~hard, 1).otherwise(0)).alias("soft_warnings"))
            .orderBy(F.col("run_date").desc(), "source_table"))


def _listing(q: DataFrame, cond: Column) -> DataFrame:
    return (q.filter(cond)
            .select("source_table", "record_id", "dq_rule_violated", "quarantined_at", "raw_record")
            .orderBy("source_table", F.col("quarantined_at").desc(), "record_id"))


def dq_hard_blocks(q: DataFrame, hard_regex: str = HARD_RULES_BLOCKS) -> DataFrame:
    return _listing(q, _rule().rlike(hard_regex))


def dq_soft_warnings(q: DataFrame, hard_regex: str = HARD_RULES_BLOCKS) -> DataFrame:
    return _listing(q, ~_rule().rlike(hard_regex))


def dq_multi_issue(q: DataFrame) -> DataFrame:
    return (q.filter(_rule().like("%|%"))
            .select("source_table", "record_id", "dq_rule_violated",
                    F.size(F.split(_rule(), r"\|")).alias("issue_count"), "raw_record", "quarantined_at")
            .orderBy(F.col("issue_count").desc(), "source_table", "record_id"))


def dq_multi_issue_len(q: DataFrame) -> DataFrame:
    """Same count by length arithmetic (the documentation's variant)."""
    n = F.length(_rule()) - F.length(F.replace(_rule(), F.lit("|"), F.lit(""))) + 1
    return q.filter(_rule().like("%|%")).withColumn("issue_count", n).orderBy(F.col("issue_count").desc())


def dq_claims_investigation(q: DataFrame) -> DataFrame:
    """Claim fields pulled out of ``raw_record`` JSON; fields the JSON lacks come back NULL.

    The record is parsed once (``from_json`` into a struct of text fields, so
    numbers keep their JSON text) instead of once per extracted field.
    """
    fields = INVESTIGATION_FIELDS + INVESTIGATION_EXTRA
    schema = "struct<" + ",".join(f"{f}:string" for f in fields) + ">"
    return (q.filter(F.col("source_table") == "claims")
            .select(F.col("record_id").alias("claim_id"), "dq_rule_violated", "quarantined_at",
                    F.from_json(F.col("raw_record"), schema).alias("_r"))
            .select("claim_id", "dq_rule_violated", "quarantined_at", *[F.col(f"_r.{f}").alias(f) for f in fields])
            .orderBy(F.col("quarantined_at").desc(), "claim_id"))


def dq_rule_breakdown(q: DataFrame, source_table: str | None = None, like: str | None = None) -> DataFrame:
    if source_table is not None:
        q = q.filter(F.col("source_table") == source_table)
    if like is not None:
        q = q.filter(_rule().like(like))
    return (q.groupBy("source_table", "dq_rule_violated").agg(F.count(F.lit(1)).alias("failed_records"))
            .orderBy(F.col("failed_records").desc(), "source_table", "dq_rule_violated"))


def dq_failures_by_rule(q: DataFrame) -> DataFrame:
    """One row per single rule: the bar-joined list is exploded before counting."""
    return (q.select("source_table", F.explode(F.split(_rule(), r"\|")).alias("rule"))
            .groupBy("source_table", "rule").agg(F.count(F.lit(1)).alias("failed_records")))


def dq_recent_failures_alert(q: DataFrame, run_ts: datetime | str, hours: int = 24,
                             threshold: int = 0) -> DataFrame:
    """Failures in the last ``hours`` before ``run_ts`` and whether that exceeds ``threshold``."""
    ts = F.lit(str(run_ts)).cast("timestamp_ntz")
    recent = q.filter(F.col("quarantined_at") >= ts - F.expr(f"INTERVAL {int(hours)} HOURS"))
    return recent.agg(F.count(F.lit(1)).alias("failed_records")).withColumn(
        "alert", F.col("failed_records") > threshold)

"""End-to-end job: bronze → silver (+ quarantine) → gold dimensions, facts, features, summaries.

Same stage order as the reference's job (bronze, silver, dimensions, facts,
features, summary).  Each stage reads the previous stage's *written* tables,
so lineage is cut at every table: a lost executor recomputes from the last
table, not from the landing files.  The ``_dq`` frame of each entity has two
consumers (clean table and quarantine); it is written once and both are
derived from that copy instead of conforming bronze twice.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators import features, quality, silver, star, summary
from ..sources.files import TableConfig, materialize, scan_table
from ..sources.fixtures import BRONZE_ENTITIES

SILVER, GOLD = "silver", "gold"
# Silver tables joined on claim_id downstream (facts, features, triage summary):
# bucketed alike when the catalog supports it, so those joins need no shuffle.
CLAIM_KEYED = {"claims": "claim_id", "incidents": "claim_id", "claim_assessments": "claim_id"}


def run(spark: SparkSession, cfg: TableConfig, bronze: Callable[[str], DataFrame], as_of: date,
        run_ts: datetime, stages: tuple[str, ...] = ("silver", "dimensions", "facts", "features", "summary")
        ) -> dict[str, str]:
    """Run the stages in order; returns table name → location."""
    out: dict[str, str] = {}

    def t(layer: str, name: str) -> DataFrame:
        return scan_table(spark, cfg, layer, name)

    if "silver" in stages:
        failed = None
        for entity in BRONZE_ENTITIES:
            dq = silver.conform(entity, bronze(entity), as_of)
            materialize(dq, cfg, SILVER, f"_dq_{entity}")                    # one pass over bronze
            dq = t(SILVER, f"_dq_{entity}")
            out[entity] = materialize(quality.clean_rows(dq), cfg, SILVER, entity,
                                      bucket_by=CLAIM_KEYED.get(entity))
            part = quality.to_quarantine(dq, entity, silver.ID_COLUMNS[entity], run_ts)
            failed = part if failed is None else failed.unionByName(part)
        out["quarantine"] = materialize(failed, cfg, SILVER, "quarantine")

    s = {e: (lambda e=e: t(SILVER, e)) for e in BRONZE_ENTITIES}
    if "dimensions" in stages:
        out["dim_date"] = materialize(star.dim_date(spark), cfg, GOLD, "dim_date")
        out["dim_geography"] = materialize(star.dim_geography(s["claims"](), s["policyholders"]()), cfg, GOLD,
                                           "dim_geography")
        out["dim_policyholder"] = materialize(star.dim_policyholder(s["policyholders"]()), cfg, GOLD,
                                              "dim_policyholder")
        out["dim_vehicle"] = materialize(star.dim_vehicle(s["vehicles"]()), cfg, GOLD, "dim_vehicle")
        out["dim_policy"] = materialize(star.dim_policy(s["policies"]()), cfg, GOLD, "dim_policy")
    if "facts" in stages:
        out["fact_claim"] = materialize(
            star.claims_with_dimensions(s["claims"](), s["policies"](), s["policyholders"](), s["vehicles"]()), cfg, GOLD,
            "fact_claim", partition_by=["claim_type"], then=star.facts_of)
        out["fact_assessment"] = materialize(star.fact_assessment(s["claim_assessments"](), s["claims"]()), cfg,
                                             GOLD, "fact_assessment")
    if "features" in stages:
        out["claim_features"] = materialize(features.claim_features(
            s["claims"](), s["policies"](), s["policyholders"](), s["vehicles"](), s["incidents"](),
            s["claim_assessments"]()), cfg, GOLD, "claim_features")
        out["policyholder_risk_profile"] = materialize(features.policyholder_risk_profile(
            s["policyholders"](), s["claims"](), s["policies"]()), cfg, GOLD, "policyholder_risk_profile")
    if "summary" in stages:
        # month-partitioned: the reports filter on month ranges, so reads prune partitions
        out["summary_claims_daily"] = materialize(summary.summary_claims_daily(s["claims"]()), cfg, GOLD,
                                                  "summary_claims_daily", partition_by=["month"])
        out["summary_financial_kpis"] = materialize(summary.summary_financial_kpis(s["claims"](), s["policies"]()),
                                                    cfg, GOLD, "summary_financial_kpis")
        out["summary_fraud_intelligence"] = materialize(summary.summary_fraud_intelligence(s["claims"]()), cfg,
                                                        GOLD, "summary_fraud_intelligence", partition_by=["month"])
        out["summary_triage_performance"] = materialize(summary.summary_triage_performance(
            s["claim_assessments"](), s["claims"]()), cfg, GOLD, "summary_triage_performance")
    return out

"""Fraud analytics over ``summary_fraud_intelligence`` (already aggregated, so small).

Filters are composed ``Column`` predicates (no SQL text with spliced values).
Rates follow the reference: percent with ``NULLIF`` and 2 dp; the mean score
is an unweighted mean of group means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import pct

CLAIM_TYPES = ("weather", "collision", "theft", "vandalism", "fire")
STORM_LABELS = ("Storm Freya", "Baseline")


def fraud_predicate(months: tuple[str, str] | None = None, regions: Sequence[str] = (),
                    claim_types: Sequence[str] = (), storm: str = "all") -> Column:
    cond = F.lit(True)
    if months:
        cond = cond & F.col("month").between(months[0], months[1])
    if regions:
        cond = cond & F.col("incident_region").isin(*regions)
    if claim_types:
        cond = cond & F.col("claim_type").isin(*claim_types)
    if storm == "storm":
        cond = cond & (F.col("is_storm_related") == F.lit(True))
    elif storm == "non_storm":
        cond = cond & (F.col("is_storm_related") == F.lit(False))
    elif storm != "all":
        raise ValueError(storm)
    return cond


def fraud_where(s: DataFrame, months: tuple[str, str] | None = None, regions: Sequence[str] = (),
                claim_types: Sequence[str] = (), storm: str = "all") -> DataFrame:
    return s.filter(fraud_predicate(months, regions, claim_types, storm))


def fraud_filter_values(s: DataFrame) -> DataFrame:
    """Sorted non-NULL months, regions and claim types, one row per (kind, value), from one pass over the summary."""
    kinds = {"month": "month", "region": "incident_region", "claim_type": "claim_type"}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in kinds.items()]))
    return s.select(each.alias("v")).select("v.*").where("value IS NOT NULL").distinct().orderBy("kind", "value")


def _rate() -> Column:
    return pct(F.sum("flagged_claims"), F.sum("total_claims")).alias("fraud_rate_pct")


def _amount_ratio() -> Column:
    return pct(F.sum("flagged_claims_gbp"), F.sum("total_claims_gbp")).alias("fraud_amount_ratio_pct")


def _amount() -> Column:
    return F.round(F.sum("flagged_claims_gbp"), 0).alias("fraud_amount_gbp")


def _score() -> Column:
    return F.round(F.avg("avg_fraud_score"), 3).alias("avg_fraud_score")


def _totals() -> list[Column]:
    return [F.sum("total_claims").alias("total_claims"), F.sum("flagged_claims").alias("flagged_claims")]


def fraud_kpis(s: DataFrame) -> DataFrame:
    return s.agg(*_totals(), _rate(), _amount(), _amount_ratio(), _score())


def fraud_by_region(s: DataFrame) -> DataFrame:
    return (s.groupBy("incident_region").agg(*_totals(), _rate(), _amount())
            .orderBy(F.col("fraud_rate_pct").desc(), "incident_region"))


def fraud_storm_vs_baseline(s: DataFrame) -> DataFrame:
    return (s.groupBy("is_storm_related")
            .agg(_rate(), _amount_ratio(), *_totals())
            .select(F.when(F.col("is_storm_related"), STORM_LABELS[0]).otherwise(STORM_LABELS[1])
                    .alias("period_type"), "fraud_rate_pct", "fraud_amount_ratio_pct",
                    "total_claims", "flagged_claims", "is_storm_related")
            .orderBy(F.col("is_storm_related").desc())
            .drop("is_storm_related"))


def fraud_trend(s: DataFrame) -> DataFrame:
    return (s.groupBy("month", "claim_type").agg(_rate(), *_totals()).orderBy("month", "claim_type"))


def fraud_by_type(s: DataFrame) -> DataFrame:
    return (s.groupBy("claim_type").agg(*_totals(), _rate(), _score(), _amount())
            .orderBy(F.col("fraud_rate_pct").desc(), "claim_type"))


def fraud_rate_vs_amount(s: DataFrame) -> DataFrame:
    return s.groupBy("incident_region").agg(_rate(), _amount_ratio(), F.sum("total_claims").alias("total_claims"),
                                            _amount())


def fraud_heatmap_long(s: DataFrame) -> DataFrame:
    return s.groupBy("incident_region", "claim_type").agg(_rate())


def fraud_heatmap(s: DataFrame, claim_types: Sequence[str] = CLAIM_TYPES) -> DataFrame:
    """Region × claim type grid of fraud rate %, rounded to 1 dp; the type list is fixed
    so the pivot needs no extra distinct pass."""
    long = fraud_heatmap_long(s)
    wide = long.groupBy("incident_region").pivot("claim_type", list(claim_types)).agg(F.avg("fraud_rate_pct"))
    return wide.select("incident_region", *[F.round(F.col(t), 1).alias(t) for t in claim_types])


def fraud_detail(s: DataFrame) -> DataFrame:
    return (s.groupBy("month", "incident_region", "claim_type", "is_storm_related")
            .agg(*_totals(), _rate(), _score(), _amount(), _amount_ratio())
            .select("month", F.col("incident_region").alias("region"), "claim_type",
                    F.when(F.col("is_storm_related"), "Yes").otherwise("No").alias("storm"),
                    "total_claims", "flagged_claims", "fraud_rate_pct", "avg_fraud_score",
                    "fraud_amount_gbp", "fraud_amount_ratio_pct")
            .orderBy(F.col("fraud_rate_pct").desc(), "month", "region", "claim_type", "storm"))

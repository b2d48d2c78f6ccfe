"""Distributed synthetic claims data: six landing entities plus injected bad rows.

Re-aimed from a single-notebook generator to a Spark job over a key spine:
each entity is produced from a frame of integer ids (normally the keys of an
existing table, or ``spark.range`` for a stand-alone build), so the work is a
narrow projection spread over the spine's partitions.

Every random draw is ``xxhash64(seed, stream, id)`` mapped to [0, 1), not
``rand(seed)``: the value of a row does not depend on how the spine happens to
be partitioned, so a rerun (or a retried task) produces the same rows.
Normal draws use Box–Muller on two uniforms; weighted picks are CASE ladders
over cumulative weights; "chains" reproduce ``when(u1 < p1).when(u2 < p2)…``
where each step is a conditional probability.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_U53 = float(1 << 53)

# Fixed values of the reference's generator (weights, lists, distribution parameters).
UK_REGION_WEIGHTS = (
    ("Greater London", 22), ("West Yorkshire", 12), ("West Midlands", 10), ("Greater Manchester", 10),
    ("South Yorkshire", 8), ("Merseyside", 6), ("Hampshire", 5), ("Essex", 5), ("Kent", 4), ("Lancashire", 4),
    ("Somerset", 4), ("Nottinghamshire", 3), ("Devon", 3), ("Tyne and Wear", 2), ("Bristol", 1),
    ("North Yorkshire", 1),
)
STORM_REGION_WEIGHTS = (("West Yorkshire", 30), ("South Yorkshire", 25), ("Somerset", 20),
                        ("Greater Manchester", 15), ("Devon", 10))
NON_STORM_REGION_WEIGHTS = (
    ("Greater London", 25), ("West Midlands", 12), ("Merseyside", 8), ("Hampshire", 8), ("Essex", 7), ("Kent", 7),
    ("Lancashire", 6), ("Nottinghamshire", 5), ("Tyne and Wear", 5), ("Bristol", 5), ("North Yorkshire", 5),
    ("West Yorkshire", 7),
)
UK_MAKES = ("Volkswagen", "Ford", "Vauxhall", "Toyota", "BMW", "Nissan", "Audi", "Mercedes-Benz", "Hyundai",
            "Land Rover")
VEHICLE_TYPES = ("Hatchback", "Saloon", "SUV", "Estate", "MPV", "Crossover", "Coupe")
COLOURS = ("White", "Black", "Silver", "Grey", "Blue", "Red", "Green", "Bronze", "Orange")
POLICY_TYPES = ("Comprehensive", "ThirdPartyFireTheft", "ThirdPartyOnly")
COVERAGE_TYPES = ("Accidental Damage", "Fire and Theft", "Third Party Liability", "Windscreen Cover", "Courtesy Car")
POLICY_STATUSES = ("Active", "Active", "Active", "Active", "Active", "Active", "Lapsed", "Cancelled")
EXCESS_GBP = (250.0, 500.0, 1000.0, 2000.0)
CLAIM_STATUSES = ("open", "under_review", "approved", "denied", "settled")
INCIDENT_TYPES = ("collision", "flood_damage", "storm_damage", "theft", "vandalism", "fire")
WEATHER = ("clear", "heavy_rain", "flood", "snow", "fog", "strong_wind", "hail")
ROAD = ("dry", "wet", "flooded", "icy", "waterlogged", "debris_on_road")
VISIBILITY = ("good", "moderate", "poor")
DAMAGE_CATEGORIES = ("exterior_bodywork", "mechanical", "total_loss", "interior", "glass_windscreen", "electrical",
                     "flood_damage")
ACTIONS = ("repair", "replace", "write_off", "deny", "further_investigation")
N_ASSESSORS = 200
BAD_RATIO = 0.03


@dataclass(frozen=True)
class SynthParams:
    """Distribution parameters (defaults = the reference's training data)."""

    seed: int = 42
    storm_share: float = 0.35
    storm_window: tuple[date, date] = (date(2026, 2, 3), date(2026, 2, 17))
    history_start: date = date(2024, 1, 1)
    created_claims: str = "2026-02-17"
    # conditional chains: (probability, label) steps, then the fallback label
    severity_storm: tuple = ((0.12, "total_loss"), (0.42, "severe"), (0.80, "moderate"), (None, "minor"))
    severity_base: tuple = ((0.05, "total_loss"), (0.20, "severe"), (0.55, "moderate"), (None, "minor"))
    claim_type_base: tuple = ((0.45, "collision"), (0.65, "theft"), (0.85, "vandalism"), (None, "fire"))
    fraud_share_storm: float = 0.14
    fraud_share_base: float = 0.08
    amount_lognormal_storm: tuple[float, float] = (8.4, 0.6)
    amount_lognormal_base: tuple[float, float] = (7.7, 0.7)
    # when set, severity is an unconditional weighted pick instead of the chains
    severity_weights: tuple | None = None
    region_weights_storm: tuple = STORM_REGION_WEIGHTS
    region_weights_base: tuple = NON_STORM_REGION_WEIGHTS
    bad_ratio: float = BAD_RATIO
    extra: dict = field(default_factory=dict)


# Validation batch: fewer storm claims and flat severity weights (a shifted distribution).
SHIFTED = SynthParams(seed=999, storm_share=0.10,
                      severity_weights=(("minor", 26), ("moderate", 41), ("severe", 26), ("total_loss", 7)))


# ── deterministic draws ───────────────────────────────────────────────────────
def uniform(ids: Column, seed: int, stream: int) -> Column:
    """U[0, 1) from the 53 low bits of ``xxhash64(seed, stream, id)``."""
    h = F.xxhash64(F.lit(seed), F.lit(stream), ids)
    return F.pmod(h, F.lit(1 << 53)).cast("double") / _U53


def normal(ids: Column, seed: int, stream: int) -> Column:
    u1 = F.greatest(uniform(ids, seed, stream), F.lit(1e-300))
    u2 = uniform(ids, seed, stream + 10_000)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2 * math.pi * u2)


def lognormal(ids: Column, seed: int, stream: int, mu: float, sigma: float) -> Column:
    return F.round(F.exp(normal(ids, seed, stream) * sigma + mu), 2)


def weighted(u: Column, weights: Sequence[tuple[str, float]]) -> Column:
    total = float(sum(w for _, w in weights))
    out, acc = None, 0.0
    for label, w in weights[:-1]:
        acc += w / total
        out = F.when(u < acc, F.lit(label)) if out is None else out.when(u < acc, F.lit(label))
    last = F.lit(weights[-1][0])
    return last if out is None else out.otherwise(last)


def chain(ids: Column, seed: int, stream: int, steps: Sequence[tuple[float | None, str]]) -> Column:
    """``when(u1 < p1, l1).when(u2 < p2, l2)…otherwise(last)`` with independent uniforms."""
    out = None
    for i, (p, label) in enumerate(steps):
        if p is None:
            return out.otherwise(F.lit(label))
        cond = uniform(ids, seed, stream + i) < p
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def pick(ids: Column, seed: int, stream: int, values: Sequence) -> Column:
    idx = (F.floor(uniform(ids, seed, stream) * len(values)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


def ref_id(prefix: str, n: int | Column, ids: Column, seed: int, stream: int, width: int = 6) -> Column:
    k = F.floor(uniform(ids, seed, stream) * n).cast("bigint") + 1
    return F.concat(F.lit(prefix), F.lpad(k.cast("string"), width, "0"))


def _id(prefix: str, ids: Column, width: int = 6) -> Column:
    return F.concat(F.lit(prefix), F.lpad((ids + 1).cast("string"), width, "0"))


def _day(u: Column, start: date, end: date) -> Column:
    span = (end - start).days
    return F.date_add(F.lit(start), F.floor(u * span).cast("int"))


# ── entities ──────────────────────────────────────────────────────────────────
def claims(spine: DataFrame, n_policies: int, n_policyholders: int, n_vehicles: int,
           params: SynthParams = SynthParams(), id_col: str = "id") -> DataFrame:
    i, s, p = F.col(id_col), params.seed, params
    storm = uniform(i, s, 20) < p.storm_share
    hist_end = date.fromordinal(p.storm_window[0].toordinal() - 1)
    if p.severity_weights:
        sev = weighted(uniform(i, s, 40), p.severity_weights)
    else:
        sev = F.when(storm, chain(i, s, 40, p.severity_storm)).otherwise(chain(i, s, 44, p.severity_base))
    fraud_hi = uniform(i, s, 51) * 0.4 + 0.6
    fraud_lo = uniform(i, s, 52) * 0.45
    fraud = F.round(F.when(storm, F.when(uniform(i, s, 50) < p.fraud_share_storm, fraud_hi).otherwise(fraud_lo))
                    .otherwise(F.when(uniform(i, s, 53) < p.fraud_share_base, fraud_hi).otherwise(fraud_lo)), 4)
    amount = F.when(storm, lognormal(i, s, 60, *p.amount_lognormal_storm)).otherwise(
        lognormal(i, s, 61, *p.amount_lognormal_base))
    return spine.select(
        i.alias("_sid"),
        _id("CLM-", i).alias("claim_id"),
        ref_id("POL-", n_policies, i, s, 1).alias("policy_id"),
        ref_id("PH-", n_policyholders, i, s, 2).alias("policyholder_id"),
        ref_id("VH-", n_vehicles, i, s, 3).alias("vehicle_id"),
        F.when(storm, F.lit("weather")).otherwise(chain(i, s, 21, p.claim_type_base)).alias("claim_type"),
        F.when(storm, _day(uniform(i, s, 24), p.storm_window[0], p.storm_window[1]))
         .otherwise(_day(uniform(i, s, 25), p.history_start, hist_end)).alias("claim_date"),
        F.when(storm, weighted(uniform(i, s, 30), p.region_weights_storm))
         .otherwise(weighted(uniform(i, s, 31), p.region_weights_base)).alias("incident_region"),
        F.concat(F.lit("City"), (F.floor(uniform(i, s, 32) * 5)).cast("int").cast("string")).alias("incident_city"),
        sev.alias("severity_label"), fraud.alias("fraud_risk_score"), amount.alias("claim_amount_gbp"),
        pick(i, s, 70, CLAIM_STATUSES).alias("claim_status"),
        F.when(storm, F.lit("Y")).otherwise(F.lit("N")).alias("is_storm_related"),
        F.lit(p.created_claims).alias("created_date"),
    )


def policyholders(spine: DataFrame, params: SynthParams = SynthParams(), id_col: str = "id") -> DataFrame:
    i, s = F.col(id_col), params.seed
    age_years = F.greatest(F.lit(17), F.least(F.lit(80), F.round(F.abs(normal(i, s, 100) * 10 + 45))))
    points = (F.when(uniform(i, s, 103) < 0.70, 0).when(uniform(i, s, 104) < 0.85, 3)
              .when(uniform(i, s, 105) < 0.95, 6).otherwise(F.floor(uniform(i, s, 106) * 3).cast("int") + 9))
    return spine.select(
        i.alias("_sid"),
        _id("PH-", i).alias("policyholder_id"),
        F.concat(F.lit("First"), (i % 97).cast("string")).alias("first_name"),
        F.concat(F.lit("Last"), (i % 89).cast("string")).alias("last_name"),
        F.date_sub(F.lit(date(2026, 2, 17)), (age_years * 365).cast("int")).alias("date_of_birth"),
        F.when(uniform(i, s, 101) < 0.50, "M").when(uniform(i, s, 102) < 0.97, "F").otherwise("Other").alias("gender"),
        F.concat(F.lit("user"), i.cast("string"), F.lit("@example.com")).alias("email"),
        weighted(uniform(i, s, 107), UK_REGION_WEIGHTS).alias("region"),
        F.concat(F.lit("City"), (F.floor(uniform(i, s, 108) * 5)).cast("int").cast("string")).alias("city"),
        F.concat(F.lit("PC"), (i % 900).cast("string")).alias("postcode"),
        points.alias("driving_points"),
        F.greatest(F.lit(1), F.abs(normal(i, s, 109) * 6 + 18).cast("int") + 2).alias("driving_years"),
        F.lit("2024-01-01").alias("created_date"),
    )


def vehicles(spine: DataFrame, n_policyholders: int, params: SynthParams = SynthParams(),
             id_col: str = "id") -> DataFrame:
    i, s = F.col(id_col), params.seed
    return spine.select(
        i.alias("_sid"),
        _id("VH-", i).alias("vehicle_id"), ref_id("PH-", n_policyholders, i, s, 200).alias("policyholder_id"),
        pick(i, s, 201, UK_MAKES).alias("make"), pick(i, s, 202, VEHICLE_TYPES).alias("vehicle_type"),
        (F.floor(uniform(i, s, 203) * 15) + 2010).cast("int").alias("year"),
        pick(i, s, 204, COLOURS).alias("colour"), lognormal(i, s, 205, 9.7, 0.5).alias("estimated_value"),
        (F.floor(uniform(i, s, 206) * 150000) + 5000).cast("int").alias("mileage"),
        F.lit("2024-01-01").alias("created_date"),
    )


def policies(spine: DataFrame, n_policyholders: int, n_vehicles: int, params: SynthParams = SynthParams(),
             id_col: str = "id") -> DataFrame:
    i, s = F.col(id_col), params.seed
    start = F.date_sub(F.lit(date(2026, 2, 17)), F.floor(uniform(i, s, 304) * 730).cast("int"))
    return spine.select(
        i.alias("_sid"),
        _id("POL-", i).alias("policy_id"), ref_id("PH-", n_policyholders, i, s, 300).alias("policyholder_id"),
        ref_id("VH-", n_vehicles, i, s, 301).alias("vehicle_id"),
        pick(i, s, 302, POLICY_TYPES).alias("policy_type"), pick(i, s, 303, COVERAGE_TYPES).alias("coverage_type"),
        lognormal(i, s, 305, 5.1, 0.3).alias("premium_monthly"), pick(i, s, 306, EXCESS_GBP).alias("excess"),
        lognormal(i, s, 307, 11.3, 0.4).alias("coverage_limit"), start.alias("start_date"),
        F.date_add(start, 365).alias("end_date"), pick(i, s, 308, POLICY_STATUSES).alias("status"),
        F.lit("2024-01-01").alias("created_date"),
    )


def incidents(spine: DataFrame, n_claims: int, params: SynthParams = SynthParams(), id_col: str = "id") -> DataFrame:
    i, s, p = F.col(id_col), params.seed, params
    return spine.select(
        i.alias("_sid"),
        _id("INC-", i).alias("incident_id"), ref_id("CLM-", n_claims, i, s, 400).alias("claim_id"),
        pick(i, s, 401, INCIDENT_TYPES).alias("incident_type"),
        _day(uniform(i, s, 402), p.history_start, p.storm_window[1]).alias("incident_date"),
        pick(i, s, 403, WEATHER).alias("weather_condition"), pick(i, s, 404, ROAD).alias("road_condition"),
        pick(i, s, 405, VISIBILITY).alias("visibility"),
        F.when(uniform(i, s, 406) < 0.70, "Y").otherwise("N").alias("police_report_filed"),
        (F.floor(uniform(i, s, 407) * 4) + 1).cast("int").alias("num_vehicles_involved"),
        F.floor(uniform(i, s, 408) * 5).cast("int").alias("witness_count"),
        F.lit("2026-02-17").alias("created_date"),
    )


def assessments(spine: DataFrame, n_claims: int, params: SynthParams = SynthParams(), id_col: str = "id") -> DataFrame:
    i, s, p = F.col(id_col), params.seed, params
    return spine.select(
        i.alias("_sid"),
        _id("ASS-", i).alias("assessment_id"), ref_id("CLM-", n_claims, i, s, 500).alias("claim_id"),
        ref_id("ASR-", N_ASSESSORS, i, s, 501, 4).alias("assessor_id"),
        F.when(uniform(i, s, 502) < 0.45, "junior").when(uniform(i, s, 503) < 0.80, "senior")
         .otherwise("specialist").alias("assessor_tier"),
        _day(uniform(i, s, 504), p.history_start, p.storm_window[1]).alias("assessment_date"),
        pick(i, s, 505, DAMAGE_CATEGORIES).alias("damage_category"),
        lognormal(i, s, 506, 7.4, 0.6).alias("estimated_repair_cost_gbp"),
        F.round(uniform(i, s, 507) * 40 + 2, 1).alias("labour_hours"),
        lognormal(i, s, 508, 6.4, 0.5).alias("parts_cost_gbp"),
        pick(i, s, 509, ACTIONS).alias("recommended_action"),
        F.lit("2026-02-17").alias("created_date"),
    )


# ── bad rows ──────────────────────────────────────────────────────────────────
# Per entity: (modulus, {residue: {column: replacement}}).  Residue 0 nulls the id;
# all other bad rows carry a ``BAD-`` id, so every bad row breaks the id rule.
BAD_RECIPES: dict[str, tuple[str, int, dict[int, dict[str, str | None]]]] = {
    "policyholders": ("policyholder_id", 3, {1: {"date_of_birth": "2021-06-15"}, 2: {"email": "invalidemail"}}),
    "vehicles": ("vehicle_id", 3, {1: {"year": "1850"}, 2: {"estimated_value": "-999.0"}}),
    "policies": ("policy_id", 3, {1: {"end_date": "2020-01-01"}, 2: {"premium_monthly": "-200.0"}}),
    "claims": ("claim_id", 4, {1: {"claim_amount_gbp": "-5000.0"}, 2: {"severity_label": "CATASTROPHIC"},
                               3: {"fraud_risk_score": "2.5"}}),
    "incidents": ("incident_id", 2, {1: {"claim_id": None}}),
    "claim_assessments": ("assessment_id", 3, {1: {"estimated_repair_cost_gbp": "-3000.0"},
                                               2: {"labour_hours": "-5.0"}}),
}


def bad_row_injection(entity: str, made: DataFrame, sid: str = "_sid") -> DataFrame:
    """Turn generated rows into bad rows: by ``sid % k`` the id is NULL (residue 0) or
    ``BAD-…`` and the recipe's field is corrupted, so every bad row breaks the id rule."""
    key, k, recipe = BAD_RECIPES[entity]
    i = F.col(sid)
    r = i % k
    cols = []
    for c in made.columns:
        if c == sid:
            continue
        v = F.col(c).cast("string")
        for res, repl in recipe.items():
            if c in repl:
                v = F.when(r == res, F.lit(repl[c]).cast("string")).otherwise(v)
        if c == key:
            v = F.when(r == 0, F.lit(None).cast("string")).otherwise(
                F.concat(F.lit("BAD-"), F.lpad((i + 1).cast("string"), 6, "0")))
        cols.append(v.alias(c))
    return made.select(*cols)


def synthetic_entities(spines: dict[str, DataFrame], params: SynthParams = SynthParams(),
                       counts: dict[str, int] | None = None, id_col: str = "id") -> dict[str, DataFrame]:
    """The six landing entities (all text, clean ∪ bad rows) from one id spine each.

    ``spines[e]`` holds integer ids in ``id_col``; a row becomes a bad row when its
    hash falls in the ``bad_ratio`` share.  ``counts`` are the id ranges foreign keys
    point into (defaults: the spine sizes, one small count job each).
    """
    n = counts or {e: df.count() for e, df in spines.items()}
    build = {
        "policyholders": lambda s: policyholders(s, params, id_col),
        "vehicles": lambda s: vehicles(s, n["policyholders"], params, id_col),
        "policies": lambda s: policies(s, n["policyholders"], n["vehicles"], params, id_col),
        "claims": lambda s: claims(s, n["policies"], n["policyholders"], n["vehicles"], params, id_col),
        "incidents": lambda s: incidents(s, n["claims"], params, id_col),
        "claim_assessments": lambda s: assessments(s, n["claims"], params, id_col),
    }
    out = {}
    for e, make in build.items():
        sp = spines[e].select(F.col(id_col).cast("bigint").alias(id_col))
        made = make(sp)
        is_bad = uniform(F.col("_sid"), params.seed, 900) < params.bad_ratio
        good = made.filter(~is_bad).drop("_sid")
        good = good.select(*[F.col(c).cast("string").alias(c) for c in good.columns])
        out[e] = good.unionByName(bad_row_injection(e, made.filter(is_bad)))
    return out


def shifted_batch(spines: dict[str, DataFrame], params: SynthParams = SHIFTED, **kw) -> dict[str, DataFrame]:
    """A validation batch from another distribution (fewer storm claims, flat severities)."""
    return synthetic_entities(spines, replace(params), **kw)

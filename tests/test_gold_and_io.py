"""Bands, star schema, incremental loads and as-of joins."""

import datetime as dt

from pyspark.sql import functions as F

from claimlake.functions.bands import AGE_BANDS, ladder, net_payout
from claimlake.operators import billing, star
from claimlake.plans.lake import Lake
from claimlake.sources import incremental

from .conftest import SF_SMALL


def test_ladder_sends_null_to_last_band_and_16_to_first(spark):
    df = spark.createDataFrame([(None,), (16,), (30,), (70,)], "age int")
    bands = [r[0] for r in df.select(ladder(F.col("age"), AGE_BANDS)).collect()]
    assert bands == ["65+", "17-24", "25-34", "65+"]


def test_net_payout_without_policy_is_zero(spark):
    df = spark.createDataFrame([(100.0, None), (100.0, 250.0), (1000.0, 250.0)], "a double, e double")
    assert [r[0] for r in df.select(net_payout(F.col("a"), F.col("e"))).collect()] == [0.0, 0.0, 750.0]


def test_dim_date_has_1825_days_ending_2027_12_30(spark):
    d = star.dim_date(spark)
    agg = d.agg(F.count(F.lit(1)), F.max("date"), F.min("day_of_week"), F.max("day_of_week")).collect()[0]
    assert (agg[0], agg[1], agg[2], agg[3]) == (1825, dt.date(2027, 12, 30), 1, 7)


def test_claim_features_fan_out_is_reported(spark):
    lk = Lake(spark, SF_SMALL)
    feats = lk.claim_features
    assert feats.count() > lk.silver("claims").count()          # incidents fan the claims out
    assert feats.select("claim_id").distinct().count() == lk.silver("claims").count()


def test_overlap_refresh_is_idempotent(spark):
    lk = Lake(spark, SF_SMALL)
    usage = lk.view("usage")
    once = incremental.overlap_refresh(usage.filter(F.col("usage_date") < "2024-01-20"), usage, "usage_date")
    twice = incremental.overlap_refresh(once, usage, "usage_date")
    assert once.count() == usage.count() == twice.count()
    assert once.exceptAll(twice).count() == 0


def test_overlap_refresh_first_run_is_full_load(spark):
    usage = Lake(spark, SF_SMALL).view("usage")
    assert incremental.overlap_refresh(None, usage, "usage_date").count() == usage.count()


def test_upsert_is_idempotent_and_updates(spark):
    fx = Lake(spark, SF_SMALL).fx
    upd = fx.filter(F.col("rate_date") >= "2024-01-15").withColumn("usd_to_gbp", F.col("usd_to_gbp") + 1)
    once = incremental.upsert_by_key(fx, upd, ["rate_date"])
    twice = incremental.upsert_by_key(once, upd, ["rate_date"])
    assert once.count() == fx.count()
    assert once.exceptAll(twice).count() == 0
    assert once.filter(F.col("usd_to_gbp") > 1.5).count() == upd.count()


def test_expanded_day_fx_join_equals_interval_join(spark):
    lk = Lake(spark, SF_SMALL)
    usage = lk.usage.select("usage_date", "usage_start_time", "sku_name")
    ours = billing.fx_asof_join(usage, lk.fx).select("usage_date", "usage_start_time", "sku_name", "usd_to_gbp")
    iv = billing.fx_intervals(lk.fx)
    naive = usage.join(iv, (F.col("usage_date") >= F.col("rate_date")) & (F.col("usage_date") < F.col("next_rate_date")),
                       "left").select("usage_date", "usage_start_time", "sku_name", "usd_to_gbp")
    assert ours.exceptAll(naive).count() == 0 and naive.exceptAll(ours).count() == 0


def test_fx_join_plans_as_hash_join(spark):
    lk = Lake(spark, SF_SMALL)
    plan = billing.fx_asof_join(lk.usage, lk.fx)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan


def test_dates_before_first_rate_use_default(spark):
    lk = Lake(spark, SF_SMALL)
    u = lk.priced_usage()
    early = u.filter(F.col("usage_date") < "2024-01-03").select("usd_to_gbp").distinct().collect()
    assert [r[0] for r in early] == [None]


def test_year_chunks_split_on_calendar_years(spark):
    w = spark.createDataFrame([(dt.date(2022, 6, 1), dt.date(2024, 3, 5))], "fetch_from date, fetch_to date")
    rows = [tuple(r) for r in incremental.year_chunks(w).orderBy("chunk_start").collect()]
    assert rows == [(dt.date(2022, 6, 1), dt.date(2022, 12, 31)), (dt.date(2023, 1, 1), dt.date(2023, 12, 31)),
                    (dt.date(2024, 1, 1), dt.date(2024, 3, 5))]


def test_price_join_no_match_costs_zero_and_overlaps_duplicate(spark):
    import datetime as dt

    usage = spark.createDataFrame(
        [(dt.datetime(2024, 1, 5), dt.date(2024, 1, 5), "a", "DBU", 2.0, "ORIGINAL"),
         (dt.datetime(2024, 1, 5), dt.date(2024, 1, 5), "zzz", "DBU", 2.0, "ORIGINAL")],
        "usage_start_time timestamp, usage_date date, sku_name string, usage_unit string, usage_quantity double, "
        "record_type string")
    prices = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1), None, 1.0), ("a", dt.datetime(2024, 1, 2), None, 3.0)],
        "sku_name string, price_start_time timestamp, price_end_time timestamp, p double").select(
        "sku_name", "price_start_time", "price_end_time",
        F.struct(F.struct(F.col("p").alias("default")).alias("effective_list")).alias("pricing"))
    fx = spark.createDataFrame([(dt.date(2024, 1, 1), 0.5)], "rate_date date, usd_to_gbp double")
    out = billing.priced_usage(usage, prices, fx).select("sku_name", "dbu_cost_gbp").collect()
    assert sorted((r[0], r[1]) for r in out) == [("a", 1.0), ("a", 3.0), ("zzz", 0.0)]


def test_offline_accuracy_counts_null_labels_as_wrong(spark):
    from claimlake.operators import model

    p = spark.createDataFrame([(0, 0), (1, 1), (None, 2), (2, 2)], "severity_encoded int, predicted_severity int")
    r = model.offline_accuracy(p).collect()[0]
    assert r["accuracy"] == 3 / 4 and r["accuracy_total_loss"] is None


def test_cluster_conf_sizes_shuffle_for_input():
    from claimlake.session import cluster_conf

    big = cluster_conf(100 * 2**40)
    assert int(big["spark.sql.shuffle.partitions"]) == 400_000
    assert int(cluster_conf(10 * 2**20)["spark.sql.shuffle.partitions"]) == 200


def test_repeated_ids_multiply_rows_only_after_the_claims_own_joins(spark):
    from claimlake.operators import features

    def side(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    claims = side("claim_id string, policy_id string, policyholder_id string, vehicle_id string, severity_label string, claim_type string, "
                  "claim_amount_gbp double, fraud_risk_score double, is_storm_related boolean",
                  ("C1", "P1", "H1", "V1", "minor", "fire", 1.0, 0.1, True), (None, "P1", None, "V2", "severe", "theft", 2.0, 0.2, None))
    policies = side("policy_id string, policy_type string, excess double, coverage_limit double, premium_monthly double",
                    ("P1", "Comprehensive", 1.0, 2.0, 3.0), ("P1", "Comprehensive", 4.0, 5.0, 6.0))
    holders = side("policyholder_id string, age int, driving_years int, driving_points int", ("H1", 30, 5, 0), (None, 1, 1, 1))
    vehicles = side("vehicle_id string, vehicle_type string, year int, estimated_value double, mileage int",
                    ("V1", "SUV", 2010, 1.0, 1), ("V1", "Estate", 2011, 1.0, 1), ("V1", "SUV", 2012, 1.0, 1))
    incidents = side("incident_id string, claim_id string, weather_condition string, road_condition string, visibility string, "
                     "num_vehicles_involved int, witness_count int, police_report_filed string",
                     ("I1", "C1", "flood", "icy", "poor", 1, 1, "Y"), ("I2", "C1", "clear", "dry", "good", 2, 0, "N"))
    assessed = side("claim_id string, assessment_id string, assessor_tier string, labour_hours double, estimated_repair_cost_gbp double",
                    ("C1", "A1", "junior", 1.0, 10.0), ("C1", "A2", "senior", 2.0, 20.0))
    for mode, of_c1 in (("first", 6), ("all", 12)):
        made = features.claim_features(claims, policies, holders, vehicles, incidents, assessed, incident_mode=mode)
        rows = made.collect()
        assert sum(r.claim_id == "C1" for r in rows) == of_c1 and sum(r.claim_id is None for r in rows) == 2
        assert {(r.f_num_assessments, r.f_ph_age) for r in rows} == {(2, 30), (0, None)}
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "vehicle_id" in next(line for line in plan.splitlines() if "Join" in line)   # the last join of all

"""Price join against plain Python and its spread of a hot SKU; forecasts in steps of days, weeks and months."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.operators import billing

PRICES = "sku_name string, price_start_time timestamp_ntz, price_end_time timestamp_ntz, pricing struct<effective_list: struct<default: string>>"


def _prices(spark, rows):
    return spark.createDataFrame([(s, a, b, ((p,),)) for s, a, b, p in rows], PRICES)


def test_price_join_equals_plain_python(spark):
    """Borders of validity, open ends, overlaps (rows double), gaps, null SKU, null time, prices before and after all usage."""
    d = datetime
    prices = [("a", d(2019, 1, 1), d(2024, 1, 10), "1"), ("a", d(2024, 1, 10), None, "2"), ("a", d(2024, 2, 1), d(2024, 2, 2), "3"),
              ("b", d(2024, 3, 1), d(2024, 3, 1), "4"), ("b", d(2030, 1, 1), None, "5"), ("c", d(2024, 1, 5), d(2024, 6, 1), "6"),
              (None, d(2020, 1, 1), None, "7")]
    usage = [(i, s, t) for i, (s, t) in enumerate(
        [(s, d(2024, 1, 1) + timedelta(hours=7 * i)) for i in range(300) for s in ("a", "b", "c", "z")]
        + [("a", d(2024, 1, 10)), ("a", d(2024, 2, 2)), (None, d(2024, 2, 2)), ("a", None)])]
    u = spark.createDataFrame(usage, "id long, sku_name string, usage_start_time timestamp_ntz")
    expect = []
    for i, s, t in usage:
        found = [float(p) for sku, a, b, p in prices if s is not None and sku == s and t is not None and a <= t and (b is None or t < b)]
        expect += [(i, p) for p in found or [None]]
    for how in ({}, {"bucket_days": 1}, {"span": (date(2024, 1, 1), date(2024, 12, 31))}):
        got = billing.price_asof_join(u, _prices(spark, prices), **how)
        assert got.columns == ["id", "sku_name", "usage_start_time", "list_price"]
        assert sorted(map(str, [(r.id, r.list_price) for r in got.collect()])) == sorted(map(str, expect))
    assert billing.price_asof_join(u.limit(0), _prices(spark, prices)).count() == 0
    assert billing.price_asof_join(u, _prices(spark, [])).filter("list_price IS NULL").count() == len(usage)


def test_hot_sku_spreads_over_tasks(spark):
    u = spark.range(20000).select(F.lit("hot").alias("sku_name"),
                                  F.expr("timestamp_ntz '2022-01-01' + make_dt_interval(0, id)").alias("usage_start_time"))
    prices = _prices(spark, [("hot", datetime(2020, 1, 1), None, "1.5")])
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        j = billing.price_asof_join(u, prices)
        tasks = j.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert "Broadcast" not in j._jdf.queryExecution().executedPlan().toString()
        assert len(tasks) > 3 and sum(r["count"] for r in tasks) == 20000
        assert max(r["count"] for r in tasks) < 15000
        assert j.filter("list_price = 1.5").count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was[1])


def _plain(points, step, season, ahead):
    x = np.array([step(d) for d, _ in points], float)
    y = np.array([v for _, v in points], float)
    b, a = np.polyfit(x - x.mean(), y, 1)
    a -= b * x.mean()
    residual: dict = {}
    for (d, v), at in zip(points, x, strict=True):
        residual.setdefault(season(d), []).append(v - (a + b * at))
    return [max(a + b * step(d) + (np.mean(residual[season(d)]) if season(d) in residual else 0), 0) for d in ahead]


GRAINS = {
    "DAY": (lambda i: date(2023, 11, 20) + timedelta(i), lambda d: d.toordinal(), lambda d: d.weekday(), 30),
    "WEEK": (lambda i: date(2023, 11, 20) + timedelta(7 * i), lambda d: d.toordinal() // 7, lambda d: d.isocalendar()[1], 12),
    "MONTH": (lambda i: date(2020 + (i + 4) // 12, (i + 4) % 12 + 1, 1), lambda d: d.year * 12 + d.month, lambda d: d.month, 3),
}


@pytest.mark.parametrize("grain", GRAINS)
def test_forecast_steps_by_its_grain(spark, grain):
    at, step, season, n = GRAINS[grain]
    points = [(at(i), 100 + 3 * i + 20 * np.sin(i) + 5 * (i % 4)) for i in range(40)]
    rows = [(k, d, float(v)) for k in ("k", None) for d, v in points]
    s = spark.createDataFrame(rows, "k string, ds date, y double")
    one = billing.usage_forecast(s.filter("k IS NOT NULL").drop("k"), grain=grain).orderBy("period").collect()
    if grain == "MONTH":    # 91 days reach the third month only from some months
        n = len([i for i in range(40, 50) if at(i) <= at(39) + timedelta(91)])
    ahead = [at(40 + i) for i in range(n)]
    assert [r.period for r in one] == ahead
    np.testing.assert_allclose([r.cost_gbp for r in one], _plain(points, step, season, ahead), rtol=1e-9)
    both = billing.usage_forecast(s, grain=grain, keys=["k"]).collect()
    assert sorted(r.cost_gbp for r in both) == pytest.approx(sorted([r.cost_gbp for r in one] * 2))
    later = billing.usage_forecast(s, grain=grain, keys=["k"], today=at(0), horizon_days=0).collect()
    assert later == []
    held = points[-5:]
    tested = billing.forecast_backtest(s, 5, grain=grain, keys=["k"]).collect()
    miss = np.mean(np.abs(np.array([v for _, v in held]) - _plain(points[:-5], step, season, [d for d, _ in held])))
    assert {r.k for r in tested} == {"k", None} and {r.periods for r in tested} == {5}
    for r in [*tested, *billing.forecast_backtest(s.filter("k = 'k'"), 5, grain=grain).collect()]:
        assert r.mean_abs_error == pytest.approx(miss) and r.relative_error == pytest.approx(miss / np.mean([v for _, v in held]))


def test_forecast_of_nothing_and_of_one_point(spark):
    s = spark.createDataFrame([("a", date(2024, 1, 1), 5.0)], "k string, ds date, y double")
    assert billing.usage_forecast(s.limit(0), keys=["k"]).count() == 0
    assert billing.usage_forecast(s.drop("k").limit(0)).count() == 0
    weeks = billing.usage_forecast(s, grain="WEEK", keys=["k"]).collect()
    assert len(weeks) == 12 and {r.cost_gbp for r in weeks} == {None}
    with pytest.raises(ValueError):
        billing.usage_forecast(s, grain="YEAR")

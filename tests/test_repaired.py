"""Cases that the derived fixture tables do not reach."""

from __future__ import annotations

import datetime as dt

from claimlake.operators import billing, perf
from claimlake.sources import incremental


def test_fx_rates_of_one_date_match_once(spark):
    d = dt.date
    fx = spark.createDataFrame([(d(2024, 1, 2), 0.70), (d(2024, 1, 5), 0.80), (d(2024, 1, 5), 0.81)],
                               "rate_date date, usd_to_gbp double")
    usage = spark.createDataFrame([(i, d(2024, 1, i)) for i in range(1, 8)], "i int, usage_date date")
    rows = billing.fx_asof_join(usage, fx).collect()
    assert sorted(r.i for r in rows) == list(range(1, 8))
    assert {r.i: r.usd_to_gbp for r in rows}[4] == 0.70


def test_overlap_refresh_keeps_rows_without_date(spark):
    d = dt.date
    target = spark.createDataFrame([(1, None), (2, d(2024, 1, 1)), (3, d(2024, 3, 1))], "i int, day date")
    source = spark.createDataFrame([(4, d(2024, 3, 1))], "i int, day date")
    assert sorted(r.i for r in incremental.overlap_refresh(target, source, "day", days=7).collect()) == [1, 2, 4]


def test_profile_operators_all_nodes_and_fallbacks(spark):
    many = '{"nodes": [' + ", ".join('{"node_name": "n%d", "duration_ms": %d}' % (i, i) for i in range(25)) + "]}"
    rows = [("a", many), ("b", '{"nodes": [], "plan_summary": {"nodes": [{"node_name": "", "name": "Scan"}]}}')]
    out = perf.profile_operators(spark.createDataFrame(rows, "statement_id string, profile_json string")).collect()
    assert sum(r.statement_id == "a" for r in out) == 25
    assert [r.operator for r in out if r.statement_id == "b"] == ["Scan"]


def test_forecast_without_trend_is_null(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, 1), 5.0)], "ds date, y double")
    assert {r.cost_gbp for r in billing.usage_forecast(s, horizon_days=3).collect()} == {None}

"""Registered queries: billing (as-of price/FX joins, cost reports) and run-time analytics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.bands import money_sum
from ..operators import billing, perf
from .oracle_sql import cte
from .registry import q, register

START, END = date(2024, 1, 2), date(2024, 1, 28)
S_SQL, E_SQL = "DATE '2024-01-02'", "DATE '2024-01-28'"

def _msum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,10))) AS DOUBLE)"


def _mavg(x: str) -> str:
    return f"({_msum(x)} / COUNT({x}))"


# ── oracle CTEs ───────────────────────────────────────────────────────────────
cte("fx_iv", """
SELECT rate_date, usd_to_gbp,
  coalesce(lead(rate_date) OVER (ORDER BY rate_date), CAST(rate_date + 365 AS DATE)) AS next_rate_date
FROM fx_fx_rates_usd_gbp""", "fx_fx_rates_usd_gbp")

cte("usage_priced_all", """
SELECT u.*, CAST(p.price_default AS DOUBLE) AS list_price
FROM fx_usage u LEFT JOIN fx_list_prices p
  ON u.sku_name = p.sku_name AND u.usage_start_time >= p.price_start_time
 AND (p.price_end_time IS NULL OR u.usage_start_time < p.price_end_time)""", "fx_usage", "fx_list_prices")

cte("priced", f"""
SELECT u.*, fx.usd_to_gbp,
  CASE WHEN u.usage_unit = 'DBU'
       THEN CAST(u.usage_quantity AS DOUBLE) * coalesce(u.list_price, 0.0) * coalesce(fx.usd_to_gbp, 0.79)
       ELSE 0.0 END AS dbu_cost_gbp
FROM usage_priced_all u LEFT JOIN fx_iv fx ON u.usage_date >= fx.rate_date AND u.usage_date < fx.next_rate_date
WHERE u.record_type = 'ORIGINAL' AND u.usage_date BETWEEN {S_SQL} AND {E_SQL}""", "usage_priced_all", "fx_iv")

cte("pipelines", """
SELECT pipeline_id, arg_max(pipeline_name, period_start_time) AS name FROM fx_run_timeline GROUP BY pipeline_id""",
    "fx_run_timeline")

cte("base_cost", f"SELECT usage_date, {_msum('dbu_cost_gbp')} AS day_cost FROM priced GROUP BY usage_date", "priced")

cte("qh", """
SELECT *, start_time + to_microseconds(CAST(round(duration_s * 1000000) AS BIGINT)) AS end_time
FROM fx_query_history""", "fx_query_history")

cte("timeline", """
SELECT *, period_start_time + to_microseconds(CAST(round(duration_s * 1000000) AS BIGINT)) AS period_end_time
FROM fx_run_timeline""", "fx_run_timeline")

cte("fc_series", f"""
SELECT ds, y, CAST(date_diff('day', DATE '1970-01-01', ds) AS DOUBLE) AS x
FROM (SELECT usage_date AS ds, {_msum('dbu_cost_gbp')} AS y FROM priced GROUP BY usage_date)""", "priced")
cte("fc_fit", "SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, MAX(ds) AS last FROM fc_series", "fc_series")
cte("fc_resid", "SELECT dayofweek(ds) AS dow, AVG(y - (a + b * x)) AS r FROM fc_series, fc_fit GROUP BY 1",
    "fc_series", "fc_fit")
cte("fc_horizon", "SELECT CAST(last + CAST(i AS INTEGER) AS DATE) AS period, a, b FROM fc_fit, range(1, 31) t(i) WHERE last + CAST(i AS INTEGER) <= DATE '2024-01-28' + 30",
    "fc_fit")

cte("fc_weekly", f"""SELECT CAST(date_trunc('week', usage_date) AS DATE) AS ds, {_msum('dbu_cost_gbp')} AS y FROM priced GROUP BY 1""",
    "priced")

cte("fc_monthly", f"""SELECT claim_type, CAST(date_trunc('month', claim_date) AS DATE) AS ds, {_msum('claim_amount_gbp')} AS y
FROM s_claims GROUP BY 1, 2""", "s_claims")

_MONTHS = "((year({d}) - 1970) * 12 + month({d}) - 1)"


def _forecast_sql(series: str, step: str, first_day: str, season: str, end: str, key: str = "NULL") -> str:
    named = f"h.k AS {key}, " if key != "NULL" else ""
    return f"""WITH s AS (SELECT {key} AS k, ds, y, {step.format(d="ds")} AS x FROM {series}),
fit AS (SELECT k, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, MAX(x) AS last, MAX(ds) AS until FROM s GROUP BY k),
res AS (SELECT s.k, {season}(ds) AS se, AVG(y - (a + b * x)) AS r FROM s JOIN fit ON s.k IS NOT DISTINCT FROM fit.k GROUP BY 1, 2),
h AS (SELECT k, a, b, unnest(range(last + 1, {step.format(d=f"CAST({end} AS DATE)")} + 1)) AS x FROM fit),
d AS (SELECT *, {first_day} AS period FROM h)
SELECT {named}period, CASE WHEN a IS NOT NULL THEN greatest(a + b * x + coalesce(r, 0.0), 0.0) END AS cost_gbp
FROM d h LEFT JOIN res ON h.k IS NOT DISTINCT FROM res.k AND {season}(period) = se"""


def _claimed_monthly(lk):
    """(claim_type, ds, y): claimed amount of every month."""
    return (lk.silver("claims").groupBy("claim_type", F.trunc("claim_date", "month").alias("ds"))
            .agg(money_sum(F.col("claim_amount_gbp")).alias("y")))


_SECS = "(floor(epoch({e})) - floor(epoch({s})))"

cte("pipeline_durations", f"""
SELECT CAST(period_start_time AS DATE) AS run_date, coalesce(pipeline_name, pipeline_id) AS pipeline,
  result_state, trigger_type,
  round({_SECS.format(e='period_end_time', s='period_start_time')} / 60.0, 1) AS duration_min
FROM timeline WHERE CAST(period_start_time AS DATE) BETWEEN {S_SQL} AND {E_SQL} AND period_end_time IS NOT NULL""",
    "timeline")

cte("task_durations", f"""
SELECT CAST(period_start_time AS DATE) AS run_date, job_id, task_key, result_state,
  round({_SECS.format(e='period_end_time', s='period_start_time')} / 60.0, 1) AS duration_min
FROM timeline WHERE CAST(period_start_time AS DATE) BETWEEN {S_SQL} AND {E_SQL} AND period_end_time IS NOT NULL""",
    "timeline")


# ── 2.7 billing ───────────────────────────────────────────────────────────────
register(
    "price_asof_join",
    lambda lk: billing.price_asof_join(lk.usage, lk.list_prices).select(
        "record_type", "usage_unit", "usage_date", "usage_start_time", "sku_name", "usage_quantity",
        "billing_origin_product", "list_price"),
    q("SELECT record_type, usage_unit, usage_date, usage_start_time, sku_name, usage_quantity, "
      "billing_origin_product, list_price FROM usage_priced_all", "usage_priced_all"),
)
register(
    "fx_intervals",
    lambda lk: billing.fx_intervals(lk.fx),
    q("SELECT * FROM fx_iv", "fx_iv"),
)
register(
    "fx_asof_join",
    lambda lk: billing.fx_asof_join(lk.usage, lk.fx).select("usage_date", "usage_start_time", "sku_name",
                                                            "usd_to_gbp"),
    q("""SELECT u.usage_date, u.usage_start_time, u.sku_name, fx.usd_to_gbp FROM fx_usage u
LEFT JOIN fx_iv fx ON u.usage_date >= fx.rate_date AND u.usage_date < fx.next_rate_date""", "fx_usage", "fx_iv"),
)
register(
    "pipeline_name_join",
    lambda lk: billing.pipeline_name_join(lk.usage, lk.pipelines).select(
        "usage_start_time", "sku_name", F.col("usage_metadata.dlt_pipeline_id").alias("dlt_pipeline_id"),
        "pipeline_name"),
    q("""SELECT u.usage_start_time, u.sku_name, u.dlt_pipeline_id, pl.name AS pipeline_name
FROM fx_usage u LEFT JOIN pipelines pl ON u.dlt_pipeline_id = pl.pipeline_id""", "fx_usage", "pipelines"),
)
register(
    "replace_dedup",
    lambda lk: lk.pipelines,
    q("SELECT * FROM pipelines", "pipelines"),
)
register(
    "usage_cost_gbp",
    lambda lk: lk.priced_usage(START, END).select("usage_date", "usage_start_time", "sku_name", "usage_unit",
                                                  "list_price", "usd_to_gbp", "dbu_cost_gbp"),
    q("SELECT usage_date, usage_start_time, sku_name, usage_unit, list_price, usd_to_gbp, dbu_cost_gbp FROM priced",
      "priced"),
)
register(
    "billing_kpis",
    lambda lk: billing.billing_kpis(lk.priced_usage(START, END)),
    q(f"""SELECT round({_msum('dbu_cost_gbp')}, 2) AS total_cost_gbp,
  round({_msum("CASE WHEN usage_unit = 'DBU' THEN CAST(usage_quantity AS DOUBLE) ELSE 0.0 END")}, 2) AS total_dbus,
  COUNT(DISTINCT usage_date) AS active_days,
  strftime(MIN(usage_date), '%b %Y') || ' to ' || strftime(MAX(usage_date), '%b %Y') AS coverage
FROM priced""", "priced"),
)
register(
    "usage_over_time",
    lambda lk: billing.usage_over_time(lk.priced_usage(START, END), "WEEK"),
    q(f"""SELECT date_trunc('week', usage_date) AS period, billing_origin_product, round({_msum('dbu_cost_gbp')}, 4) AS cost_gbp
FROM priced GROUP BY 1, 2""", "priced"),
)
register(
    "usage_total_over_time",
    lambda lk: billing.usage_total_over_time(lk.priced_usage(START, END), "DAY"),
    q(f"""SELECT period, {_msum('cost_gbp')} AS cost_gbp FROM (
  SELECT date_trunc('day', usage_date) AS period, billing_origin_product, round({_msum('dbu_cost_gbp')}, 4) AS cost_gbp
  FROM priced GROUP BY 1, 2) GROUP BY period""", "priced"),
)
register(
    "usage_forecast",
    lambda lk: billing.usage_forecast(billing.cost_series(lk.priced_usage(START, END)), today=END),
    q("""SELECT period, greatest(a + b * CAST(date_diff('day', DATE '1970-01-01', period) AS DOUBLE) + coalesce(r, 0.0), 0.0)
  AS cost_gbp
FROM fc_horizon LEFT JOIN fc_resid ON dayofweek(period) = dow""", "fc_horizon", "fc_resid"),
    rounded=("cost_gbp",),
)
register(
    "usage_forecast_weekly",
    lambda lk: billing.usage_forecast(billing.cost_series(lk.priced_usage(START, END), "WEEK"), grain="WEEK", today=END),
    q(_forecast_sql("fc_weekly", "date_diff('day', DATE '1970-01-05', {d}) // 7", "CAST(DATE '1970-01-05' + CAST(x * 7 AS INTEGER) AS DATE)",
                    "weekofyear", f"{E_SQL} + 84"), "fc_weekly"),
    rounded=("cost_gbp",),
)
register(
    "claims_forecast_monthly",
    lambda lk: billing.usage_forecast(_claimed_monthly(lk), grain="MONTH", keys=["claim_type"]),
    q(_forecast_sql("fc_monthly", _MONTHS, "make_date(1970 + x // 12, x % 12 + 1, 1)", "month", "until + 91", "claim_type"),
      "fc_monthly"),
    rounded=("cost_gbp",),
)
register(
    "forecast_backtest",
    lambda lk: billing.forecast_backtest(_claimed_monthly(lk), 12, grain="MONTH", keys=["claim_type"]),
    q(f"""WITH s AS (SELECT claim_type, ds, y, {_MONTHS.format(d="ds")} AS x, MAX({_MONTHS.format(d="ds")}) OVER (PARTITION BY claim_type) - 12 AS cut
  FROM fc_monthly),
fit AS (SELECT claim_type, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM s WHERE x <= cut GROUP BY 1),
res AS (SELECT s.claim_type, month(ds) AS se, AVG(y - (a + b * x)) AS r FROM s JOIN fit ON s.claim_type IS NOT DISTINCT FROM fit.claim_type
  WHERE x <= cut GROUP BY 1, 2),
p AS (SELECT s.claim_type, y, CASE WHEN a IS NOT NULL THEN greatest(a + b * x + coalesce(r, 0.0), 0.0) END AS f
  FROM s LEFT JOIN fit ON s.claim_type IS NOT DISTINCT FROM fit.claim_type
  LEFT JOIN res ON s.claim_type IS NOT DISTINCT FROM res.claim_type AND month(ds) = se WHERE x > cut)
SELECT claim_type, COUNT(y) AS periods, AVG(abs(y - f)) AS mean_abs_error, AVG(abs(y - f)) / nullif(AVG(y), 0.0) AS relative_error
FROM p GROUP BY 1""", "fc_monthly"),
    rounded=("mean_abs_error", "relative_error"),
)
register(
    "cost_by_product",
    lambda lk: billing.cost_by_product(lk.priced_usage(START, END)),
    q(f"""SELECT billing_origin_product, round({_msum('dbu_cost_gbp')}, 2) AS cost_gbp FROM priced
GROUP BY 1 HAVING round({_msum('dbu_cost_gbp')}, 2) > 0""", "priced"),
)
register(
    "avg_cost_by_period",
    lambda lk: billing.avg_cost_by_period(lk.priced_usage(START, END)),
    q(f"""SELECT 'Daily' AS period, round({_mavg('day_cost')}, 2) AS avg_cost_gbp FROM base_cost
UNION ALL SELECT 'Weekly', round({_mavg('c')}, 2) FROM (SELECT {_msum('day_cost')} AS c FROM base_cost GROUP BY date_trunc('week', usage_date))
UNION ALL SELECT 'Monthly', round({_mavg('c')}, 2) FROM (SELECT {_msum('day_cost')} AS c FROM base_cost GROUP BY date_trunc('month', usage_date))""",
      "base_cost"),
)
register(
    "top_workloads",
    lambda lk: billing.top_workloads(lk.priced_usage(START, END), lk.pipelines, 10),
    q(f"""SELECT CAST(row_number() OVER (ORDER BY _dbus DESC, workload, product) AS INTEGER) AS rank, workload, product,
  round(_dbus, 4) AS total_dbus, cost_gbp FROM (
  SELECT coalesce(u.job_name, u.notebook_path, pl.name, u.dlt_pipeline_id) AS workload, u.billing_origin_product AS product,
    {_msum('CAST(u.usage_quantity AS DOUBLE)')} AS _dbus, round({_msum('u.dbu_cost_gbp')}, 2) AS cost_gbp
  FROM priced u LEFT JOIN pipelines pl ON u.dlt_pipeline_id = pl.pipeline_id
  WHERE u.usage_unit = 'DBU' AND coalesce(u.job_name, u.notebook_path, u.dlt_pipeline_id) IS NOT NULL
  GROUP BY 1, 2) ORDER BY _dbus DESC, workload, product LIMIT 10""", "priced", "pipelines"),
)

# ── 2.7 performance ───────────────────────────────────────────────────────────
register(
    "slow_queries",
    lambda lk: perf.slow_queries(lk.query_history, START, END, 10),
    q(f"""SELECT statement_id, CAST({_SECS.format(e='end_time', s='start_time')} AS BIGINT) AS duration_s, executed_by,
  statement_text, left(statement_text, 120) AS query_preview
FROM qh WHERE CAST(start_time AS DATE) BETWEEN {S_SQL} AND {E_SQL} AND error_message IS NULL AND end_time IS NOT NULL
ORDER BY duration_s DESC, statement_id LIMIT 10""", "qh"),
)
register(
    "query_metrics",
    lambda lk: perf.query_metrics(lk.query_history, "1234"),
    q("""SELECT coalesce(read_rows, 0) AS read_rows, coalesce(read_bytes, 0) AS read_bytes,
  coalesce(produced_rows, 0) AS produced_rows, from_result_cache FROM qh WHERE statement_id = '1234' LIMIT 1""", "qh"),
)
register(
    "perf_advice",
    lambda lk: perf.perf_advice(lk.query_history),
    q("""SELECT statement_id, read_mb, filter_pct,
  CASE WHEN read_bytes IS NULL AND read_rows IS NULL AND produced_rows IS NULL THEN 'no_metrics'
       WHEN coalesce(from_result_cache, FALSE) THEN 'result_cache_hit'
       WHEN read_mb > 500 AND filter_pct < 10 THEN 'zorder_filter_columns'
       WHEN read_mb > 1000 THEN 'optimize_compact_files'
       WHEN filter_pct < 1 THEN 'zorder_or_partition' ELSE 'ok' END AS advice
FROM (SELECT *, coalesce(read_bytes, 0) / 1e6 AS read_mb,
        coalesce(produced_rows, 0) / greatest(coalesce(read_rows, 0), 1) * 100 AS filter_pct FROM qh)""", "qh"),
)
register(
    "profile_operators",
    lambda lk: perf.profile_operators(lk.view("query_profiles"), "profile_json"),
    q("""SELECT *, round(duration_s / NULLIF(SUM(duration_s) OVER (PARTITION BY statement_id), 0) * 100, 1) AS pct,
  CAST(row_number() OVER (PARTITION BY statement_id ORDER BY duration_s DESC, node_pos) AS INTEGER) AS rank
FROM (
  SELECT CAST(event_id AS VARCHAR) AS statement_id, 0 AS node_pos, 'Scan' AS operator,
    round(event_id * 1000003 / 1e9, 3) AS duration_s, CAST(event_id % 500 AS BIGINT) AS rows_out, CAST(0 AS DOUBLE) AS size_mb
  FROM events
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), 1, 'Filter', round((event_id % 700) / 1e3, 3), CAST(0 AS BIGINT), CAST(0 AS DOUBLE) FROM events)
"""),
)
register(
    "pipeline_durations",
    lambda lk: perf.pipeline_durations(lk.run_timeline, START, END),
    q("SELECT * FROM pipeline_durations", "pipeline_durations"),
)
register(
    "pipeline_duration_stats",
    lambda lk: perf.pipeline_duration_stats(perf.pipeline_durations(lk.run_timeline, START, END)),
    q("""SELECT pipeline, round(AVG(duration_min), 1) AS avg_min, COUNT(duration_min) AS runs,
  round(quantile_cont(duration_min, 0.95), 1) AS p95_min
FROM pipeline_durations WHERE result_state = 'COMPLETED' GROUP BY pipeline""", "pipeline_durations"),
)
register(
    "task_durations",
    lambda lk: perf.task_durations(lk.run_timeline, START, END),
    q("SELECT * FROM task_durations", "task_durations"),
)
register(
    "task_heatmap",
    lambda lk: perf.task_heatmap_long(perf.task_durations(lk.run_timeline, START, END)),
    q("""SELECT task_key, run_date, round(AVG(duration_min), 1) AS duration_min FROM task_durations
WHERE result_state = 'SUCCESS' GROUP BY 1, 2""", "task_durations"),
)

_DAYS = [date.fromordinal(START.toordinal() + i) for i in range((END - START).days + 1)]
register(
    "task_heatmap_grid",
    lambda lk: perf.task_heatmap(perf.task_durations(lk.run_timeline, START, END), _DAYS),
    q("SELECT task_key, " + ", ".join(
        f"max(CASE WHEN run_date = DATE '{d}' THEN duration_min END) AS \"{d}\"" for d in _DAYS)
      + """ FROM (SELECT task_key, run_date, round(AVG(duration_min), 1) AS duration_min FROM task_durations
WHERE result_state = 'SUCCESS' GROUP BY 1, 2) GROUP BY task_key""", "task_durations"),
)

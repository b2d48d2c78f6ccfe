"""Billing analytics: as-of price and FX conversion, cost KPIs, workloads, forecast.

Scale notes
-----------
* ``usage`` is the big, date-partitioned log; FX rates have at most a row per calendar
  day and are broadcast; prices grow with the SKU catalogue and are not.
* The FX interval join (``date ∈ [rate_date, next_rate_date)``) would plan as a
  nested-loop join.  Expanding each interval to its days turns it into an
  equi-join on the day (one row per calendar day, bounded by the history
  length), so it plans as a hash join.
* The price join is an equi-join on (SKU, stretch of days) with the validity window
  as residual condition, so a hot SKU spreads over the stretches.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import money_avg, money_sum

DEFAULT_FX = 0.79           # rate used when no FX row covers the usage date
LAST_RATE_DAYS = 365        # validity of the newest rate
GRAINS = ("DAY", "WEEK", "MONTH")
PRICE_BUCKET_DAYS = 28      # stretch of days by which the price join deals out a SKU
FORECAST_HORIZON_DAYS = {"DAY": 30, "WEEK": 84, "MONTH": 91}


# ── reference tables ──────────────────────────────────────────────────────────
def fx_intervals(fx: DataFrame, last_days: int = LAST_RATE_DAYS) -> DataFrame:
    """Each rate is valid until the next rate date; the newest for ``last_days`` days.

    The window has no partition key: the table has one row per business day
    (about 260 rows a year), so a single ordered partition is cheap.
    """
    w = Window.orderBy("rate_date")
    return fx.select(
        "rate_date", "usd_to_gbp",
        F.coalesce(F.lead("rate_date").over(w), F.date_add("rate_date", last_days)).alias("next_rate_date"),
    )


def fx_daily(fx: DataFrame, last_days: int = LAST_RATE_DAYS) -> DataFrame:
    """One row per calendar day covered by a rate: (fx_date, usd_to_gbp)."""
    # Of several rates of one date only the last has a non-empty interval.
    iv = fx_intervals(fx, last_days).filter(F.col("next_rate_date") > F.col("rate_date"))
    return iv.select(
        F.explode(F.sequence("rate_date", F.date_sub("next_rate_date", 1))).alias("fx_date"), "usd_to_gbp")


def price_asof_join(usage: DataFrame, prices: DataFrame, bucket_days: int = PRICE_BUCKET_DAYS,
                    span: tuple[date, date] | None = None) -> DataFrame:
    """Left join usage to the list price valid at ``usage_start_time`` (open end allowed).

    An equi-join on (SKU, stretch of ``bucket_days`` days): a price stands once in every stretch that its validity meets,
    a usage row lies in one, so nothing is joined twice and a SKU that holds a third of all usage is dealt out by time.
    Price rows are made only for the stretches of ``span`` (first and last day of usage; one pass over the usage times
    finds it if it is not given; usage outside a given span finds no price).  No size is guessed and no row counted: the
    optimizer broadcasts the prices if they are small, and splits a skewed stretch of the usage otherwise.

    No match ⇒ NULL price (cost 0), so also for a usage row without SKU or time; overlapping price rows duplicate usage
    rows, as in the reference (no currency filter).
    """
    t = F.col("usage_start_time")

    def bucket(at: Column) -> Column:
        return F.floor(F.unix_date(at.cast("date")) / bucket_days)

    if span:
        first, last = (F.lit(d) for d in span)
    else:
        first, last = (usage.agg(f(t)).scalar() for f in (F.min, F.max))
    low = F.greatest(bucket(F.col("price_start_time")), bucket(first))
    high = F.least(bucket(F.col("price_end_time")), bucket(last))
    p = prices.select(
        F.col("sku_name").alias("_p_sku"), "price_start_time", "price_end_time",
        F.col("pricing.effective_list.default").cast("double").alias("list_price"),
        F.explode(F.when(low <= high, F.sequence(low, high))).alias("_p_bucket"))
    cond = ((F.col("sku_name") == F.col("_p_sku")) & (bucket(t) == F.col("_p_bucket")) & (t >= F.col("price_start_time"))
            & (F.col("price_end_time").isNull() | (t < F.col("price_end_time"))))
    return usage.join(p, cond, "left").drop("_p_sku", "_p_bucket", "price_start_time", "price_end_time")


def fx_asof_join(usage: DataFrame, fx: DataFrame, last_days: int = LAST_RATE_DAYS) -> DataFrame:
    """Left join usage to the FX rate whose interval contains ``usage_date``.

    The intervals do not overlap, so the broadcast side has at most one row of two fields for a day of the calendar
    between the first rate and ``last_days`` after the last one, however much usage there is."""
    return (usage.join(F.broadcast(fx_daily(fx, last_days)), F.col("usage_date") == F.col("fx_date"), "left").drop("fx_date"))


def pipeline_name_join(usage: DataFrame, pipelines: DataFrame) -> DataFrame:
    """Left join to pipeline names on the nested ``usage_metadata.dlt_pipeline_id``."""
    pl = pipelines.select(F.col("pipeline_id").alias("_pl_id"), F.col("name").alias("pipeline_name"))
    return (usage.join(pl, F.col("usage_metadata.dlt_pipeline_id") == F.col("_pl_id"), "left")
            .drop("_pl_id"))


def usage_cost_gbp(qty: Column, price: Column, fx: Column, default_fx: float = DEFAULT_FX) -> Column:
    """``quantity × coalesce(price, 0) × coalesce(fx, default)``."""
    return qty.cast("double") * F.coalesce(price, F.lit(0.0)) * F.coalesce(fx, F.lit(default_fx))


def priced_usage(usage: DataFrame, prices: DataFrame, fx: DataFrame, start: date | None = None,
                 end: date | None = None) -> DataFrame:
    """ORIGINAL usage records in [start, end] with list price, FX rate and GBP cost of DBU rows."""
    u = usage.filter(F.col("record_type") == "ORIGINAL")
    if start is not None and end is not None:
        u = u.filter(F.col("usage_date").between(F.lit(start), F.lit(end)))
    priced = price_asof_join(u, prices, span=None if start is None or end is None else (start, end))
    j = fx_asof_join(priced, fx)
    cost = usage_cost_gbp(F.col("usage_quantity"), F.col("list_price"), F.col("usd_to_gbp"))
    return j.withColumn("dbu_cost_gbp", F.when(F.col("usage_unit") == "DBU", cost).otherwise(F.lit(0.0)))


# ── reports over priced usage ────────────────────────────────────────────────
def billing_kpis(u: DataFrame) -> DataFrame:
    d = F.col("usage_date")
    return u.agg(
        F.round(money_sum(F.col("dbu_cost_gbp")), 2).alias("total_cost_gbp"),
        F.round(money_sum(F.when(F.col("usage_unit") == "DBU", F.col("usage_quantity").cast("double"))
                          .otherwise(F.lit(0.0))), 2).alias("total_dbus"),
        F.countDistinct(d).alias("active_days"),
        F.concat(F.date_format(F.min(d), "MMM yyyy"), F.lit(" to "),
                 F.date_format(F.max(d), "MMM yyyy")).alias("coverage"),
    )


def _period(grain: str) -> Column:
    if grain.upper() not in GRAINS:
        raise ValueError(grain)
    return F.date_trunc(grain.upper(), F.col("usage_date"))


def usage_over_time(u: DataFrame, grain: str = "DAY") -> DataFrame:
    return (u.groupBy(_period(grain).alias("period"), "billing_origin_product")
            .agg(F.round(money_sum(F.col("dbu_cost_gbp")), 4).alias("cost_gbp")))


def usage_total_over_time(u: DataFrame, grain: str = "DAY") -> DataFrame:
    """Sum over products of the per-product (rounded) period cost, as the app does."""
    return usage_over_time(u, grain).groupBy("period").agg(money_sum(F.col("cost_gbp")).alias("cost_gbp"))


def cost_by_product(u: DataFrame) -> DataFrame:
    return (u.groupBy("billing_origin_product").agg(F.round(money_sum(F.col("dbu_cost_gbp")), 2).alias("cost_gbp"))
            .filter(F.col("cost_gbp") > 0).orderBy(F.col("cost_gbp").desc(), "billing_origin_product"))


def avg_cost_by_period(u: DataFrame) -> DataFrame:
    """Average daily, weekly and monthly cost over the per-day totals (one shared base)."""
    base = u.groupBy("usage_date").agg(money_sum(F.col("dbu_cost_gbp")).alias("day_cost"))
    daily = base.agg(F.round(money_avg(F.col("day_cost")), 2).alias("avg_cost_gbp")).select(
        F.lit("Daily").alias("period"), "avg_cost_gbp")
    out = daily
    for label, unit in (("Weekly", "WEEK"), ("Monthly", "MONTH")):
        per = (base.groupBy(F.date_trunc(unit, F.col("usage_date"))).agg(money_sum(F.col("day_cost")).alias("c"))
               .agg(F.round(money_avg(F.col("c")), 2).alias("avg_cost_gbp"))
               .select(F.lit(label).alias("period"), "avg_cost_gbp"))
        out = out.unionByName(per)
    return out


def top_workloads(u: DataFrame, pipelines: DataFrame, n: int = 10) -> DataFrame:
    """Top-n workloads by DBUs.  Aggregate, take the n largest (TakeOrderedAndProject,
    no global sort), then number the n rows — the window sees only n rows."""
    m = "usage_metadata"
    named = pipeline_name_join(u.filter(F.col("usage_unit") == "DBU"), pipelines)
    named = named.filter(F.coalesce(F.col(f"{m}.job_name"), F.col(f"{m}.notebook_path"),
                                    F.col(f"{m}.dlt_pipeline_id")).isNotNull())
    workload = F.coalesce(F.col(f"{m}.job_name"), F.col(f"{m}.notebook_path"), F.col("pipeline_name"),
                          F.col(f"{m}.dlt_pipeline_id"))
    agg = (named.groupBy(workload.alias("workload"), F.col("billing_origin_product").alias("product"))
           .agg(money_sum(F.col("usage_quantity").cast("double")).alias("_dbus"),
                F.round(money_sum(F.col("dbu_cost_gbp")), 2).alias("cost_gbp")))
    top = agg.orderBy(F.col("_dbus").desc(), "workload", "product").limit(n)
    w = Window.orderBy(F.col("_dbus").desc(), "workload", "product")
    return top.select(F.row_number().over(w).alias("rank"), "workload", "product",
                      F.round("_dbus", 4).alias("total_dbus"), "cost_gbp")


def _step(day: Column, grain: str) -> Column:
    """Number of a period since the first one of 1970 (weeks begin on Mondays)."""
    if grain == "MONTH":
        return ((F.year(day) - 1970) * 12 + F.month(day) - 1).cast("long")
    if grain == "WEEK":
        return F.floor(F.datediff(day, F.lit(date(1970, 1, 5))) / 7)
    return F.datediff(day, F.lit(date(1970, 1, 1))).cast("long")


def _first_day(step: Column, grain: str) -> Column:
    """First day of a period, from its number."""
    if grain == "MONTH":
        return F.add_months(F.lit(date(1970, 1, 1)), step.cast("int"))
    if grain == "WEEK":
        return F.date_add(F.lit(date(1970, 1, 5)), (step * 7).cast("int"))
    return F.date_add(F.lit(date(1970, 1, 1)), step.cast("int"))


#: What repeats: the weekdays of daily series, the weeks or months of a year otherwise.
SEASONS = {"DAY": F.dayofweek, "WEEK": F.weekofyear, "MONTH": F.month}


def _fitted(s: DataFrame, by: Sequence[str], grain: str) -> tuple[DataFrame, DataFrame]:
    """Of points (_k, _day, _x, _y): trend (_a, _b), last period and day of every series; mean residual (_r) by season (_s).
    ``by`` is ["_k"], or empty for a single series, whose trend is then two scalar subqueries and no join."""
    x = F.col("_x").cast("double")
    fit = s.groupBy(*by).agg(F.regr_slope("_y", x).alias("_b"), F.regr_intercept("_y", x).alias("_a"),
                             F.max("_x").alias("_last"), F.max("_day").alias("_until"))
    if by:
        on = s.join(fit.select("_k", "_a", "_b"), "_k")
    else:
        on = s.withColumns({"_a": fit.select("_a").scalar(), "_b": fit.select("_b").scalar()})
    residual = on.groupBy(*by, SEASONS[grain]("_day").alias("_s")).agg(
        F.avg(F.col("_y") - (F.col("_a") + F.col("_b") * x)).alias("_r"))
    return fit, residual


def _points(series: DataFrame, ds: str, y: str, keys: Sequence[str], grain: str) -> DataFrame:
    if grain not in GRAINS:
        raise ValueError(grain)
    day = F.col(ds).cast("date")
    # Keys as one struct: series whose key holds a null are series like others.
    return series.select(*([F.struct(*keys).alias("_k")] if keys else []), day.alias("_day"), _step(day, grain).alias("_x"),
                         F.col(y).cast("double").alias("_y"))


def _predicted() -> Column:
    trend = F.col("_a") + F.col("_b") * F.col("_x").cast("double")
    return F.when(trend.isNotNull(), F.greatest(trend + F.coalesce(F.col("_r"), F.lit(0.0)), F.lit(0.0)))


def usage_forecast(series: DataFrame, ds: str = "ds", y: str = "y", horizon_days: int | None = None,
                   keys: Sequence[str] = (), grain: str = "DAY", today: date | None = None) -> DataFrame:
    """Linear trend + mean residual of the season per series, floored at 0, in steps of ``grain``.

    ``series`` has one row per (keys, ds) with value ``y``, ds being the first day of its period.  Forecast are the periods
    after a series' last one whose first day comes no later than ``horizon_days`` (``FORECAST_HORIZON_DAYS`` of the grain)
    after ``today``, or after that last period if no day is given: none if the series reaches beyond.  A season that was
    never seen adds nothing to the trend; one point leaves no trend and NULL; an empty series has no rows.
    (The reference calls a closed platform function; this is our stated model.)
    """
    grain, by = grain.upper(), ["_k"] if keys else []
    fit, residual = _fitted(_points(series, ds, y, keys, grain), by, grain)
    days = FORECAST_HORIZON_DAYS[grain] if horizon_days is None else horizon_days
    end = _step(F.date_add(F.lit(today) if today else F.col("_until"), days), grain)
    ahead = fit.select(*by, "_a", "_b", F.explode(F.when(end > F.col("_last"), F.sequence(F.col("_last") + 1, end))).alias("_x"))
    ahead = ahead.withColumn("period", _first_day(F.col("_x"), grain)).withColumn("_s", SEASONS[grain]("period"))
    return (ahead.join(residual, [*by, "_s"], "left")
            .select(*(["_k.*"] if keys else []), "period", _predicted().alias("cost_gbp")))


def forecast_backtest(series: DataFrame, steps: int, ds: str = "ds", y: str = "y", keys: Sequence[str] = (),
                      grain: str = "DAY") -> DataFrame:
    """How far the forecast of every series' last ``steps`` periods, made from the periods before, lies from what came:
    periods compared, mean absolute error, and that error relative to the mean of what came (NULL if that is 0)."""
    grain, by = grain.upper(), ["_k"] if keys else []
    s = _points(series, ds, y, keys, grain)
    last = s.groupBy(*by).agg((F.max("_x") - steps).alias("_cut"))
    s = s.join(last, "_k") if by else s.withColumn("_cut", last.scalar())
    fit, residual = _fitted(s.filter(F.col("_x") <= F.col("_cut")), by, grain)
    held = s.filter(F.col("_x") > F.col("_cut")).withColumn("_s", SEASONS[grain]("_day"))
    if by:
        held = held.join(fit.select("_k", "_a", "_b"), "_k", "left")
    else:
        held = held.withColumns({"_a": fit.select("_a").scalar(), "_b": fit.select("_b").scalar()})
    miss = F.avg(F.abs(F.col("_y") - _predicted()))
    out = held.join(residual, [*by, "_s"], "left").groupBy(*by).agg(
        F.count("_y").alias("periods"), miss.alias("mean_abs_error"), (miss / F.nullif(F.avg("_y"), F.lit(0.0))).alias("relative_error"))
    return out.select(*(["_k.*"] if keys else []), "periods", "mean_abs_error", "relative_error")


def cost_series(u: DataFrame, grain: str = "DAY") -> DataFrame:
    """(ds, y): cost of every period, by its first day."""
    return u.groupBy(_period(grain).cast("date").alias("ds")).agg(money_sum(F.col("dbu_cost_gbp")).alias("y"))

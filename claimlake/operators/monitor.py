"""Prediction monitoring: profile metrics, quality per window, drift between windows.

The reference hands this to a managed monitoring service; here each metric is
an ordinary aggregate over the prediction log:

* profile — mergeable statistics per day and slice (:func:`daily_cells`), merged to the
  windows and slices asked for;
* quality — one confusion matrix per day and slice, added up → classification metrics;
* drift — binned counts per window, each window compared with the previous
  window of the same column.  With ``p_i = (n_i + ε) / (N + ε·k)`` over the
  union of bins of the two windows, ``q`` the previous window and
  ``m = (p + q) / 2``: ``kl = Σ p ln(p/q)``,
  ``js = sqrt(½ Σ p ln(p/m) + ½ Σ q ln(q/m))``, ``chi2 = Σ (n_i − N q_i)² / (N q_i)``.

Each metric reads the log once.  Every window function runs over already aggregated
cells or counts, so no partition grows with the rows of the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import model

GRAINS = {"1 day": "day", "1 week": "week"}
DRIFT_BANDS = ((0.05, "none"), (0.10, "mild"))  # else "significant"
PROFILE_COLUMNS = ("predicted_severity", "severity_encoded", "prob_minor", "prob_moderate", "prob_severe",
                   "prob_total_loss")
DRIFT_COLUMNS = ("predicted_severity", "prob_minor", "prob_moderate", "prob_severe", "prob_total_loss")


_SCOPE = ("granularity", "window_start", "slice_key", "slice_value")


def _scopes(cells: DataFrame, slices: Sequence[str], grains: Sequence[str], *keep: Column | str) -> DataFrame:
    """Every cell (a day of some slices) once for each window and slice it belongs to, as ``_SCOPE`` columns."""
    scope = F.explode(F.array(*[
        F.struct(F.lit(g).alias("granularity"), F.date_trunc(GRAINS[g], F.col("_day")).alias("window_start"),
                 F.lit(s or "all").alias("slice_key"), (F.col(s) if s else F.lit(None)).cast("string").alias("slice_value"))
        for g in grains for s in (None, *slices)]))
    return cells.withColumn("_scope", scope).select("_scope.*", *keep)


def daily_cells(p: DataFrame, ts: str, cols: Sequence[str], slices: Sequence[str]) -> DataFrame:
    """One pass over the log: per day and combination of slices the rows, and an array ``_stats`` with count, sum to 10 decimals
    (exact, so equal for any order of rows; NULL if a value has more than 18 digits before the point or is no number),
    mean, sum of squares about the mean, minimum and maximum of every column.  Cells of any days and slices can be merged."""
    def stats(c: str) -> Column:
        v = F.col(c).cast("double")
        exact = v.try_cast("decimal(28, 10)")
        return F.struct(F.lit(c).alias("column_name"), F.count(v).alias("n"),
                        F.when(F.count(exact) == F.count(v), F.coalesce(F.sum(exact), F.lit(0).cast("decimal(38, 10)"))).alias("total"),
                        F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("low"), F.max(v).alias("high"))

    return (p.groupBy(F.date_trunc("day", F.col(ts)).alias("_day"), *slices)
            .agg(F.count(F.lit(1)).alias("rows"), F.array(*[stats(c) for c in cols]).alias("_stats")))


def monitor_profile(p: DataFrame, ts: str, cols: Sequence[str], slices: Sequence[str],
                    grains: Sequence[str] = ("1 day", "1 week")) -> DataFrame:
    """count, % NULL, mean, std, min, max per (granularity, window, slice, column).

    The log is aggregated once, to :func:`daily_cells`; windows and slices are merged from those.  A merged spread is the
    sum of the cells' own and of their means' squares about the common mean, which cancels no large numbers.  A mean is
    that of the exact sums, or of the cells' means where a cell has no exact sum.  A column
    without values has NULL statistics, one with a single value no deviation.
    """
    long = (_scopes(daily_cells(p, ts, cols, slices), slices, grains, "rows", F.explode("_stats").alias("s"))
            .select(*_SCOPE, "rows", "s.*"))
    every = Window.partitionBy(*_SCOPE, "column_name")
    long = long.withColumn("_mean", F.sum(F.col("n") * F.col("mean")).over(every) / F.nullif(F.sum("n").over(every), F.lit(0)))
    n, rows = F.sum("n"), F.sum("rows")
    exact = F.when(F.count("total") == F.count(F.lit(1)), F.sum("total").cast("double"))
    spread = F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2)
    return long.groupBy(*_SCOPE, "column_name").agg(
        rows.alias("count"), ((rows - n) * 100.0 / rows).alias("percent_null"), F.coalesce(exact / F.nullif(n, F.lit(0)), F.max("_mean")).alias("mean"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std_dev"), F.min("low").alias("min_value"), F.max("high").alias("max_value"))


def monitor_quality(p: DataFrame, ts: str, actual: str, pred: str, slices: Sequence[str] = (),
                    grains: Sequence[str] = ("1 day", "1 week")) -> DataFrame:
    """Accuracy and F1 per window, overall and per slice: one confusion matrix per day and combination of slices from one
    pass over the log, added up for every window and slice.  Rows without an actual class take no part."""
    daily = model.confusion_matrix(p.withColumn("_day", F.date_trunc("day", F.col(ts))), actual, pred, ["_day", *slices])
    cm = (_scopes(daily, slices, grains, "actual", "predicted", "n")
          .groupBy(*_SCOPE, "actual", "predicted").agg(F.sum("n").alias("n")))
    return model.classification_metrics(cm, _SCOPE)


def _bins(col: str, value: Column, bins: int, probability_cols: Sequence[str]) -> Column:
    if col in probability_cols:
        return F.when(value.isNotNull(), F.least(F.floor(value * bins), F.lit(bins - 1)).cast("bigint"))
    return value.cast("bigint")


def monitor_drift(p: DataFrame, ts: str, cols: Sequence[str], grain: str = "1 day", bins: int = 10,
                  eps: float = 1e-6, flag_at: float = 0.10,
                  probability_cols: Sequence[str] | None = None) -> DataFrame:
    """KL divergence, JS distance and chi-squared of each window against the column's previous window with values."""
    prob_cols = tuple(probability_cols if probability_cols is not None else [c for c in cols if c.startswith("prob_")])
    bins_of = F.array(*[F.struct(F.lit(c).alias("column_name"), _bins(c, F.col(c).cast("double"), bins, prob_cols).alias("bin"))
                        for c in cols])
    counts = (p.select(F.date_trunc(GRAINS[grain], F.col(ts)).alias("window_start"), F.explode(bins_of).alias("b"))
              .select("window_start", "b.*").filter(F.col("bin").isNotNull())
              .groupBy("column_name", "window_start", "bin").agg(F.count(F.lit(1)).alias("n")))
    # A count stands in its own window and, as the previous one's, in the column's next window.
    after = (Window.partitionBy("column_name").orderBy(F.unix_micros(F.col("window_start").cast("timestamp")))
             .rangeBetween(1, Window.unboundedFollowing))
    turns = F.explode(F.array(
        F.struct(F.col("window_start"), F.col("n"), F.lit(0).cast("long").alias("n_prev")),
        F.struct(F.col("_next").alias("window_start"), F.lit(0).cast("long").alias("n"), F.col("n").alias("n_prev"))))
    both = (counts.withColumn("_next", F.min("window_start").over(after)).select("column_name", "bin", turns.alias("t"))
            .select("column_name", "bin", "t.*").filter(F.col("window_start").isNotNull())
            .groupBy("column_name", "window_start", "bin").agg(F.sum("n").alias("n"), F.sum("n_prev").alias("n_prev")))
    grp = Window.partitionBy("column_name", "window_start")
    # A column's first window has nothing before it.
    both = both.withColumns({"_tot_cur": F.sum("n").over(grp), "_tot_prev": F.sum("n_prev").over(grp),
                             "_k": F.count(F.lit(1)).over(grp)}).filter(F.col("_tot_prev") > 0)
    pi = (F.col("n") + eps) / (F.col("_tot_cur") + eps * F.col("_k"))
    qi = (F.col("n_prev") + eps) / (F.col("_tot_prev") + eps * F.col("_k"))
    both = both.withColumns({"_p": pi, "_q": qi}).withColumn("_mid", (F.col("_p") + F.col("_q")) / 2)
    out = both.groupBy("column_name", "window_start").agg(
        F.sum(F.col("_p") * F.log(F.col("_p") / F.col("_q"))).alias("kl_divergence"),
        F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(F.col("_p") * F.log(F.col("_p") / F.col("_mid")))
                          + 0.5 * F.sum(F.col("_q") * F.log(F.col("_q") / F.col("_mid"))))).alias("js_distance"),
        F.sum((F.col("n") - F.col("_tot_cur") * F.col("_q")) ** 2
              / (F.col("_tot_cur") * F.col("_q"))).alias("chi_squared"),
        F.max("_tot_cur").alias("count"), F.max("_tot_prev").alias("count_prev"))
    return (out.withColumn("granularity", F.lit(grain))
            .withColumn("drift_detected", F.col("js_distance") > flag_at)
            .withColumn("drift_severity", drift_severity(F.col("js_distance"))))


def drift_severity(js: Column) -> Column:
    return F.when(js < DRIFT_BANDS[0][0], "none").when(js <= DRIFT_BANDS[1][0], "mild").otherwise("significant")


def drift_report(d: DataFrame, n: int = 30, columns: Sequence[str] = DRIFT_COLUMNS) -> DataFrame:
    return (d.filter(F.col("column_name").isin(*columns))
            .select(F.col("window_start").alias("window"), "column_name",
                    F.round("js_distance", 4).alias("js_distance"), F.round("kl_divergence", 4).alias("kl_divergence"),
                    "drift_detected")
            .orderBy(F.col("window").desc(), F.col("js_distance").desc(), "column_name").limit(n))


def profile_report(prof: DataFrame, n: int = 50, columns: Sequence[str] = PROFILE_COLUMNS) -> DataFrame:
    return (prof.filter(F.col("column_name").isin(*columns) & (F.col("slice_key") == "all"))
            .select(F.col("window_start").alias("window"), "granularity", "column_name",
                    F.round("percent_null", 2).alias("pct_null"), F.round("mean", 4).alias("mean"),
                    F.round("std_dev", 4).alias("std_dev"), F.round("min_value", 4).alias("min"),
                    F.round("max_value", 4).alias("max"))
            .orderBy(F.col("window").desc(), "granularity", "column_name").limit(n))

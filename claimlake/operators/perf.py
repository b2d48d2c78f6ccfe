"""Run-time analytics: slow statements, scan advice, operator profiles, pipeline/task durations.

The reference classifies one statement picked in a UI; here the same ladder is
a column over the whole query history, so it runs as one narrow projection.
Per-statement profile windows are partitioned by statement (a handful of
plan nodes each), percentiles run over 0.1-minute durations, whose distinct
values per pipeline are bounded.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed thresholds of the reference's advice ladder.
LARGE_SCAN_FILTERED_MB = 500
LOW_FILTER_PCT = 10
LARGE_SCAN_MB = 1000
VERY_SELECTIVE_PCT = 1
PREVIEW_CHARS = 120

PROFILE_NODE = ("struct<node_name:string,name:string,description:string,time_ns:double,"
                "execution_time_ms:double,duration_ms:double,rows_output:bigint,num_output_rows:bigint,"
                "output_rows:bigint,size_output_bytes:double,size_bytes:double>")
PROFILE_SCHEMA = f"struct<nodes:array<{PROFILE_NODE}>,plan_summary:struct<nodes:array<{PROFILE_NODE}>>>"


def _in_window(ts: str, start: date | None, end: date | None) -> Column:
    if start is None or end is None:
        return F.lit(True)
    return F.to_date(F.col(ts)).between(F.lit(start), F.lit(end))


def _seconds_between(start: str, end: str) -> Column:
    return F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))


def slow_queries(h: DataFrame, start: date | None = None, end: date | None = None, n: int = 10) -> DataFrame:
    """Top-n successful, finished statements by duration (ties broken by statement id)."""
    dur = F.round(_seconds_between("start_time", "end_time"), 1)
    return (h.filter(_in_window("start_time", start, end) & F.col("error_message").isNull()
                     & F.col("end_time").isNotNull())
            .select("statement_id", dur.alias("duration_s"), "executed_by", "statement_text",
                    F.left(F.col("statement_text"), F.lit(PREVIEW_CHARS)).alias("query_preview"))
            .orderBy(F.col("duration_s").desc(), "statement_id").limit(n))


def query_metrics(h: DataFrame, statement_id: str) -> DataFrame:
    return (h.filter(F.col("statement_id") == statement_id)
            .select(F.coalesce("read_rows", F.lit(0)).alias("read_rows"),
                    F.coalesce("read_bytes", F.lit(0)).alias("read_bytes"),
                    F.coalesce("produced_rows", F.lit(0)).alias("produced_rows"),
                    "from_result_cache")
            .limit(1))


def perf_advice(h: DataFrame) -> DataFrame:
    """Scan advice for every statement; the first matching rule wins (one narrow projection)."""
    has = (F.col("read_bytes").isNotNull() | F.col("read_rows").isNotNull()
           | F.col("produced_rows").isNotNull())
    read_mb = F.coalesce(F.col("read_bytes"), F.lit(0)) / 1e6
    filter_pct = (F.coalesce(F.col("produced_rows"), F.lit(0))
                  / F.greatest(F.coalesce(F.col("read_rows"), F.lit(0)), F.lit(1)) * 100)
    cached = F.coalesce(F.col("from_result_cache"), F.lit(False))
    advice = (F.when(~has, "no_metrics")
              .when(cached, "result_cache_hit")
              .when((read_mb > LARGE_SCAN_FILTERED_MB) & (filter_pct < LOW_FILTER_PCT), "zorder_filter_columns")
              .when(read_mb > LARGE_SCAN_MB, "optimize_compact_files")
              .when(filter_pct < VERY_SELECTIVE_PCT, "zorder_or_partition")
              .otherwise("ok"))
    return h.select("statement_id", read_mb.alias("read_mb"), filter_pct.alias("filter_pct"), advice.alias("advice"))


def _nonzero(*cols: Column) -> Column:
    """Python's ``a or b or c`` over numbers: first non-NULL, non-zero value, else 0."""
    out = None
    for c in cols:
        cond = F.coalesce(c, F.lit(0)) != 0
        out = F.when(cond, c) if out is None else out.when(cond, c)
    return out.otherwise(F.lit(0.0))


def profile_operators(p: DataFrame, json_col: str = "profile_json", top: int | None = None) -> DataFrame:
    """Plan nodes of each statement's JSON profile: operator, seconds, rows, MB, % of total; all
    nodes, or the ``top`` longest."""
    parsed = p.select("statement_id", F.from_json(F.col(json_col), PROFILE_SCHEMA).alias("_p"))
    own, summary = F.col("_p.nodes"), F.col("_p.plan_summary.nodes")
    nodes = F.when(F.size(own) > 0, own).otherwise(F.coalesce(summary, F.array()))
    n = parsed.select("statement_id", F.posexplode(nodes).alias("node_pos", "n"))
    secs = _nonzero(F.col("n.time_ns") / 1e9, F.col("n.execution_time_ms") / 1e3, F.col("n.duration_ms") / 1e3)
    rows = F.coalesce(_nonzero(F.col("n.rows_output"), F.col("n.num_output_rows"), F.col("n.output_rows"))
                      .cast("bigint"), F.lit(0))
    size = _nonzero(F.col("n.size_output_bytes"), F.col("n.size_bytes")) / 1e6
    ops = n.select(
        "statement_id", "node_pos",
        F.coalesce(*[F.nullif(F.col(f"n.{c}"), F.lit("")) for c in ("node_name", "name", "description")],
                   F.lit("—")).alias("operator"),
        F.round(secs, 3).alias("duration_s"), rows.alias("rows_out"), F.round(size, 2).alias("size_mb"))
    per_stmt = Window.partitionBy("statement_id")
    ranked = Window.partitionBy("statement_id").orderBy(F.col("duration_s").desc(), "node_pos")
    total = F.sum("duration_s").over(per_stmt)
    out = (ops.withColumn("pct", F.round(F.col("duration_s") / F.nullif(total, F.lit(0.0)) * 100, 1))
           .withColumn("rank", F.row_number().over(ranked)))
    return out if top is None else out.filter(F.col("rank") <= top)


def _duration_min(start: str, end: str) -> Column:
    return F.round(_seconds_between(start, end) / 60.0, 1)


def pipeline_durations(t: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    return (t.filter(_in_window("period_start_time", start, end) & F.col("period_end_time").isNotNull())
            .select(F.to_date("period_start_time").alias("run_date"),
                    F.coalesce("pipeline_name", "pipeline_id").alias("pipeline"),
                    "result_state", "trigger_type",
                    _duration_min("period_start_time", "period_end_time").alias("duration_min")))


def pipeline_duration_stats(d: DataFrame) -> DataFrame:
    """Completed runs per pipeline: mean, count and linear-interpolated p95 (pandas' default)."""
    return (d.filter(F.col("result_state") == "COMPLETED")
            .groupBy("pipeline")
            .agg(F.round(F.avg("duration_min"), 1).alias("avg_min"),
                 F.count("duration_min").alias("runs"),
                 F.round(F.percentile("duration_min", 0.95), 1).alias("p95_min"))
            .orderBy(F.col("avg_min").desc(), "pipeline"))


def task_durations(t: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    return (t.filter(_in_window("period_start_time", start, end) & F.col("period_end_time").isNotNull())
            .select(F.to_date("period_start_time").alias("run_date"), "job_id", "task_key", "result_state",
                    _duration_min("period_start_time", "period_end_time").alias("duration_min")))


def task_heatmap_long(d: DataFrame) -> DataFrame:
    """Mean duration of successful runs per task and day, rounded to 0.1 minute."""
    return (d.filter(F.col("result_state") == "SUCCESS")
            .groupBy("task_key", "run_date").agg(F.round(F.avg("duration_min"), 1).alias("duration_min")))


def task_heatmap(d: DataFrame, dates: Sequence[date]) -> DataFrame:
    """Task × day grid for an explicit day list (a fixed list: no extra distinct pass)."""
    long = task_heatmap_long(d)
    return long.groupBy("task_key").pivot("run_date", list(dates)).agg(F.first("duration_min"))

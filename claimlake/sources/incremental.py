"""Incremental loads without a transactional table format.

The reference uses CREATE OR REPLACE, DELETE + INSERT over a 7-day overlap,
and MERGE.  On plain parquet these become:

* the *logical* result as a DataFrame (``overlap_refresh``, ``upsert_by_key``,
  ``replace_dedup``) — pure, testable against the oracle;
* a sink (``write_partitioned`` / ``stage_and_swap``) that writes the result to
  a fresh path or overwrites only the touched date partitions
  (``partitionOverwriteMode=dynamic``), never the path it is reading.

All of them scan only what they need: the overlap filter is a partition
filter on date-partitioned targets, and the upsert is one anti-join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import drop_partitions, stage_and_swap, write_partitioned

OVERLAP_DAYS = 7
EMPTY_CUTOFF = date(2020, 1, 1)
FX_HISTORY_START = date(2022, 6, 1)


def replace_dedup(source: DataFrame, keys: Sequence[str], value: str, order_by: str,
                  alias: str | None = None) -> DataFrame:
    """One row per key with the value of the newest row (ties: greatest value).

    The reference takes ``FIRST(name)`` whose choice is undefined; ``max_by`` on
    an explicit order makes reruns agree.  Partial aggregation keeps a hot key
    from gathering in one task.
    """
    order = F.struct(F.col(order_by), F.col(value))
    return source.groupBy(*keys).agg(F.max_by(F.col(value), order).alias(alias or value))


def overlap_cutoff(target: DataFrame | None, date_expr: Column, days: int = OVERLAP_DAYS,
                   empty_cutoff: date = EMPTY_CUTOFF) -> DataFrame:
    """One-row frame with the reload cutoff: max(date) − days, or ``empty_cutoff`` if empty."""
    if target is None:
        raise ValueError("no target: first run is a full load")
    return target.agg(F.coalesce(F.date_sub(F.max(date_expr), days), F.lit(empty_cutoff)).alias("_cutoff"))


def overlap_refresh(target: DataFrame | None, source: DataFrame, date_col: str,
                    days: int = OVERLAP_DAYS, empty_cutoff: date = EMPTY_CUTOFF,
                    date_expr: Column | None = None) -> DataFrame:
    """Target rows before the cutoff (or without a date) ∪ source rows from the cutoff on.

    First run (``target is None``) is a full load of ``source``.  The cutoff is a
    scalar subquery (``DataFrame.scalar()``): computed once, pushed into both
    scans as a filter, and no value goes through the driver.
    """
    d = date_expr if date_expr is not None else F.col(date_col)
    if target is None:
        return source
    cut = overlap_cutoff(target, d, days, empty_cutoff).scalar()
    return target.filter(~F.coalesce(d >= cut, F.lit(False))).unionByName(source.filter(d >= cut))


def refresh_partitions(spark: SparkSession, path: str, source: DataFrame, date_col: str, days: int = OVERLAP_DAYS) -> None:
    """:func:`overlap_refresh` of a table of date partitions in place: only the partitions from the cutoff on change.

    Partitions that ``source`` has are replaced, those from the cutoff on that it no longer has are dropped; older ones and
    the one without a date stay.  The new rows are staged first, so ``source`` may read ``path``; a run that was cut short
    is repeated with the same result.  An empty source empties the reloaded days (a table with no other days is then left without
    files).  Through the driver go the cutoff and the
    dates from it on.
    """
    target = spark.read.parquet(path)
    cut = overlap_cutoff(target, F.col(date_col), days).first()[0]
    fresh = spark.read.parquet(stage_and_swap(source.filter(F.col(date_col) >= F.lit(cut)), f"{path.rstrip('/')}-staging"))

    def dates(df: DataFrame) -> set:
        return {r[0] for r in df.filter(F.col(date_col) >= F.lit(cut)).select(date_col).distinct().collect()}

    had, has = dates(target), dates(fresh)
    write_partitioned(fresh, path, date_col)
    drop_partitions(spark, path, date_col, sorted(had - has))


def overlap_refresh_enriched(target: DataFrame | None, source: DataFrame, names: DataFrame, key: str,
                             date_col: str, days: int = OVERLAP_DAYS, name_col: str = "name",
                             alias: str = "pipeline_name", date_expr: Column | None = None) -> DataFrame:
    """As :func:`overlap_refresh`, with a left join to (deduplicated) names on load."""
    n = names.select(F.col(key).alias("_nk"), F.col(name_col).alias(alias))
    enriched = source.join(n, F.col(key) == F.col("_nk"), "left").drop("_nk")
    return overlap_refresh(target, enriched, date_col, days, date_expr=date_expr)


def upsert_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                  order_by: str | None = None) -> DataFrame:
    """MERGE semantics: matched rows take the update, unmatched updates are inserted.

    Updates are first reduced to one row per key (newest by ``order_by``), then
    ``target ▷ updates ∪ updates``.  The anti-join broadcasts the update side
    when AQE finds it small, otherwise shuffles both on the key.
    """
    upd = updates
    if order_by is not None:
        cols = [c for c in updates.columns if c not in keys]
        upd = (updates.groupBy(*keys)
               .agg(F.max_by(F.struct(*cols), F.col(order_by)).alias("_u"))
               .select(*keys, *[F.col(f"_u.{c}").alias(c) for c in cols]))
    kept = target.join(upd.select(*keys), list(keys), "left_anti")
    return kept.unionByName(upd.select(*target.columns))


def high_water_mark(target: DataFrame | None, date_col: str, today: date,
                    start: date = FX_HISTORY_START) -> DataFrame:
    """Next fetch window: (max(date) + 1 day or ``start``) … today, and whether it is empty.  Without a target, or with an
    empty one, the window begins at ``start``."""
    if target is None:
        last = SparkSession.active().range(1).select(F.lit(None).cast("date").alias("_m"))
    else:
        last = target.agg(F.max(date_col).alias("_m"))
    frm = F.coalesce(F.date_add(F.col("_m"), 1), F.lit(start))
    return last.select(frm.alias("fetch_from"), F.lit(today).alias("fetch_to"), (frm > F.lit(today)).alias("up_to_date"))


def year_chunks(window: DataFrame, from_col: str = "fetch_from", to_col: str = "fetch_to") -> DataFrame:
    """Split each [from, to] window into calendar-year chunks (chunk_start, chunk_end)."""
    frm, to = F.col(from_col), F.col(to_col)
    years = F.sequence(F.year(frm), F.year(to))
    y = window.filter(frm <= to).select(from_col, to_col, F.explode(years).alias("_y"))
    start = F.greatest(frm, F.make_date(F.col("_y"), F.lit(1), F.lit(1)))
    end = F.least(to, F.make_date(F.col("_y"), F.lit(12), F.lit(31)))
    return y.select(start.alias("chunk_start"), end.alias("chunk_end"))


def fx_from_json(raw: DataFrame, col: str = "payload", currency: str = "GBP",
                 run_ts: Column | None = None) -> DataFrame:
    """Landed FX payload ``{"rates": {"YYYY-MM-DD": {"GBP": r}}}`` → (rate_date, usd_to_gbp, ingested_at)."""
    m = F.from_json(F.col(col), "struct<rates:map<string,map<string,double>>>")
    ex = raw.select(F.explode(m["rates"]).alias("_d", "_r"))
    return ex.select(F.col("_d").try_cast("date").alias("rate_date"),
                     F.col("_r")[currency].alias("usd_to_gbp"),
                     (run_ts if run_ts is not None else F.current_timestamp()).alias("ingested_at")
                     ).filter(F.col("rate_date").isNotNull() & F.col("usd_to_gbp").isNotNull())


def latest_rows(df: DataFrame, order: str, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest ``n`` rows — ``orderBy(desc).limit(n)`` plans as TakeOrderedAndProject."""
    return df.orderBy(F.col(order).desc(), *tiebreak).limit(n)


def skip_if_missing(spark: SparkSession, path: str, fn: Callable[[], DataFrame]) -> DataFrame | None:
    """Run ``fn`` only when ``path`` exists (absent optional source ⇒ warn and continue)."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Hadoop FS check
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(jvm_path):
        import warnings
        warnings.warn(f"skipped: {path} does not exist", stacklevel=2)
        return None
    return fn()

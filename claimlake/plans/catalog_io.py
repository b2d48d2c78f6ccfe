"""Registered queries: incremental loads, reference-table maintenance, file sinks and the stream.

Sink queries write to a fresh folder inside the shared checkpoint folder
(``spark.checkpoint.dir``), read the result back and return it, so the
oracle compares what actually landed on storage with the source view.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..session import scratch_path
from ..operators import silver
from ..sources import files, incremental, synth
from ..streaming import ingest, landing
from .lake import Lake
from .oracle_sql import RUN_TS, cte
from .registry import q, register

CUT = date(2024, 1, 20)
CUT_SQL = "DATE '2024-01-20'"
USAGE_FLAT = ("record_type", "usage_unit", "usage_date", "usage_start_time", "sku_name", "usage_quantity",
              "billing_origin_product", "job_name", "notebook_path", "dlt_pipeline_id")

# ── oracle CTEs ───────────────────────────────────────────────────────────────
cte("usage_target", f"SELECT * FROM fx_usage WHERE usage_date < {CUT_SQL}", "fx_usage")
cte("usage_cut", "SELECT coalesce(max(usage_date) - 7, DATE '2020-01-01') AS cut FROM usage_target", "usage_target")
cte("timeline_target", f"SELECT * FROM timeline WHERE CAST(period_start_time AS DATE) < {CUT_SQL}", "timeline")
cte("timeline_cut", """
SELECT coalesce(CAST(max(CAST(period_start_time AS DATE)) AS DATE) - 7, DATE '2020-01-01') AS cut FROM timeline_target""",
    "timeline_target")
cte("fx_target", f"SELECT * FROM fx_fx_rates_usd_gbp WHERE rate_date < {CUT_SQL}", "fx_fx_rates_usd_gbp")
cte("fx_updates", "SELECT rate_date, usd_to_gbp + 0.01 AS usd_to_gbp FROM fx_fx_rates_usd_gbp "
                  "WHERE rate_date >= DATE '2024-01-15'", "fx_fx_rates_usd_gbp")


def _fx_target(lk: Lake):
    return lk.fx.filter(F.col("rate_date") < F.lit(CUT))


def _fx_updates(lk: Lake):
    return (lk.fx.filter(F.col("rate_date") >= F.lit(date(2024, 1, 15)))
            .withColumn("usd_to_gbp", F.col("usd_to_gbp") + 0.01))


# ── 2.1 incremental loads ─────────────────────────────────────────────────────
register(
    "overlap_refresh",
    lambda lk: incremental.overlap_refresh(
        lk.view("usage").filter(F.col("usage_date") < F.lit(CUT)), lk.view("usage"), "usage_date"),
    q("""SELECT * FROM usage_target WHERE usage_date < (SELECT cut FROM usage_cut)
UNION ALL SELECT * FROM fx_usage WHERE usage_date >= (SELECT cut FROM usage_cut)""", "usage_target", "usage_cut",
      "fx_usage"),
)


def _timeline_enriched(lk: Lake):
    t = lk.run_timeline.drop("duration_s")
    d = F.to_date("period_start_time")
    return incremental.overlap_refresh_enriched(
        t.filter(d < F.lit(CUT)), t.drop("pipeline_name"), lk.pipelines, "pipeline_id",
        "period_start_time", date_expr=d)


register(
    "overlap_refresh_enriched",
    _timeline_enriched,
    q("""SELECT * EXCLUDE (duration_s) FROM timeline_target
WHERE CAST(period_start_time AS DATE) < (SELECT cut FROM timeline_cut)
UNION ALL BY NAME
SELECT t.* EXCLUDE (duration_s, pipeline_name), p.name AS pipeline_name
FROM timeline t LEFT JOIN pipelines p ON t.pipeline_id = p.pipeline_id
WHERE CAST(t.period_start_time AS DATE) >= (SELECT cut FROM timeline_cut)""",
      "timeline_target", "timeline_cut", "timeline", "pipelines"),
)
register(  # by the day of a timestamp
    "overlap_refresh_history",
    lambda lk: incremental.overlap_refresh(
        lk.view("query_history").filter(F.to_date("start_time") < F.lit(CUT)), lk.view("query_history"), "start_time",
        date_expr=F.to_date("start_time")),
    q(f"""WITH t AS (SELECT * FROM fx_query_history WHERE CAST(start_time AS DATE) < {CUT_SQL}),
c AS (SELECT coalesce(MAX(CAST(start_time AS DATE)) - 7, DATE '2020-01-01') AS cut FROM t)
SELECT * FROM t WHERE CAST(start_time AS DATE) < (SELECT cut FROM c)
UNION ALL SELECT * FROM fx_query_history WHERE CAST(start_time AS DATE) >= (SELECT cut FROM c)""", "fx_query_history"),
)
register(
    "upsert_by_key",
    lambda lk: incremental.upsert_by_key(_fx_target(lk), _fx_updates(lk), ["rate_date"]),
    q("""SELECT * FROM fx_target WHERE rate_date NOT IN (SELECT rate_date FROM fx_updates)
UNION ALL SELECT * FROM fx_updates""", "fx_target", "fx_updates"),
)
register(
    "high_water_mark",
    lambda lk: incremental.high_water_mark(_fx_target(lk), "rate_date", date(2024, 3, 15)),
    q("""SELECT coalesce(CAST(max(rate_date) + 1 AS DATE), DATE '2022-06-01') AS fetch_from, DATE '2024-03-15' AS fetch_to,
  coalesce(CAST(max(rate_date) + 1 AS DATE), DATE '2022-06-01') > DATE '2024-03-15' AS up_to_date FROM fx_target""",
      "fx_target"),
)
register(
    "year_chunks",
    lambda lk: incremental.year_chunks(incremental.high_water_mark(_fx_target(lk), "rate_date", date(2026, 2, 17))),
    q("""SELECT greatest(f, make_date(y, 1, 1)) AS chunk_start, least(t, make_date(y, 12, 31)) AS chunk_end
FROM (SELECT f, t, unnest(range(year(f), year(t) + 1)) AS y
      FROM (SELECT CAST(max(rate_date) + 1 AS DATE) AS f, DATE '2026-02-17' AS t FROM fx_target))""", "fx_target"),
)


def _fx_payloads(lk: Lake):
    """Landed JSON, one document per month of rates (derived from the FX table)."""
    fx = lk.fx
    entry = F.struct(F.date_format("rate_date", "yyyy-MM-dd"), F.create_map(F.lit("GBP"), F.col("usd_to_gbp")))
    return (fx.groupBy(F.date_format("rate_date", "yyyy-MM").alias("month"))
            .agg(F.map_from_entries(F.collect_list(entry)).alias("rates"))
            .select(F.to_json(F.struct("rates")).alias("payload")))


register(
    "fx_from_json",
    lambda lk: incremental.fx_from_json(_fx_payloads(lk), "payload",
                                        run_ts=F.lit(str(lk.run_ts)).cast("timestamp_ntz")),
    q(f"SELECT rate_date, usd_to_gbp, {RUN_TS} AS ingested_at FROM fx_fx_rates_usd_gbp", "fx_fx_rates_usd_gbp"),
)
register(
    "latest_rows",
    lambda lk: incremental.latest_rows(lk.fx, "rate_date", 5),
    q("SELECT * FROM fx_fx_rates_usd_gbp ORDER BY rate_date DESC LIMIT 5", "fx_fx_rates_usd_gbp"),
)


def _skip(lk: Lake):
    present = incremental.skip_if_missing(lk.spark, f"{lk.sf_dir}/events.parquet", lambda: lk.run_timeline)
    missing = incremental.skip_if_missing(lk.spark, f"{lk.sf_dir}/no_such_table.parquet", lambda: lk.run_timeline)
    assert missing is None
    return present.select("pipeline_id", "task_key", "result_state")


register(
    "skip_if_missing",
    _skip,
    q("SELECT pipeline_id, task_key, result_state FROM fx_run_timeline", "fx_run_timeline"),
)

# ── 2.1 sinks and the stream (write → read back) ──────────────────────────────
_CLAIMS_COLS = files.BRONZE_COLUMNS["claims"]


def _land_and_read(lk: Lake):
    path = scratch_path(lk.spark, "landing-claims")
    files.land_csv(lk.bronze("claims"), path)
    return files.read_landing_csv(lk.spark, path, "claims", rescue=False)


register(
    "land_csv",
    _land_and_read,
    q("SELECT * FROM fx_claims", "fx_claims"),
)


def _stream_ingest(lk: Lake):
    """Two landed drops, the second with its columns in reverse, two triggered runs on one checkpoint: every row once."""
    base = scratch_path(lk.spark, "stream-claims")
    src, ckpt, out = f"{base}/landing", f"{base}/_checkpoint", f"{base}/bronze"
    b = lk.bronze("claims")
    early = F.coalesce(F.col("claim_date") < "2025-01-01", F.lit(False))
    b.filter(early).write.mode("append").option("header", True).csv(src)
    landing.run_landing(lk.spark, src, "claims", ckpt, out)
    b.filter(~early).select(*_CLAIMS_COLS[::-1]).write.mode("append").option("header", True).csv(src)
    landing.run_landing(lk.spark, src, "claims", ckpt, out)
    landing.run_landing(lk.spark, src, "claims", ckpt, out)  # nothing new: no duplicates
    return landing.landed(lk.spark, out)


# Every third row of an entity lands in a second layout: columns in reverse, the optional ones and an unknown one added.
_KEYS = {e: files.BRONZE_COLUMNS[e][0] for e in files.BRONZE_COLUMNS}


def _late_sql(entity: str) -> str:
    return f"coalesce(ascii(right({_KEYS[entity]}, 1)) % 3 = 0, FALSE)"


def _land_two_layouts(lk: Lake, entity: str) -> str:
    base = scratch_path(lk.spark, f"layouts-{entity}")
    b, columns = lk.bronze(entity), files.landing_columns(entity)
    b.filter(f"NOT {_late_sql(entity)}").write.mode("append").option("header", True).csv(f"{base}/landing")
    landing.run_landing(lk.spark, f"{base}/landing", entity, f"{base}/_checkpoint", f"{base}/bronze")
    second = b.filter(_late_sql(entity)).selectExpr(
        "*", *[f"concat('{c} of ', created_date) AS {c}" for c in files.MORE_LANDING_COLUMNS.get(entity, ())],
        f"concat('note ', {_KEYS[entity]}) AS surplus")
    second.select("surplus", *columns[::-1]).write.mode("append").option("header", True).csv(f"{base}/landing")
    landing.run_landing(lk.spark, f"{base}/landing", entity, f"{base}/_checkpoint", f"{base}/bronze")
    return f"{base}/bronze"


def _whole_row(entity: str, more) -> str:
    cells = [f"coalesce({c}, '-')" for c in files.BRONZE_COLUMNS[entity]] + [more(c) for c in files.MORE_LANDING_COLUMNS.get(entity, ())]
    return " || '|' || ".join(cells)


def _land_by_name(lk: Lake):
    out = None
    for entity in files.BRONZE_COLUMNS:
        part = landing.landed(lk.spark, _land_two_layouts(lk, entity)).selectExpr(
            f"'{entity}' AS entity", f"{_whole_row(entity, lambda c: f'coalesce({c}, chr(45))')} AS landed_row",
            f"get_json_object({files.RESCUED}, '$.surplus') AS surplus", f"{landing.BATCH} AS batch")
        out = part if out is None else out.unionByName(part)
    return out


register(
    "land_by_name",
    _land_by_name,
    q("\nUNION ALL\n".join(
        f"""SELECT '{e}' AS entity, {_whole_row(e, lambda c, e=e: f"CASE WHEN {_late_sql(e)} THEN '{c} of ' || created_date ELSE '-' END")} AS landed_row,
  CASE WHEN {_late_sql(e)} THEN 'note ' || {_KEYS[e]} END AS surplus, CAST({_late_sql(e)} AS INTEGER) AS batch FROM fx_{e}"""
        for e in files.BRONZE_COLUMNS), *[f"fx_{e}" for e in files.BRONZE_COLUMNS]),
)


def _landing_expectations(lk: Lake):
    """What the stream itself counted, per batch: rows that pass and fail the warn-only rule."""
    out = None
    for entity in files.BRONZE_COLUMNS:
        part = landing.landing_log(lk.spark, _land_two_layouts(lk, entity), "expectations")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed(landing.BATCH, "batch")


register(
    "landing_expectations",
    _landing_expectations,
    q("\nUNION ALL\n".join(
        f"""SELECT '{e}' AS entity, 'no_rescued_data' AS expectation, count(*) FILTER (NOT failed) AS passed, count(*) FILTER (failed) AS failed, batch
FROM (SELECT CAST({_late_sql(e)} AS INTEGER) AS batch, {_late_sql(e)} AS failed FROM fx_{e}) GROUP BY batch"""
        for e in files.BRONZE_COLUMNS), *[f"fx_{e}" for e in files.BRONZE_COLUMNS]),
)
register(
    "ingest_stream",
    lambda lk: _stream_ingest(lk).select(*_CLAIMS_COLS),
    q("SELECT * FROM fx_claims", "fx_claims"),
)
register(
    "ingest_audit_cols",
    lambda lk: _stream_ingest(lk).select(
        "claim_id", F.col(files.AUDIT_SOURCE_FILE).isNotNull().alias("has_source_file"),
        F.col(files.AUDIT_INGESTED_AT).isNotNull().alias("has_ingested_at"),
        F.col(files.RESCUED).isNull().alias("well_formed")),
    q("SELECT claim_id, TRUE AS has_source_file, TRUE AS has_ingested_at, TRUE AS well_formed FROM fx_claims",
      "fx_claims"),
)

_INC_COLS = files.BRONZE_COLUMNS["incidents"]


def _extra_field():
    return (F.col("witness_count") == "0") & (F.col("police_report_filed") == "N")


def _rescue(lk: Lake):
    """Incident lines, some with a surplus field, read back PERMISSIVE with a rescue column."""
    path = scratch_path(lk.spark, "landing-incidents")
    b = lk.bronze("incidents")
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in _INC_COLS])
    line = F.when(_extra_field(), F.concat(line, F.lit(",surplus"))).otherwise(line)
    b.select(line.alias("value")).write.mode("overwrite").text(path)
    reader = lk.spark.read.schema(files.bronze_schema("incidents", rescued=True)).option("header", False)
    df = ingest.rescue_malformed(reader).csv(path)
    return df.select("incident_id", "claim_id", F.col(files.RESCUED).isNotNull().alias("rescued"))


register(
    "rescue_malformed",
    _rescue,
    q("SELECT incident_id, claim_id, (witness_count = '0' AND police_report_filed = 'N') AS rescued FROM fx_incidents",
      "fx_incidents"),
)


def _materialize(lk: Lake):
    cfg = files.TableConfig(scratch_path(lk.spark, "tables"))
    files.materialize(lk.silver("claims"), cfg, "silver", "claims", partition_by=["claim_type"])
    return files.scan_table(lk.spark, cfg, "silver", "claims")


register("materialize", _materialize, q("SELECT * FROM s_claims", "s_claims"))


def _overwrite_schema(lk: Lake):
    path = scratch_path(lk.spark, "claim-predictions")
    files.overwrite_with_schema(lk.bronze("claims"), path)            # first version: all strings
    files.overwrite_with_schema(lk.silver("claims"), path)            # replaced, with the typed schema
    return lk.spark.read.parquet(path)


register("overwrite_with_schema", _overwrite_schema, q("SELECT * FROM s_claims", "s_claims"))


def _replace_full(lk: Lake):
    path = scratch_path(lk.spark, "list-prices")
    files.replace_full(lk.view("list_prices"), path)
    files.replace_full(lk.view("list_prices"), path)                  # idempotent
    return lk.spark.read.parquet(path)


register("replace_full", _replace_full, q("SELECT * FROM fx_list_prices", "fx_list_prices"))


def _refresh_partitioned(lk: Lake, source=None):
    """The overlap refresh as storage does it: only reloaded date partitions are rewritten."""
    path = scratch_path(lk.spark, "usage")
    usage = lk.view("usage")
    files.write_partitioned(usage.filter(F.col("usage_date") < F.lit(CUT)), path, "usage_date")
    incremental.refresh_partitions(lk.spark, path, usage if source is None else source, "usage_date")
    return lk.spark.read.parquet(path).select(*USAGE_FLAT)


register(
    "overlap_refresh_partitioned",
    _refresh_partitioned,
    q("""SELECT * FROM usage_target WHERE usage_date < (SELECT cut FROM usage_cut)
UNION ALL SELECT * FROM fx_usage WHERE usage_date >= (SELECT cut FROM usage_cut)""", "usage_target", "usage_cut",
      "fx_usage"),
)
register(  # the source has lost the last loaded day and corrects nothing older than the cutoff
    "overlap_refresh_vanished",
    lambda lk: _refresh_partitioned(lk, lk.view("usage").filter(F.col("usage_date") != F.date_sub(F.lit(CUT), 1))),
    q(f"""SELECT * FROM usage_target WHERE usage_date < (SELECT cut FROM usage_cut)
UNION ALL SELECT * FROM fx_usage WHERE usage_date >= (SELECT cut FROM usage_cut) AND usage_date <> DATE '{CUT}' - 1""",
      "usage_target", "usage_cut", "fx_usage"),
)


def _registry_profile(lk: Lake):
    """Each registered landing entity loaded with its schema: rows and column count."""
    out = None
    for entity, schema in files.bronze_registry().items():
        part = lk.bronze(entity).select(*schema.fieldNames()).agg(
            F.lit(entity).alias("entity"), F.count(F.lit(1)).alias("rows"),
            F.lit(len(schema.fields)).alias("columns"))
        out = part if out is None else out.unionByName(part)
    return out


register(
    "bronze_registry",
    _registry_profile,
    q("\nUNION ALL\n".join(
        f"SELECT '{e}' AS entity, COUNT(*) AS rows, {len(c)} AS columns FROM fx_{e}"
        for e, c in files.BRONZE_COLUMNS.items()), *[f"fx_{e}" for e in files.BRONZE_COLUMNS]),
)


def _job(lk: Lake):
    """The whole job into a fresh table root; returns the fraud summary it wrote."""
    from .job import run

    cfg = files.TableConfig(scratch_path(lk.spark, "lakehouse"))
    run(lk.spark, cfg, lk.bronze, lk.as_of, lk.run_ts)
    return files.scan_table(lk.spark, cfg, "gold", "summary_fraud_intelligence")


register(
    "lakehouse_job",
    _job,
    q("""SELECT *, round(flagged_claims / greatest(total_claims, 1), 4) AS fraud_rate,
  round(flagged_claims_gbp / greatest(total_claims_gbp, 0.01), 4) AS fraud_amount_ratio
FROM fraud_summary""", "fraud_summary"),
    rounded=("avg_fraud_score", "flagged_claims_gbp", "total_claims_gbp"),
)


# ── generator (rows-only: draws are xxhash64-based, which the oracle engine lacks) ──
def _spines(lk: Lake):
    t = lk.table
    return {
        "policyholders": t("customer").select(F.col("c_custkey").alias("id")),
        "vehicles": t("part").select(F.col("p_partkey").alias("id")),
        "policies": t("part").select(F.col("p_partkey").alias("id")),
        "claims": t("orders").select(F.col("o_orderkey").alias("id")),
        "incidents": t("events").select(F.col("event_id").alias("id")),
        "claim_assessments": t("lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id")),
    }


def _synth(lk: Lake, params):
    ents = synth.synthetic_entities(_spines(lk), params)
    out = None
    for e, df in ents.items():
        part = df.select(F.lit(e).alias("entity"), F.to_json(F.struct(*df.columns)).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


def _bad_rows(lk: Lake):
    ents = synth.synthetic_entities(_spines(lk))
    out = None
    for e, df in ents.items():
        part = silver.failing(e, df).select(F.lit(e).alias("entity"), F.col(silver.ID_COLUMNS[e]).alias("id"),
                                                 "_dq")
        out = part if out is None else out.unionByName(part)
    return out


register("synthetic_entities", lambda lk: _synth(lk, synth.SynthParams()), None)
register("shifted_batch", lambda lk: _synth(lk, synth.SHIFTED), None)
register("bad_row_injection", _bad_rows, None)

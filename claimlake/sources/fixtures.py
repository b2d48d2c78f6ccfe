"""Domain tables derived from the star test tables (FIXTURES.md §3).

Every domain table of the claims lakehouse (landing entities, billing system
tables, prediction log) is *derived* from one of the given parquet tables with
one SQL text that is valid in Spark SQL and in DuckDB, so the Spark queries and
the DuckDB oracle start from identical rows.  Table references are written
``$name``; :func:`spark_view` resolves them to temp views over the parquet
files, :func:`duckdb_cte` to the oracle's pre-registered view names.

The bronze entities come out all-string, like landed CSV.  Bad rows (NULL or
``BAD-`` ids, out-of-range values, unparsable numbers) are injected by modulus
so every data-quality rule fires at every scale.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

STAR_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# Fixed value lists of the fixture views (FIXTURES.md §3), kept as the SQL literals.
REGIONS = (
    "Greater London,West Yorkshire,West Midlands,Greater Manchester,South Yorkshire,Merseyside,"
    "Hampshire,Essex,Kent,Lancashire,Somerset,Nottinghamshire,Devon,Tyne and Wear,Bristol,"
    "North Yorkshire,Norfolk"
)

FIXTURES: dict[str, tuple[str, str]] = {
    "policyholders": (
        "$customer JOIN $nation ON c_nationkey = n_nationkey",
        f"""
CASE WHEN c_custkey % 66 = 0 THEN NULL WHEN c_custkey % 66 = 1 THEN 'BAD-' || lpad(CAST(c_custkey AS STRING),6,'0') ELSE 'PH-' || lpad(CAST(c_custkey AS STRING),6,'0') END AS policyholder_id,
'First' || CAST(c_custkey % 97 AS STRING) AS first_name,
c_name AS last_name,
CASE WHEN c_custkey % 50 = 7 THEN '2021-06-15' WHEN c_custkey % 50 = 8 THEN NULL ELSE CAST(DATE '1946-01-01' + CAST(c_custkey * 37 % 22000 AS INT) AS STRING) END AS date_of_birth,
split_part('M,F,Other',',',CAST(c_custkey % 3 + 1 AS INT)) AS gender,
CASE WHEN c_custkey % 40 = 5 THEN 'invalidemail' WHEN c_custkey % 40 = 6 THEN NULL ELSE 'user' || CAST(c_custkey AS STRING) || '@example.com' END AS email,
split_part('{REGIONS}',',',CAST(n_nationkey % 17 + 1 AS INT)) AS region,
'City' || CAST(c_custkey % 5 AS STRING) AS city,
'PC' || CAST(c_custkey % 900 AS STRING) AS postcode,
CASE WHEN c_custkey % 61 = 2 THEN NULL ELSE split_part('0,0,0,0,3,6,9',',',CAST(c_custkey % 7 + 1 AS INT)) END AS driving_points,
CAST(c_custkey % 45 AS STRING) AS driving_years,
'2024-01-01' AS created_date""",
    ),
    "vehicles": (
        "$part",
        """
CASE WHEN p_partkey % 66 = 0 THEN NULL WHEN p_partkey % 66 = 1 THEN 'BAD-' || lpad(CAST(p_partkey AS STRING),6,'0') ELSE 'VH-' || lpad(CAST(p_partkey AS STRING),6,'0') END AS vehicle_id,
CASE WHEN p_partkey % 45 = 3 THEN NULL ELSE 'PH-' || lpad(CAST(p_partkey % (SELECT COUNT(*) FROM $customer) AS STRING),6,'0') END AS policyholder_id,
p_brand AS make,
split_part('Hatchback,Saloon,SUV,Estate,MPV,Crossover,Coupe',',',CAST(p_partkey % 7 + 1 AS INT)) AS vehicle_type,
CASE WHEN p_partkey % 40 = 2 THEN '1850' WHEN p_partkey % 40 = 3 THEN 'n/a' ELSE CAST(2005 + p_size % 20 AS STRING) END AS year,
split_part('White,Black,Silver,Grey,Blue',',',CAST(p_partkey % 5 + 1 AS INT)) AS colour,
CASE WHEN p_partkey % 50 = 9 THEN '-999.0' ELSE CAST(p_retailprice * (1 + p_size) AS STRING) END AS estimated_value,
CAST(5000 + p_partkey * 71 % 150000 AS STRING) AS mileage,
'2024-01-01' AS created_date""",
    ),
    "policies": (
        "$part",
        """
CASE WHEN p_partkey % 66 = 0 THEN NULL WHEN p_partkey % 66 = 1 THEN 'BAD-' || lpad(CAST(p_partkey AS STRING),6,'0') ELSE 'POL-' || lpad(CAST(p_partkey AS STRING),6,'0') END AS policy_id,
'PH-' || lpad(CAST(p_partkey % (SELECT COUNT(*) FROM $customer) AS STRING),6,'0') AS policyholder_id,
CASE WHEN p_partkey % 70 = 5 THEN NULL ELSE 'VH-' || lpad(CAST(p_partkey AS STRING),6,'0') END AS vehicle_id,
split_part('Comprehensive,ThirdPartyFireTheft,ThirdPartyOnly',',',CAST(p_partkey % 3 + 1 AS INT)) AS policy_type,
split_part('Accidental Damage,Fire and Theft,Third Party Liability,Windscreen Cover,Courtesy Car',',',CAST(p_partkey % 5 + 1 AS INT)) AS coverage_type,
CASE WHEN p_partkey % 50 = 11 THEN '-200.0' ELSE CAST(20 + CAST(p_partkey * 13 % 2500 AS DOUBLE) / 10 AS STRING) END AS premium_monthly,
split_part('250.0,500.0,1000.0,2000.0',',',CAST(p_partkey % 4 + 1 AS INT)) AS excess,
CAST(5000 + p_partkey * 97 % 95000 AS STRING) AS coverage_limit,
CAST(DATE '2024-02-18' + CAST(p_partkey * 17 % 730 AS INT) AS STRING) AS start_date,
CAST(DATE '2024-02-18' + CAST(p_partkey * 17 % 730 AS INT) + CASE WHEN p_partkey % 40 = 4 THEN -10 ELSE 365 END AS STRING) AS end_date,
split_part('Active,Active,Active,Active,Active,Active,Lapsed,Cancelled',',',CAST(p_partkey % 8 + 1 AS INT)) AS status,
'2024-01-01' AS created_date""",
    ),
    "claims": (
        "$orders",
        f"""
CASE WHEN o_orderkey % 66 = 0 THEN NULL WHEN o_orderkey % 66 = 1 THEN 'BAD-' || lpad(CAST(o_orderkey AS STRING),7,'0') ELSE 'CLM-' || lpad(CAST(o_orderkey AS STRING),7,'0') END AS claim_id,
CASE WHEN o_orderkey % 60 = 8 THEN NULL ELSE 'POL-' || lpad(CAST(o_orderkey * 3 % (SELECT COUNT(*) FROM $part) AS STRING),6,'0') END AS policy_id,
'PH-' || lpad(CAST(o_custkey AS STRING),6,'0') AS policyholder_id,
'VH-' || lpad(CAST(o_orderkey * 7 % (SELECT COUNT(*) FROM $part) AS STRING),6,'0') AS vehicle_id,
split_part('weather,collision,theft,vandalism,fire',',',CAST(o_custkey % 5 + 1 AS INT)) AS claim_type,
CAST(DATE '2024-01-01' + CAST(o_orderkey * 31 % 779 AS INT) AS STRING) AS claim_date,
split_part('{REGIONS}',',',CAST(o_orderkey % 17 + 1 AS INT)) AS incident_region,
'City' || CAST(o_orderkey % 5 AS STRING) AS incident_city,
CASE WHEN o_orderkey % 90 = 2 THEN 'CATASTROPHIC' WHEN o_orderkey % 90 = 3 THEN NULL ELSE split_part('minor,minor,minor,moderate,moderate,moderate,moderate,severe,severe,severe,total_loss',',',CAST(o_orderkey % 11 + 1 AS INT)) END AS severity_label,
CASE WHEN o_orderkey % 80 = 4 THEN '2.5' WHEN o_orderkey % 80 = 5 THEN NULL ELSE CAST(CAST(o_orderkey * 7919 % 1000 AS DOUBLE) / 1000 AS STRING) END AS fraud_risk_score,
CASE WHEN o_orderkey % 75 = 6 THEN '-5000.0' WHEN o_orderkey % 75 = 7 THEN 'abc' ELSE CAST(o_totalprice / 20 AS STRING) END AS claim_amount_gbp,
split_part('open,under_review,approved,denied,settled',',',CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 5 + 1 AS INT)) AS claim_status,
CASE WHEN o_orderkey % 20 < 4 THEN 'Y' WHEN o_orderkey % 20 = 4 THEN 'yes' WHEN o_orderkey % 20 = 5 THEN 'TRUE' WHEN o_orderkey % 20 = 6 THEN '1' WHEN o_orderkey % 20 = 7 THEN NULL ELSE 'N' END AS is_storm_related,
'2026-02-17' AS created_date""",
    ),
    "incidents": (
        "$events",
        """
CASE WHEN event_id % 66 = 0 THEN NULL WHEN event_id % 66 = 1 THEN 'BAD-' || lpad(CAST(event_id AS STRING),7,'0') ELSE 'INC-' || lpad(CAST(event_id AS STRING),7,'0') END AS incident_id,
CASE WHEN event_id % 55 = 4 THEN NULL ELSE 'CLM-' || lpad(CAST(event_id % ((SELECT COUNT(*) FROM $customer) * 5) AS STRING),7,'0') END AS claim_id,
split_part('collision,flood_damage,storm_damage,theft,vandalism,fire',',',CAST(event_id % 6 + 1 AS INT)) AS incident_type,
CAST(CAST(ts AS DATE) AS STRING) AS incident_date,
split_part('clear,heavy_rain,flood,snow,fog,strong_wind,hail',',',CAST(event_id % 7 + 1 AS INT)) AS weather_condition,
split_part('dry,wet,flooded,icy,waterlogged,debris_on_road',',',CAST(user_id % 6 + 1 AS INT)) AS road_condition,
split_part('good,moderate,poor',',',CAST((event_id + user_id) % 3 + 1 AS INT)) AS visibility,
CASE WHEN event_id % 10 < 7 THEN 'Y' ELSE 'N' END AS police_report_filed,
CAST(event_id % 4 + 1 AS STRING) AS num_vehicles_involved,
CAST(event_id % 5 AS STRING) AS witness_count,
'2026-02-17' AS created_date""",
    ),
    "claim_assessments": (
        "$lineitem",
        """
CASE WHEN l_suppkey % 66 = 1 THEN NULL WHEN l_suppkey % 66 = 2 THEN 'BAD-' || lpad(CAST(l_orderkey AS STRING),7,'0') ELSE 'ASS-' || lpad(CAST(l_orderkey AS STRING),7,'0') || '-' || CAST(l_linenumber AS STRING) END AS assessment_id,
CASE WHEN l_partkey % 100 = 3 THEN NULL ELSE 'CLM-' || lpad(CAST(l_orderkey AS STRING),7,'0') END AS claim_id,
'ASR-' || lpad(CAST(l_suppkey % 200 + 1 AS STRING),4,'0') AS assessor_id,
CASE l_returnflag WHEN 'A' THEN 'junior' WHEN 'N' THEN 'senior' ELSE 'specialist' END AS assessor_tier,
CAST(DATE '2024-01-10' + CAST((l_orderkey * 31 + l_linenumber * 5) % 779 AS INT) AS STRING) AS assessment_date,
split_part('exterior_bodywork,mechanical,total_loss,interior,glass_windscreen,electrical,flood_damage',',',CAST(l_linenumber % 7 + 1 AS INT)) AS damage_category,
CASE WHEN l_partkey % 50 = 1 THEN '-3000.0' WHEN l_partkey % 50 = 2 THEN NULL ELSE CAST(l_extendedprice / 10 AS STRING) END AS estimated_repair_cost_gbp,
CASE WHEN l_partkey % 50 = 4 THEN '-5.0' ELSE CAST(l_quantity AS STRING) END AS labour_hours,
CAST(l_extendedprice / 30 AS STRING) AS parts_cost_gbp,
split_part('repair,replace,write_off,deny,further_investigation',',',CAST(l_suppkey % 5 + 1 AS INT)) AS recommended_action,
'2026-02-17' AS created_date""",
    ),
    "usage": (
        "$events",
        """
CASE WHEN event_id % 20 = 0 THEN 'RETRACTION' ELSE 'ORIGINAL' END AS record_type,
CASE WHEN event_id % 10 = 3 THEN 'GB' ELSE 'DBU' END AS usage_unit,
CAST(ts AS DATE) AS usage_date,
ts AS usage_start_time,
event_type AS sku_name,
CAST(value AS DECIMAL(18,4)) AS usage_quantity,
split_part('JOBS,SQL,DLT,INTERACTIVE',',',CAST(user_id % 4 + 1 AS INT)) AS billing_origin_product,
CASE WHEN user_id % 3 = 0 THEN 'job' || CAST(user_id % 12 AS STRING) END AS job_name,
CASE WHEN user_id % 3 = 1 THEN '/nb/' || CAST(user_id % 7 AS STRING) END AS notebook_path,
CASE WHEN user_id % 6 = 2 THEN 'pl' || CAST(user_id % 5 AS STRING) END AS dlt_pipeline_id""",
    ),
    "list_prices": (
        "(SELECT DISTINCT event_type FROM $events) t CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) v",
        """
event_type AS sku_name,
CASE WHEN k = 0 THEN TIMESTAMP '2023-12-01 00:00:00' ELSE TIMESTAMP '2024-01-16 00:00:00' END AS price_start_time,
CASE WHEN k = 0 THEN TIMESTAMP '2024-01-16 00:00:00' END AS price_end_time,
CAST(CAST(length(event_type) AS DOUBLE) * 0.1 + k * 0.05 AS DECIMAL(18,4)) AS price_default""",
    ),
    "fx_rates_usd_gbp": (
        "(SELECT DISTINCT CAST(ts AS DATE) AS d FROM $events) t "
        "WHERE d >= DATE '2024-01-03' AND CAST(day(d) AS INT) % 7 NOT IN (6, 0)",
        """
d AS rate_date,
0.78 + CAST(day(d) AS DOUBLE) / 1000 AS usd_to_gbp""",
    ),
    "query_history": (
        "$events",
        """
CAST(event_id AS STRING) AS statement_id,
ts AS start_time,
value AS duration_s,
'user' || CAST(user_id % 20 AS STRING) AS executed_by,
'SELECT ' || event_type || ' ' || props AS statement_text,
CASE WHEN event_type = 'error' THEN 'failed' END AS error_message,
CAST(event_id * 7919 % 2000 * 1000000 AS BIGINT) AS read_bytes,
CAST(event_id % 1000 * 100 AS BIGINT) AS read_rows,
CAST(event_id % 1000 * (event_id % 37) AS BIGINT) AS produced_rows,
event_id % 13 = 0 AS from_result_cache""",
    ),
    "run_timeline": (
        "$events",
        """
'pl' || CAST(user_id % 8 AS STRING) AS pipeline_id,
CASE WHEN user_id % 8 < 5 THEN 'pipe' || CAST(user_id % 8 AS STRING) END AS pipeline_name,
CAST(user_id % 4 AS STRING) AS job_id,
split_part('ingest,silver,dims,facts,features,summary',',',CAST(user_id % 6 + 1 AS INT)) AS task_key,
CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 2 = 0 THEN 'COMPLETED' ELSE 'SUCCESS' END AS result_state,
split_part('SCHEDULED,MANUAL',',',CAST(event_id % 2 + 1 AS INT)) AS trigger_type,
ts AS period_start_time,
CASE WHEN event_id % 30 = 1 THEN NULL ELSE value END AS duration_s""",
    ),
    "claim_predictions": (
        "$events",
        """
'CLM-' || lpad(CAST(event_id AS STRING),7,'0') AS claim_id,
CASE WHEN event_id % 40 = 9 THEN NULL ELSE CAST(event_id % 4 AS INT) END AS severity_encoded,
CAST(CASE WHEN user_id % 3 = 0 THEN (event_id + 1) % 4 ELSE event_id % 4 END AS INT) AS predicted_severity,
CAST(event_id * 13 % 100 AS DOUBLE) / 100 AS prob_minor,
(100 - CAST(event_id * 13 % 100 AS DOUBLE)) / 200 + CAST(day(ts) AS DOUBLE) / 100 AS prob_total_loss,
CAST(user_id % 3 + 1 AS STRING) AS model_version,
ts AS scored_at""",
    ),
    "query_profiles": (
        "$events",
        """
CAST(event_id AS STRING) AS statement_id,
'{"nodes":[{"node_name":"Scan","time_ns":' || CAST(event_id * 1000003 AS STRING) || ',"rows_output":' || CAST(event_id % 500 AS STRING) || '},{"name":"Filter","duration_ms":' || CAST(event_id % 700 AS STRING) || '}]}' AS profile_json""",
    ),
}

# Spark-side FROM clauses that express the same rows without a cross join (the
# two-row price-version list becomes a generator, planned as Generate, not a
# nested-loop join).
SPARK_SOURCES = {
    "list_prices": "(SELECT DISTINCT event_type FROM $events) t LATERAL VIEW explode(array(0, 1)) v AS k",
}

BRONZE_ENTITIES = ("policyholders", "vehicles", "policies", "claims", "incidents", "claim_assessments")

_REF = re.compile(r"\$(\w+)")


def fixture_sql(name: str, resolve, engine: str = "duckdb") -> str:
    """SELECT text of one fixture view with ``$table`` references resolved by ``resolve``."""
    source, select_list = FIXTURES[name]
    if engine == "spark":
        source = SPARK_SOURCES.get(name, source)
    text = f"SELECT {select_list.strip()}\nFROM {source}"
    return _REF.sub(lambda m: resolve(m.group(1)), text)


def duckdb_cte(name: str) -> str:
    """Fixture text for the oracle, where the star tables are plain view names."""
    return fixture_sql(name, lambda t: t)


def _view_name(sf_dir: str, table: str) -> str:
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    return f"cl_{table}_{tag}"


def star_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Lazy parquet scan of one given table (pushdown and pruning left to Catalyst)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _register(spark: SparkSession, sf_dir: str, table: str) -> str:
    name = _view_name(sf_dir, table)
    if not spark.catalog.tableExists(name):
        star_table(spark, sf_dir, table).createOrReplaceTempView(name)
    return name


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a lazy Spark DataFrame over the parquet files in ``sf_dir``."""
    return spark.sql(fixture_sql(name, lambda t: _register(spark, sf_dir, t), engine="spark"))


def bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """All-string bronze entity, as landed CSV would be read with a fixed schema."""
    if entity not in BRONZE_ENTITIES:
        raise KeyError(entity)
    return spark_view(spark, sf_dir, entity)
